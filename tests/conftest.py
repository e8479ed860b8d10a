import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from pageloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(4, "tests")


@pytest.fixture
def evaluate(spark):
    """Value of an expression over one string column ``s``, for each of the strings."""
    def run(expression, strings):
        rows = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
        found = rows.selectExpr("i", f"{expression} AS v").collect()
        return [r.v for r in sorted(found, key=lambda r: r.i)]
    return run
