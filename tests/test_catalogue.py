"""Every query against its SQL, and the plans behind them."""

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from pageloom import catalogue

SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_agrees_with_sql(spark, con, name):
    rows, problem = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert problem is None, problem


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.items() <= entry.oracle_sql().items()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


EXTRACTING = ["first_match_fields", "all_match_links", "cards_per_card", "cards_positional",
              "ad_document", "luxury_ad", "agency_profile", "url_page_lookup", "page_outcome"]


@pytest.mark.parametrize("name", EXTRACTING)
def test_extraction_stays_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "Python" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoop" not in text


def test_bodies_are_not_shuffled_by_joins(spark):
    text = plan(QUERIES["url_page_lookup"](spark, SF))
    for line in text.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "html" not in line


def test_pages_laid_out_by_url_are_not_shuffled(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = plan(QUERIES["url_page_lookup"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "title" not in exchanges[0]  # that of the requests


def test_columns_and_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F

    from pageloom.functions import urls as U
    from pageloom.operators import specs as S
    from pageloom.operators.extract import extract_fields
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    by_url = pages.filter(F.col("url").contains("blog")).selectExpr(f"{U.host('url')} AS h")
    text = plan(by_url)
    assert "StringContains(url,blog)" in text and "html" not in text.split("ReadSchema")[1]
    # A filter on a kept column passes the extraction; one on an extracted column does not
    # evaluate it twice.
    df = extract_fields(pages, S.PLAIN_PAGE, keep=["page_id", "url"])
    assert "StringContains(url,blog)" in plan(df.filter(F.col("url").contains("blog")))
    assert plan(df.filter("heading LIKE 'T%'")).count("<(?i:h1)") == plan(df).count("<(?i:h1)")


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
