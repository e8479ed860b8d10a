"""Joins that hold when one key carries a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that one task may take; rows of a key with more stay where they are.
HOT_ROWS = 1_000_000
# Of such keys this many, the ones with most rows: any other has a smaller share of all rows than one in so many.
HOT_KEYS = 10_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS, most: int = HOT_KEYS) -> DataFrame:
    """Keys with more than ``hot_rows`` rows and ``rows``, by exact counts (partial counts are combined before
    the shuffle); the ``most`` with most rows if there are more of them."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("rows"))
            .filter(F.col("rows") > hot_rows).orderBy(F.desc("rows"), key).limit(most))


def skew_left_join(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join on ``key`` to ``right``, which has one row per key, however often a key occurs on the left.

    The keys of the left side are counted first. If none is hot, this is a plain join, which a side that is
    already laid out by the key enters as it is. Rows of hot keys are not shuffled at all, so exact repeats
    of a row do not meet in one task: the right rows of these keys, ``HOT_KEYS`` at most, are sent to them. Rows
    without a key match nothing and stay where they are, too.
    """
    hot = hot_keys(left, key, hot_rows)
    values = [r[0] for r in hot.collect()]
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name != key]
    keyless = left.filter(F.col(key).isNull()).select("*", *none)
    some = left.filter(F.col(key).isNotNull())
    if not values:
        return some.join(right, key, "left").unionByName(keyless)
    table = left.sparkSession.createDataFrame([(v,) for v in values], left.select(key).schema)
    often = right.join(F.broadcast(table), key, "left_semi")
    seldom = some.join(F.broadcast(table), key, "left_anti").join(right, key, "left")
    rest = some.join(F.broadcast(table), key, "left_semi").join(F.broadcast(often), key, "left")
    return seldom.unionByName(rest).unionByName(keyless)
