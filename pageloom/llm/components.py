"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import saved


def _lowest(links: DataFrame) -> DataFrame:
    return (links.groupBy("u").agg(F.min("v").alias("low"))
            .select(F.col("u").alias("at"), F.least("u", "low").alias("low")))


def _mark(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``links(a, b)`` reaches; roots aside.

    Large stars tie the larger neighbours of a node to its smallest one, small stars the smaller
    ones; stars of the components are what is left. Minima are combined before their shuffle and a
    node of many links is only ever split by the join, never gathered. Every round is a written table.
    """
    def distinct(df):
        return saved(df.where("u <> v").distinct(), "stars")

    links = distinct(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")))
    mark = _mark(links)
    while mark[0]:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_lowest(both), F.col("u") == F.col("at")).where("v > u")
        stars = distinct(large.select(F.col("v").alias("u"), F.col("low").alias("v")))
        low = _lowest(stars)
        small = stars.join(low, F.col("u") == F.col("at")).select(F.col("v").alias("u"), F.col("low").alias("v"))
        links = distinct(small.union(low.select(F.col("at").alias("u"), F.col("low").alias("v"))))
        now = _mark(links)
        if now == mark:
            break
        mark = now
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
