"""Seed lists: text, one URL per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.text import trim_blank


def seed_urls(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).selectExpr(f"{trim_blank('value')} AS url")
    return lines.filter(F.col("url") != "")


def seed_fanout(seeds: DataFrame) -> DataFrame:
    """Seeds as messages for the agency stage."""
    return seeds.select("url", F.lit("agency").alias("route"),
                        F.lit(None).cast("string").alias("cp"))
