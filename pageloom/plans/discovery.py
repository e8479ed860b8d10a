"""Listing pages to ad URLs and to the list of pages to try again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom import schemas


def failed_pages(discovered: DataFrame) -> DataFrame:
    """Pages without records as fetch attempts, with how often they were retried already. Pages of
    other sites are never asked for, so they neither are attempts nor get deferred."""
    return discovered.filter(~F.col("outcome").isin("ok", "off_site")).select(
        "origin_url", F.col("fetched_at").alias("attempt_ts"), "status", "n_records", "outcome",
        "reason", F.coalesce("retry_times", F.lit(0)).alias("retry_times"))


def next_attempts(discovered: DataFrame, max_retries: int) -> DataFrame:
    """Requests for pages that may be tried again, each more urgent than the last time."""
    retries = F.col("retry_times") + 1
    return failed_pages(discovered).filter(retries <= max_retries).select(
        F.col("origin_url").alias("url"), retries.alias("retry_times"),
        retries.alias("priority"), F.lit(True).alias("is_retry"))


def given_up(discovered: DataFrame, max_retries: int) -> DataFrame:
    """Pages out of retries, as deferred records."""
    gone = failed_pages(discovered).filter(F.col("retry_times") + 1 > max_retries).select(
        F.lit("DeferedRequest").alias("Type"), F.col("origin_url").alias("RequestUrl"),
        F.col("status").alias("Raison"))
    return schemas.conform(gone, schemas.LISTING_AD)
