"""Attempts, bounded retries, deferral.

A failed page is tried again at most ``max_retries`` times; the next failure defers it and the
counter starts over. So with failures numbered since the last success, every
``max_retries + 1``-th one defers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pageloom import schemas
from pageloom.operators import specs as S
from pageloom.session import written


def number_failures(attempts: DataFrame, key: str, order: list[str], failed: Column,
                    carried: DataFrame | None = None, ranges: int | None = None) -> DataFrame:
    """Add ``failure_no``: position in the current run of failures, 0 for a success.

    The attempts are dealt out by ranges of key and order, so one key's many attempts, or those
    without a key, take as many ranges as they need, and are written once in that form. Each range
    numbers its own; one summary row per key and range tells how long a run the ranges before leave
    open. ``carried`` (key, ``open_run``) continues runs from an earlier batch. ``ranges`` is their
    number; by default Spark makes them of its advisory size.
    """
    by = [key, *order]
    flagged = attempts.withColumn("_failed", F.coalesce(failed, F.lit(False)).cast("int"))
    dealt = flagged.repartitionByRange(ranges, *by) if ranges else flagged.repartitionByRange(*by)
    # A struct of the key equals itself where the key is NULL.
    rows = written(dealt.withColumn("_range", F.spark_partition_id()), "attempts") \
        .withColumn("_key", F.struct(key))
    # Failures so far, and failures up to the last success: one sort serves both windows.
    so_far = W.partitionBy("_key", "_range").orderBy(*order).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    rows = rows.withColumn("_failures", F.sum("_failed").over(so_far))
    rows = rows.withColumn("_before", F.max(
        F.when(F.col("_failed") == 0, F.col("_failures"))).over(so_far))

    parts = (rows.groupBy("_key", "_range").agg(F.max("_failures").alias("_all"),
                                                F.max("_before").alias("_last"))
             .withColumn("_open", F.col("_all") - F.coalesce("_last", F.lit(0))))
    by_key = W.partitionBy("_key").orderBy("_range")
    # A range with a success begins a segment; inside a segment open runs add up.
    parts = parts.withColumn("_segment", F.count("_last").over(by_key))
    parts = parts.withColumn("_end", F.sum("_open").over(
        W.partitionBy("_key", "_segment").orderBy("_range")))
    successes_before = F.col("_segment") - F.col("_last").isNotNull().cast("int")
    parts = parts.select("_key", "_range", F.coalesce(F.lag("_end").over(by_key), F.lit(0)).alias("_carry"),
                         (successes_before == 0).alias("_reaches_start"))
    if carried is not None:
        old = carried.select(F.struct(key).alias("_key"), F.col("open_run").alias("_open_run"))
        parts = parts.join(old, "_key", "left").withColumn("_carry", F.col("_carry") + F.when(
            F.col("_reaches_start"), F.coalesce("_open_run", F.lit(0))).otherwise(0))

    # The summary goes to the rows where they already are: same key and range, same partitioning.
    rows = rows.join(parts.select("_key", "_range", "_carry"), ["_key", "_range"], "left")
    number = F.when(F.col("_failed") == 1, F.col("_failures") - F.coalesce("_before", -F.col("_carry"))).otherwise(0)
    return rows.select(*attempts.columns, number.cast("bigint").alias("failure_no"))


def decide(numbered: DataFrame, max_retries: int = S.MAX_RETRIES) -> DataFrame:
    """``attempt`` inside the current try and ``action``: done, retry or defer."""
    span = max_retries + 1
    attempt = F.when(F.col("failure_no") == 0, 0).otherwise((F.col("failure_no") - 1) % span + 1)
    return (numbered.withColumn("attempt", attempt.cast("bigint"))
            .withColumn("action", F.when(F.col("attempt") == 0, "done")
                        .when(F.col("attempt") <= max_retries, "retry").otherwise("defer")))


def deferred_requests(decided: DataFrame, key: str, status: Column) -> DataFrame:
    """The deferred pages as records of the listing type."""
    df = decided.filter(F.col("action") == "defer").select(
        F.lit("DeferedRequest").alias("Type"),
        F.col(key).cast("string").alias("RequestUrl"),
        status.cast("int").alias("Raison"))
    return schemas.conform(df, schemas.LISTING_AD)


def open_runs(numbered: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Per key the run of failures its last attempt leaves open (partially aggregated)."""
    last = F.max_by("failure_no", F.struct(*order))
    return numbered.groupBy(key).agg(last.alias("open_run"))


def attempt_counts(attempts: DataFrame, key: str, failed: Column) -> DataFrame:
    """Attempts and failures per page over all time."""
    return attempts.groupBy(key).agg(
        F.count("*").alias("n_attempts"),
        F.count_if(failed).cast("bigint").alias("n_failed"))


def work_list(requests: DataFrame) -> DataFrame:
    """Retries before fresh pages. The URL breaks ties, so that the range split is even."""
    return requests.orderBy(F.desc("priority"), "page_no", "url")
