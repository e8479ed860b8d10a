"""Outcomes of messages and of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.operators.classify import has_work
from pageloom.operators.joins import HOT_ROWS, skew_left_join


def error_counts(log: DataFrame, key: str = "correlation_id",
                 level: str = "level") -> DataFrame:
    """Outcome rows: errors logged per message (combined before the shuffle)."""
    return log.groupBy(key).agg(
        F.count_if(F.col(level) == "ERROR").cast("int").alias("errors"))


def run_summary(log: DataFrame, run: str, level: str = "level", time: str = "ts") -> DataFrame:
    """Per run: log lines, errors, start and finish."""
    return log.groupBy(run).agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col(level) == "ERROR").cast("bigint").alias("n_errors"),
        F.min(time).alias("started_at"), F.max(time).alias("finished_at"))


def settle(messages: DataFrame, outcomes: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``settled``: 'ack', 'skip' (empty address) or 'error'.

    Errors, or no outcome at all, fail the message. Several outcome rows of one message count as
    their worst one, so no message is doubled.
    """
    per_message = outcomes.groupBy("correlation_id").agg(F.max("errors").alias("errors"),
                                                         F.lit(True).alias("_known"))
    joined = skew_left_join(messages, per_message, "correlation_id", hot_rows)
    failed = F.col("_known").isNull() | (F.coalesce("errors", F.lit(0)) > 0)
    return joined.withColumn("settled", F.when(~has_work(F.col("url")), "skip")
                             .when(failed, "error").otherwise("ack")).drop("_known")


def error_rows(settled: DataFrame) -> DataFrame:
    return settled.filter(F.col("settled") == "error")
