"""Attempts, retries and settlement on the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalogue.book import Book
from pageloom.operators import retry, settle

BOOK = Book()

ORDER = ["ts", "event_id"]
MAX_RETRIES = 2


def attempts(spark, sf_dir):
    """Each event an attempt to fetch the page of its user; errors are failures."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")


def failed():
    return F.col("event_type") == "error"


_RUNS = """
e AS (SELECT event_id, user_id, ts, event_type = 'error' AS failed,
             count(*) FILTER (event_type <> 'error')
               OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run
      FROM events),
n AS (SELECT *, CASE WHEN failed THEN count(*) FILTER (failed)
               OVER (PARTITION BY user_id, run ORDER BY ts, event_id) ELSE 0 END AS failure_no
      FROM e)
"""

_NUMBERS = f"""
WITH {_RUNS}
SELECT event_id, user_id, failure_no::BIGINT AS failure_no,
       CASE WHEN failure_no = 0 THEN 0 ELSE (failure_no - 1) % {MAX_RETRIES + 1} + 1 END::BIGINT AS attempt
FROM n
"""

_DEFERRED = f"""
WITH {_RUNS}
SELECT event_id, user_id::VARCHAR AS url, 'defer' AS action FROM n
WHERE failed AND failure_no % {MAX_RETRIES + 1} = 0
"""


def _numbered(spark, sf_dir, **options):
    return retry.number_failures(attempts(spark, sf_dir), "user_id", ORDER, failed(), **options)


@BOOK.query(_NUMBERS)
def attempt_numbers(spark, sf_dir):
    return retry.decide(_numbered(spark, sf_dir), MAX_RETRIES) \
        .select("event_id", "user_id", "failure_no", "attempt")


@BOOK.query(_NUMBERS)
def attempt_numbers_split(spark, sf_dir):
    """The same in so many ranges that users are cut."""
    numbered = _numbered(spark, sf_dir, ranges=97)
    return retry.decide(numbered, MAX_RETRIES).select("event_id", "user_id", "failure_no",
                                                      "attempt")


@BOOK.query(_DEFERRED)
def bounded_retry(spark, sf_dir):
    decided = retry.decide(_numbered(spark, sf_dir), MAX_RETRIES)
    return decided.filter(F.col("action") == "defer").select(
        "event_id", F.col("user_id").cast("string").alias("url"), "action")


@BOOK.query(f"""
WITH {_RUNS}
SELECT user_id::VARCHAR AS url, 503::BIGINT AS raison, count(*)::BIGINT AS n FROM n
WHERE failed AND failure_no % {MAX_RETRIES + 1} = 0 GROUP BY user_id
""")
def deferred_requests(spark, sf_dir):
    decided = retry.decide(_numbered(spark, sf_dir), MAX_RETRIES)
    records = retry.deferred_requests(decided, "user_id", F.lit(503))
    return records.groupBy(F.col("RequestUrl").alias("url"),
                           F.col("Raison").cast("bigint").alias("raison")) \
        .agg(F.count("*").alias("n"))


@BOOK.query(f"""
WITH {_RUNS}
SELECT event_id AS page_no, user_id::VARCHAR AS url,
       CASE WHEN failed THEN (failure_no - 1) % {MAX_RETRIES + 1} + 1 ELSE 0 END::BIGINT AS priority
FROM n WHERE NOT failed OR failure_no % {MAX_RETRIES + 1} <> 0
""")
def retry_work_list(spark, sf_dir):
    """Fresh pages and retries in the order they would be handed out."""
    decided = retry.decide(_numbered(spark, sf_dir), MAX_RETRIES)
    requests = decided.filter(F.col("action") != "defer").select(
        F.col("event_id").alias("page_no"), F.col("user_id").cast("string").alias("url"),
        F.col("attempt").alias("priority"))
    return retry.work_list(requests)


@BOOK.query("""
SELECT user_id, count(*)::BIGINT AS n_attempts,
       (count(*) FILTER (event_type = 'error'))::BIGINT AS n_failed
FROM events GROUP BY user_id
""")
def attempt_counts(spark, sf_dir):
    return retry.attempt_counts(attempts(spark, sf_dir), "user_id", failed())


def _log(spark, sf_dir):
    level = F.when(failed(), "ERROR").otherwise("INFO")
    return attempts(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("correlation_id"), level.alias("level"), "ts")


@BOOK.query("""
SELECT user_id::VARCHAR AS correlation_id,
       (count(*) FILTER (event_type = 'error'))::BIGINT AS errors
FROM events GROUP BY user_id
""")
def error_counts(spark, sf_dir):
    counts = settle.error_counts(_log(spark, sf_dir))
    return counts.withColumn("errors", F.col("errors").cast("bigint"))


@BOOK.query("""
SELECT strftime(ts, '%Y-%m-%d') AS run, count(*)::BIGINT AS n_lines,
       (count(*) FILTER (event_type = 'error'))::BIGINT AS n_errors,
       epoch_us(min(ts))::BIGINT AS started, epoch_us(max(ts))::BIGINT AS finished
FROM events GROUP BY 1
""")
def run_summary(spark, sf_dir):
    log = _log(spark, sf_dir).withColumn("run", F.date_format("ts", "yyyy-MM-dd"))
    return settle.run_summary(log, "run").select(
        "run", "n_lines", "n_errors", F.unix_micros("started_at").alias("started"),
        F.unix_micros("finished_at").alias("finished"))


def _messages(spark, sf_dir):
    """Every event a message; each tenth has no outcome, each seventh no address."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    key = F.col("event_id").cast("string")
    url = F.when(F.col("event_id") % 7 == 0, "").otherwise(
        F.concat(F.lit("https://www.example.com/"), key))
    messages = events.select(key.alias("correlation_id"), url.alias("url"), "user_id")
    outcomes = events.filter(F.col("event_id") % 10 != 0).select(
        key.alias("correlation_id"), F.when(F.col("event_id") % 3 != 0, failed().cast("int"))
        .alias("errors"))
    return messages, outcomes


_SETTLED = """
SELECT event_id::VARCHAR AS correlation_id,
       CASE WHEN event_id % 7 = 0 THEN 'skip' WHEN event_id % 10 = 0 THEN 'error'
            WHEN event_id % 3 <> 0 AND event_type = 'error' THEN 'error' ELSE 'ack' END AS settled
FROM events
"""


@BOOK.query(_SETTLED)
def settle_messages(spark, sf_dir):
    messages, outcomes = _messages(spark, sf_dir)
    return settle.settle(messages, outcomes) \
        .select("correlation_id", "settled")


@BOOK.query("""
SELECT user_id::VARCHAR AS correlation_id, event_id,
       CASE WHEN user_id % 10 = 0 OR bad > 60 THEN 'error' ELSE 'ack' END AS settled
FROM (SELECT *, count(*) FILTER (event_type = 'view') OVER (PARTITION BY user_id) - 5 AS n,
             max(value) OVER (PARTITION BY user_id) AS bad FROM events)
""")
def settle_repeated_messages(spark, sf_dir):
    """Many messages per id, those of the heaviest ids left where they are; outcomes are per id."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    key = F.col("user_id").cast("string").alias("correlation_id")
    messages = events.select(key, F.lit("u").alias("url"), "event_id")
    outcomes = events.filter(F.col("user_id") % 10 != 0).select(
        key, (F.col("value") > 60).cast("int").alias("errors"))
    return settle.settle(messages, outcomes, hot_rows=70) \
        .select("correlation_id", "event_id", "settled")
