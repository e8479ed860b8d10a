"""Bounded retry on a stream of attempts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pageloom.operators import specs as S
from pageloom.operators.commits import Commits
from pageloom.operators.retry import decide, number_failures, open_runs
from pageloom.operators.store import committed_rows, stored_rows, write_batch
from pageloom.streaming.consume import stream_id


def retry_stream(attempts: DataFrame, key: str, order: list[str], failed: Column,
                 path: str, checkpoint: str, max_retries: int = S.MAX_RETRIES,
                 ranges: int | None = None, available_now: bool = True,
                 lateness: str | None = None) -> StreamingQuery:
    """Store each attempt with its ``action`` under ``path/attempts``.

    The open runs that a batch leaves are a small table, ``path/state``, one snapshot per batch
    with failing pages only; the next batch continues them. The numbering inside a batch is the
    batch operator, so a page with very many attempts is split over tasks here as well, which
    state kept per key inside one task could not do. Snapshot and attempts are replaced, not
    doubled, when a batch is replayed.

    With ``lateness`` ('10 minutes') attempts may arrive out of order by so much: an attempt waits, as
    part of the snapshot, until the first of ``order``, its time, lies that far behind the latest time seen.
    Those that no longer wait are numbered together, in order. One that is later still is numbered among
    the ones it is ripe with. ``number_waiting`` numbers what still waits when a stream has ended.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = stream_id(spark, checkpoint)
        left = _left_before(spark, path, stream, batch_id)
        if left is None:  # what other streams left open, if any did
            stored = stored_rows(spark, f"{path}/attempts", but=(stream, batch_id))
            runs = None if stored is None else open_runs(stored, key, order).filter("open_run > 0")
            _number(batch, runs, None, batch_id, stream, stream)
        else:
            _number(_and(_waiting(left[0], batch), batch), _runs(left[0], key), left[1], batch_id, stream, stream)

    def _number(found: DataFrame, runs: DataFrame | None, seen: datetime | None, batch_id: int, stream: str,
                as_stream: str) -> None:
        _number_ripe(found, runs, seen, key, order, failed, path, batch_id, stream, as_stream, max_retries, ranges, lateness)

    writer = attempts.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def number_waiting(spark: SparkSession, schema, key: str, order: list[str], failed: Column, path: str,
                   checkpoint: str, max_retries: int = S.MAX_RETRIES, ranges: int | None = None) -> None:
    """Number the attempts (of this ``schema``) that a stream has left waiting, when no earlier ones can come."""
    stream = stream_id(spark, checkpoint)
    last = max((r.batch_id for r in Commits(spark, f"{path}/state/_commits").live() if r.stream == stream), default=None)
    if last is None:
        return
    rows, seen = _left_before(spark, path, stream, last + 1)
    waiting = _waiting(rows, spark.createDataFrame([], schema))
    if waiting is not None and not waiting.isEmpty():
        # Stored apart from the batch's own; its snapshot is replaced by one in which nothing waits.
        _number_ripe(waiting, _runs(rows, key), seen, key, order, failed, path, last, stream, f"{stream}-rest",
                     max_retries, ranges, None)


def _number_ripe(found: DataFrame, runs: DataFrame | None, seen: datetime | None, key: str, order: list[str],
                 failed: Column, path: str, batch_id: int, stream: str, as_stream: str, max_retries: int,
                 ranges: int | None, lateness: str | None) -> None:
    """Number what needs to wait no longer, store it, and take the snapshot of what is left."""
    spark, span, waiting = found.sparkSession, max_retries + 1, None
    if lateness is not None:
        latest = found.agg(F.max(order[0])).first()[0]
        seen = max(filter(None, (seen, latest)), default=None)
        until = F.lit(seen) - F.expr(f"INTERVAL {lateness}")
        waits = F.coalesce(F.col(order[0]) > until, F.lit(False))
        found, waiting = found.filter(~waits), found.filter(waits)
    numbered = number_failures(found, key, order, failed, runs, ranges)
    write_batch(decide(numbered, max_retries), f"{path}/attempts", batch_id, ["action"], stream=as_stream)
    stored = committed_rows(spark, f"{path}/attempts", as_stream, batch_id)
    state = runs
    if stored is not None:
        state = open_runs(stored, key, order)
        if runs is not None:
            state = (state.join(runs.withColumnRenamed("open_run", "_old"), key, "full_outer")
                     .select(key, F.coalesce("open_run", "_old").alias("open_run")))
    snapshot = None
    if state is not None:
        # Runs repeat their decisions every span failures, so only the remainder matters.
        state = state.withColumn("open_run", F.col("open_run") % span).filter("open_run > 0")
        snapshot = state.withColumn("kind", F.lit("run"))
    if waiting is not None:
        waiting = waiting.withColumn("kind", F.lit("waits"))
        snapshot = waiting if snapshot is None else snapshot.unionByName(waiting, allowMissingColumns=True)
    if snapshot is None:
        snapshot = found.limit(0).select(key, F.lit(0).cast("bigint").alias("open_run"), F.lit("run").alias("kind"))
    write_batch(snapshot, f"{path}/state", batch_id, ["kind"], stream=stream, upto=seen)


def _left_before(spark: SparkSession, path: str, stream: str, batch_id: int) -> tuple[DataFrame | None, datetime | None] | None:
    """The snapshot of the batch before, its rows and the latest time seen; None for a stream's first batch."""
    for r in Commits(spark, f"{path}/state/_commits").live():
        if (r.stream, r.batch_id) == (stream, batch_id - 1):
            return committed_rows(spark, f"{path}/state", stream, batch_id - 1), r.upto
    return None


def _runs(snapshot: DataFrame | None, key: str) -> DataFrame | None:
    if snapshot is None or "open_run" not in snapshot.columns:
        return None
    return snapshot.filter("kind = 'run'").select(key, "open_run")


def _waiting(snapshot: DataFrame | None, like: DataFrame) -> DataFrame | None:
    if snapshot is None or not set(like.columns) <= set(snapshot.columns):
        return None
    return snapshot.filter("kind = 'waits'").select(*like.columns)


def _and(some: DataFrame | None, batch: DataFrame) -> DataFrame:
    return batch if some is None else some.unionByName(batch)
