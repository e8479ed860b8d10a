"""Consume, process, settle; chain stages; insert once."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pageloom.operators.store import committed_rows, insert_rows, write_batch

RUN = "run string, n_lines bigint, n_errors bigint, started_at timestamp, finished_at timestamp"


def consume(stream: DataFrame, process: Callable[[DataFrame], DataFrame], path: str,
            checkpoint: str, partition_by: Sequence[str] = ("settled",),
            available_now: bool = True, run_log: str | None = None, time: str | None = None) -> StreamingQuery:
    """Process each batch and store its rows, good and bad ones, in a single write.

    With ``run_log`` each batch also leaves a row there, counted while it is written: how many rows, how many
    settled as errors, and the first and last ``time``; see ``runs_so_far``.

    ``process`` adds the ``partition_by`` columns, such as the settlement or the route. A batch is
    acknowledged by its checkpoint only after the write; if it fails, it is replayed and takes the place
    of what it wrote before, in one commit, so each message is in exactly one place at any time.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        stream, rows, counts = stream_id(batch.sparkSession, checkpoint), process(batch), None
        if run_log:
            counts = Observation(f"{stream}-{batch_id}")
            at = F.col(time).cast("timestamp") if time else F.lit(None).cast("timestamp")
            rows = rows.observe(counts, F.count(F.lit(1)).alias("n_lines"),
                                F.count_if(F.col("settled") == "error").alias("n_errors"),
                                F.min(at).alias("started_at"), F.max(at).alias("finished_at"))
        write_batch(rows, path, batch_id, partition_by, stream=stream)
        if counts:
            row = [(stream, *(counts.get[c] for c in ("n_lines", "n_errors", "started_at", "finished_at")))]
            write_batch(batch.sparkSession.createDataFrame(row, RUN), run_log, batch_id, stream=stream)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def runs_so_far(spark: SparkSession, run_log: str) -> DataFrame:
    """Per run (one per checkpoint): rows, errors, start and finish, of the batches that are stored by now."""
    rows = committed_rows(spark, run_log)
    rows = spark.createDataFrame([], RUN) if rows is None else rows
    return rows.groupBy("run").agg(F.sum("n_lines").alias("n_lines"), F.sum("n_errors").alias("n_errors"),
                                   F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"))


def publish(stream: DataFrame, path: str, checkpoint: str,
            available_now: bool = True) -> StreamingQuery:
    """Append to a stage table that a later stream reads; its file log makes that exactly once."""
    writer = (stream.writeStream.format("parquet").option("path", path)
              .option("checkpointLocation", checkpoint).outputMode("append"))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps with a checkpoint: the same after a restart, another one for another
    checkpoint, even a fresh one in the same place."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def insert_once(stream: DataFrame, key: str, order: Sequence[str], path: str, checkpoint: str,
                available_now: bool = True) -> StreamingQuery:
    """Append rows whose key is not stored yet, by an earlier batch or by anyone else before.

    Streams that insert into one store at the same time could both miss the other's rows: let one at
    a time write. Rows that other writers put there, not by a stream of this kind, are looked for when the
    stream starts. A batch reads neither the store nor the whole index of its keys, see ``insert_rows``.
    """
    others = True

    def run(batch: DataFrame, batch_id: int) -> None:
        nonlocal others
        insert_rows(batch, path, key, order, batch_id, stream_id(batch.sparkSession, checkpoint), others)
        others = False

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def once_per_key(stream: DataFrame, key: str, time: str, within: str, known: int = 100_000) -> DataFrame:
    """The rows of a stream whose key has not come up ``within`` ('7 days') of event time, in memory of
    bounded size: what is known of a key expires once the watermark has passed its time and that much more.

    Where ``insert_once`` asks the store, whatever its age, this asks only the state, so it stores nothing
    and a key may come again later. Rows without a key are left out. A task passes on each key once at most
    before the shuffle (as long as it has seen no more than ``known`` keys), so a hot key is no hot task.
    """
    def first_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for b in batches:
            keep = []
            for value in b.column(key).to_pylist():
                keep.append(value not in seen)
                seen.add(value)
            if len(seen) > known:
                seen = set()
            yield b.filter(pa.array(keep, pa.bool_()))

    rows = stream.filter(stream[key].isNotNull())
    return (rows.mapInArrow(first_of_task, rows.schema).withWatermark(time, within)
            .dropDuplicatesWithinWatermark([key]))
