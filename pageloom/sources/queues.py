"""Message queues as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom import schemas


def subscribe(spark: SparkSession, path: str, route: str | None = None, cp: str | None = None,
              files_per_batch: int = 64, schema: str = schemas.MESSAGE) -> DataFrame:
    """Messages of one route (and cp). A table written by ``partitionBy(route, cp)`` is pruned.

    ``files_per_batch`` caps what one batch takes from the queue.
    """
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
              .parquet(path))
    if route is not None:
        stream = stream.filter(F.col("route") == route)
    if cp is not None:
        stream = stream.filter(F.col("cp") == cp)
    return stream


def general_ads(spark: SparkSession, path: str, cp: str, **options) -> DataFrame:
    return subscribe(spark, path, "general", cp, **options)


def luxury_ads(spark: SparkSession, path: str, **options) -> DataFrame:
    """All luxury messages, whichever site found them and whatever their cp."""
    return subscribe(spark, path, "luxury", **options)


def agency_profiles(spark: SparkSession, path: str, **options) -> DataFrame:
    return subscribe(spark, path, "agency", **options)


def kafka_messages(spark: SparkSession, servers: str, topic: str,
                   offsets_per_batch: int = 1_000_000) -> DataFrame:
    """The same messages from Kafka; needs Spark's Kafka package on the class path."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).option("includeHeaders", True)
           .option("maxOffsetsPerTrigger", offsets_per_batch).load())
    return parse_messages(raw)


def parse_messages(raw: DataFrame) -> DataFrame:
    """Messages out of ``value``, ``headers`` and ``timestamp``, and ``corrupt_body``.

    A body is a JSON object with the fields of a message, or the bare URL. The id in the header
    ``message-id``, if there is one, is the message's. A body that is neither keeps its text in
    ``corrupt_body`` and has no URL, for the error route; a queue's empty body has no URL either.
    """
    body = F.trim(F.col("value").cast("string"))
    ids = F.filter("headers", lambda h: h["key"] == "message-id")
    df = raw.select(
        body.alias("_body"), F.from_json(body, schemas.MESSAGE).alias("_m"),
        F.get(ids, F.lit(0))["value"].cast("string").alias("_id"), F.col("timestamp").alias("_at"))
    bare = ~F.startswith("_body", F.lit("{")) & F.regexp_like("_body", F.lit("^[A-Za-z][A-Za-z0-9+.-]*://\\S+$"))
    url = F.when(bare, F.col("_body")).otherwise(F.col("_m.url"))
    return df.select(
        F.coalesce("_id", "_m.correlation_id").alias("correlation_id"), url.alias("url"),
        F.col("_m.cp").alias("cp"), F.col("_m.route").alias("route"),
        F.coalesce("_m.received_at", "_at").alias("received_at"),
        F.when(url.isNull() & (F.length("_body") > 0), F.col("_body")).alias("corrupt_body"))
