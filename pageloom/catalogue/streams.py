"""The stream operators over whole tables, each with the batch SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.catalogue import retrying
from pageloom.catalogue.book import LINKS, Book
from pageloom.operators import specs as S
from pageloom.operators.cards import discover, listing_ads
from pageloom.operators.route import write_routes
from pageloom.operators.settle import settle
from pageloom.session import scratch_dir, written
from pageloom.sources import queues
from pageloom.sources.pages import fetched_pages
from pageloom.streaming.consume import consume, insert_once, once_per_key, publish, runs_so_far
from pageloom.streaming.retry import number_waiting, retry_stream

BOOK = Book()


def _stream(spark, sf_dir, name):
    """A table of the folder as a stream; the pattern matches a file as well as a folder."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


@BOOK.query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS settled,
       event_type AS route
FROM events
""")
def stream_route(spark, sf_dir):
    out = scratch_dir(spark, "stream")

    def process(batch):
        return batch.select("event_id", F.col("event_type").alias("route"), F.when(
            F.col("event_type") == "error", "error").otherwise("ok").alias("settled"))

    consume(_stream(spark, sf_dir, "events"), process, f"{out}/rows", f"{out}/progress",
            ("settled", "route")).awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("event_id", "settled", "route")


@BOOK.query(retrying._SETTLED)
def stream_settle(spark, sf_dir):
    """Messages as a stream, looked up in the outcome table batch by batch."""
    out = scratch_dir(spark, "stream")
    _, outcomes = retrying._messages(spark, sf_dir)

    def process(batch):
        key = F.col("event_id").cast("string")
        url = F.when(F.col("event_id") % 7 == 0, "").otherwise(F.concat(F.lit("/"), key))
        messages = batch.select(key.alias("correlation_id"), url.alias("url"))
        return settle(messages, outcomes)

    consume(_stream(spark, sf_dir, "events"), process, f"{out}/rows",
            f"{out}/progress").awaitTermination()
    return spark.read.parquet(f"{out}/rows").select("correlation_id", "settled")


@BOOK.query(retrying._DEFERRED)
def stream_retry(spark, sf_dir):
    out = scratch_dir(spark, "stream")
    stream = _stream(spark, sf_dir, "events").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
    retry_stream(stream, "user_id", retrying.ORDER, retrying.failed(), out,
                 f"{out}/progress", retrying.MAX_RETRIES).awaitTermination()
    stored = spark.read.parquet(f"{out}/attempts").filter(F.col("action") == "defer")
    return stored.select("event_id", F.col("user_id").cast("string").alias("url"), "action")


#: Events of one file of ``out_of_order``, about.
EVENTS_PER_FILE = 100_000


def out_of_order(events, path, files=8):
    """The events in parts by time, every second one written before the one that it follows; how many files a part has.

    The table is dealt out once. Each part is written by as many tasks as it has files, of some events each."""
    n, marks = events.agg(F.count("*"), F.percentile_approx(F.col("ts").cast("long"), [k / files for k in range(1, files)])).first()
    part = F.size(F.filter(F.array(*map(F.lit, marks or [])), lambda m: m < F.col("ts").cast("long")))
    each = max(1, -(-n // (files * EVENTS_PER_FILE)))
    dealt = written(events.withColumn("part", part).repartition(files * each), "dealt") if each > 1 else events.withColumn("part", part)
    for k in range(files):
        rows = dealt.filter(F.col("part") == k ^ 1).drop("part")
        (rows.repartition(each) if each > 1 else rows.coalesce(1)).write.mode("append").parquet(path)
    return each


@BOOK.query(retrying._DEFERRED)
def stream_retry_late(spark, sf_dir):
    """Attempts that arrive out of order: the same decisions as in order."""
    out = scratch_dir(spark, "stream")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", "event_type")
    files = out_of_order(events, f"{out}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{out}/in")
    rule = ("user_id", retrying.ORDER, retrying.failed(), out, f"{out}/progress", retrying.MAX_RETRIES)
    retry_stream(stream, *rule, lateness="8 days").awaitTermination()
    number_waiting(spark, events.schema, *rule)
    stored = spark.read.parquet(f"{out}/attempts").filter(F.col("action") == "defer")
    return stored.select("event_id", F.col("user_id").cast("string").alias("url"), "action")


@BOOK.query("SELECT user_id, 1::BIGINT AS n FROM (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL)")
def stream_once_per_key(spark, sf_dir):
    """Each key once within a time that all events lie in."""
    out = scratch_dir(spark, "stream")
    stream = _stream(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    publish(once_per_key(stream, "user_id", "ts", "60 days"), f"{out}/rows", f"{out}/progress").awaitTermination()
    return spark.read.parquet(f"{out}/rows").groupBy("user_id").agg(F.count("*").alias("n"))


@BOOK.query(f"""
WITH {LINKS}
SELECT href AS url, CASE WHEN contains(href, 'e') THEN 'ack' ELSE 'error' END AS settled,
       count(*)::BIGINT AS n
FROM links GROUP BY 1, 2
""")
def stream_chain(spark, sf_dir):
    """Stage one publishes the ad URLs found on pages, stage two consumes them."""
    out = scratch_dir(spark, "stream")
    pages = fetched_pages(_stream(spark, sf_dir, "pages"))
    ads = listing_ads(discover(pages, S.PLAIN_LISTING)).select(F.col("AdsUrl").alias("url"))
    publish(ads, f"{out}/ad_urls", f"{out}/progress1").awaitTermination()

    def process(batch):
        return batch.withColumn("settled", F.when(F.col("url").contains("e"), "ack")
                                .otherwise("error"))

    messages = spark.readStream.schema("url STRING").parquet(f"{out}/ad_urls")
    consume(messages, process, f"{out}/rows", f"{out}/progress2").awaitTermination()
    return spark.read.parquet(f"{out}/rows").groupBy("url", "settled").agg(
        F.count("*").alias("n"))


@BOOK.query("""
SELECT user_id, event_id
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events)
WHERE k = 1
""")
def stream_insert_if_absent(spark, sf_dir):
    out = scratch_dir(spark, "stream")
    stream = _stream(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    insert_once(stream, "user_id", ["ts", "event_id"], f"{out}/store",
                f"{out}/progress").awaitTermination()
    return spark.read.parquet(f"{out}/store").select("user_id", "event_id")


_QUEUE = """
SELECT event_id::VARCHAR AS correlation_id, [NULL, '01', '2A'][1 + event_id // 3 % 3] AS cp,
       CASE WHEN event_type = 'error' THEN 'error' ELSE 'ack' END AS settled
FROM events WHERE event_id % 3 = """


def consumed(spark, sf_dir, subscribe, **options):
    """Events as a queue of routes in files ordered by time, consumed some files at a time; the
    settled messages and the number of batches."""
    out = scratch_dir(spark, "stream")
    key = F.col("event_id")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").repartitionByRange(4, "ts", "event_id")
    messages = events.select(
        key.cast("string").alias("correlation_id"), F.concat(F.lit("/"), "event_type").alias("url"),
        F.when(F.floor(key / 3) % 3 == 1, "01").when(F.floor(key / 3) % 3 == 2, "2A").alias("cp"),
        F.when(key % 3 == 0, "luxury").when(key % 3 == 1, "agency").otherwise("general").alias("route"),
        F.col("ts").cast("timestamp").alias("received_at"))
    write_routes(messages, f"{out}/queue")

    def process(batch):
        return batch.withColumn("settled", F.when(F.col("url") == "/error", "error").otherwise("ack"))

    query = consume(subscribe(spark, f"{out}/queue", files_per_batch=4, **options), process,
                    f"{out}/rows", f"{out}/progress")
    query.awaitTermination()
    rows = spark.read.parquet(f"{out}/rows").select("correlation_id", "cp", "settled")
    return rows, len({p["batchId"] for p in query.recentProgress if p["numInputRows"]})


@BOOK.query(_QUEUE + "2 AND event_id // 3 % 3 = 1")
def stream_general_queue(spark, sf_dir):
    """The general ads of one cp."""
    return consumed(spark, sf_dir, queues.general_ads, cp="01")[0]


@BOOK.query(_QUEUE + "0")
def stream_luxury_queue(spark, sf_dir):
    return consumed(spark, sf_dir, queues.luxury_ads)[0]


@BOOK.query(_QUEUE + "1")
def stream_agency_queue(spark, sf_dir):
    return consumed(spark, sf_dir, queues.agency_profiles)[0]


@BOOK.query("""
SELECT count(*)::BIGINT AS n_lines, (count(*) FILTER (event_type = 'error'))::BIGINT AS n_errors,
       epoch_us(min(ts))::BIGINT AS started, epoch_us(max(ts))::BIGINT AS finished
FROM events
""")
def stream_run_log(spark, sf_dir):
    """What a run has done so far, counted batch by batch as it writes."""
    out = scratch_dir(spark, "stream")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    events.repartition(3, "event_id").write.parquet(f"{out}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
    settled = lambda b: b.withColumn("settled", F.when(F.col("event_type") == "error", "error").otherwise("ok"))
    consume(stream, settled, f"{out}/rows", f"{out}/progress", run_log=f"{out}/runs", time="ts").awaitTermination()
    return runs_so_far(spark, f"{out}/runs").select(
        "n_lines", "n_errors", F.unix_micros("started_at").alias("started"), F.unix_micros("finished_at").alias("finished"))
