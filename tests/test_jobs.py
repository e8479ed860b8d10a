"""Retry, settlement, stores, sources and streams."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pageloom import schemas
from pageloom.catalogue import streams
from pageloom.operators import retry, route, settle, store
from pageloom.operators.joins import hot_keys, skew_left_join
from pageloom.sources import frontier, json_docs, queues, seeds
from pageloom.streaming.consume import consume, insert_once, once_per_key, publish
from pageloom.streaming.retry import number_waiting, retry_stream

T0 = datetime(2024, 1, 1)
ORDER = ["attempt_ts", "n_records"]


def failed():
    return F.col("outcome") != "ok"


def attempts(spark, runs):
    """``{'a': 'xxo'}``: x failed, o went well; a minute apart. n_records numbers the attempts."""
    rows = [(key, T0 + timedelta(minutes=i), 404, i, "ok" if c == "o" else "empty")
            for key, run in runs.items() for i, c in enumerate(run)]
    return spark.createDataFrame(rows, schemas.FETCH_ATTEMPT)


def brute(run):
    numbers, n = [], 0
    for c in run:
        n = 0 if c == "o" else n + 1
        numbers.append(n)
    return numbers


def numbers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r.n_records):
        out.setdefault(r.origin_url, []).append(r.failure_no)
    return out


def test_deferral_after_six_failures_in_a_row(spark):
    runs = {"once": "o", "five": "xxxxxo", "six": "xxxxxx", "twelve": "x" * 12, "broken": "xoxxxxx"}
    df = retry.number_failures(attempts(spark, runs), "origin_url", ORDER, failed())
    gone = retry.deferred_requests(retry.decide(df), "origin_url", F.col("status"))
    counts = {r.RequestUrl: r["count"] for r in gone.groupBy("RequestUrl").count().collect()}
    assert counts == {"six": 1, "twelve": 2}
    assert {(r.Type, r.Raison) for r in gone.collect()} == {("DeferedRequest", 404)}


@pytest.mark.parametrize("ranges", [None, 1, 3, 40, 200])
def test_numbering_in_ranges_equals_brute_force(spark, ranges):
    rng = random.Random(ranges or 0)
    runs = {f"k{i}": "".join(rng.choice("xxxo" if i % 2 else "xxxxxxxxxxo")
                             for _ in range(rng.randint(1, 60))) for i in range(12)}
    runs[None] = "xxxoxx" * 9
    df = retry.number_failures(attempts(spark, runs), "origin_url", ORDER, failed(),
                               ranges=ranges)
    assert numbers(df) == {k: brute(run) for k, run in runs.items()}


def test_numbering_continues_a_carried_run(spark):
    carried = spark.createDataFrame([("a", 2), ("b", 3), ("z", 1)], "origin_url string, open_run long")
    for ranges in (None, 9):
        df = retry.number_failures(attempts(spark, {"a": "xxox", "b": "ox", "c": "x"}), "origin_url",
                                   ORDER, failed(), carried, ranges)
        assert numbers(df) == {"a": [3, 4, 0, 1], "b": [0, 1], "c": [1]}


def test_work_list_puts_retries_first(spark):
    rows = spark.createDataFrame([("a", 2, 0), ("b", 1, 0), ("c", 9, 3), ("d", 8, 1)],
                                 "url string, page_no int, priority int")
    assert [r.url for r in retry.work_list(rows).collect()] == ["c", "d", "b", "a"]


def test_settlement(spark):
    messages = spark.createDataFrame(
        [("1", "u"), ("2", "u"), ("3", "u"), ("4", "u"), ("5", ""), ("6", None), ("3", "u"), (None, "u")],
        "correlation_id string, url string")
    outcomes = spark.createDataFrame([("1", 0), ("2", None), ("3", 1), ("3", 0), ("5", 1)],
                                     "correlation_id string, errors int")
    for hot_rows in (10**6, 1):
        rows = settle.settle(messages, outcomes, hot_rows=hot_rows).collect()
        assert sorted((r.correlation_id or "", r.settled) for r in rows) == [
            ("", "error"), ("1", "ack"), ("2", "ack"), ("3", "error"), ("3", "error"),
            ("4", "error"), ("5", "skip"), ("6", "skip")]


def test_join_with_hot_keys_equals_plain_join(spark):
    left = spark.range(3000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN "
                                        "NULL ELSE concat('k', id % 50) END AS url")
    right = spark.range(40).selectExpr("concat('k', id) AS url", "id AS v").union(
        spark.sql("SELECT 'hot', 99L"))
    got = skew_left_join(left, right, "url", hot_rows=500)
    want = left.join(right, "url", "left")
    assert sorted(map(repr, got.select("id", "url", "v").collect())) == sorted(
        map(repr, want.select("id", "url", "v").collect()))
    assert [tuple(r) for r in hot_keys(left, "url", 500).collect()] == [("hot", 1000)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rightHint=(strategy=broadcast)") >= 3  # rows of hot keys meet their partner where they are
    assert [r.url for r in hot_keys(left, "url", 1, most=3).collect()][0] == "hot" and hot_keys(left, "url", 1, 3).count() == 3
    assert sorted(map(repr, skew_left_join(left, right, "url").select("id", "url", "v").collect())) == sorted(
        map(repr, want.select("id", "url", "v").collect()))


def test_errors_and_runs_are_counted(spark):
    log = spark.createDataFrame([("r1", "m", "ERROR", T0), ("r1", "m", "INFO", T0 + timedelta(1)),
                                 ("r2", "n", "INFO", T0)],
                                "run string, correlation_id string, level string, ts timestamp")
    assert {r.correlation_id: r.errors for r in settle.error_counts(log).collect()} == {"m": 1, "n": 0}
    runs = {r.run: (r.n_lines, r.n_errors, r.finished_at) for r in settle.run_summary(log, "run").collect()}
    assert runs == {"r1": (2, 1, T0 + timedelta(1)), "r2": (1, 0, T0)}


def test_insert_only_absent_keys_once(spark):
    new = spark.createDataFrame([("a", 2), ("a", 1), ("b", 1), (None, 1)], "k string, v int")
    old = spark.createDataFrame([("b",)], "k string")
    assert [tuple(r) for r in store.insert_if_absent(new, old, "k", ["v"]).collect()] == [("a", 1)]


def test_lookup_keeps_requests_without_page_and_refuses_bodies(spark):
    pages = spark.createDataFrame([("u1", "t")], "url string, title string")
    requests = spark.createDataFrame([("u1", 1), ("u2", 2)], "url string, id int")
    rows = store.lookup_pages(requests, pages).collect()
    assert sorted((r.id, r.fetched, r.title) for r in rows) == [(1, True, "t"), (2, False, None)]
    with pytest.raises(ValueError):
        store.lookup_pages(requests, pages.withColumn("html", F.lit("")))


def test_frontier(spark):
    params = spark.createDataFrame([("75",), ("34",)], "cp string")
    urls = frontier.general_listing_urls(params)
    assert urls.count() == 398
    assert urls.filter("cp = '75' AND page_no = 199").first().url == (
        "https://www.seloger.com/list.htm?tri=initial&idtypebien=2,1&idtt=2,5&naturebien=1,2,4&cp=75"
        "&LISTING-LISTpg=199")
    luxury = [r.url for r in frontier.luxury_default_urls(spark).orderBy("page_no").collect()]
    assert len(luxury) == 5 and luxury[0] == (
        "https://www.bellesdemeures.com/recherche?ci=750115&tri=Selection&idtt=2&page=1")
    twice = urls.union(urls).withColumn("is_retry", F.col("page_no") == 1)
    assert frontier.distinct_requests(twice, F.col("is_retry")).count() == 396 + 4


def test_seed_list(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("https://a/agency-66070.htm\n\n https://b \r\nhttps://b\n")
    urls = seeds.seed_urls(spark, str(tmp_path))
    assert sorted(r.url for r in urls.collect()) == ["https://a/agency-66070.htm", "https://b",
                                                     "https://b"]
    assert {r.route for r in seeds.seed_fanout(urls).collect()} == {"agency"}


def test_json_files(spark, tmp_path):
    record = '{"Type": "SmallAds", "AdsWebId": "annonce-1", "AdsPrice": "750\\u00a0000 €"}'
    (tmp_path / "a.json").write_text('{\n"ads":[\n' + record + "\n," + record + "\n]\n}")
    rows = json_docs.read_ads_files(spark, str(tmp_path / "a.json"), multi_line=True).collect()
    assert [(r.AdsWebId, r.AdsUrl, r.Time) for r in rows] == [("annonce-1", None, None)] * 2
    (tmp_path / "b.json").write_text("[" * 41)
    bad = json_docs.read_records(spark, str(tmp_path / "b.json")).collect()
    assert [r["_corrupt_record"] for r in bad] == ["[" * 41]
    cut = '{"ads": [' + record[:40]
    (tmp_path / "c.json").write_text('{"ads": [' + record + "]}\n" + cut + '\n{"ads": []}\n')
    rows = json_docs.read_ads_files(spark, str(tmp_path / "c.json")).collect()
    assert {(r.AdsWebId, r["_corrupt_record"]) for r in rows} >= {("annonce-1", None)}
    assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"]] == [cut]


def test_routes_keep_leading_zeros(spark, tmp_path):
    rows = [("u1", "general", "01"), ("u2", "general", "2A"), ("u3", "luxury", None), ("u4", "luxury", "75")]
    route.write_routes(spark.createDataFrame(rows, "url string, route string, cp string"), str(tmp_path / "r"))
    assert sorted(route.read_routes(spark, str(tmp_path / "r")).collect()) == rows


def write(df, path, name):
    df.coalesce(1).write.mode("append").parquet(f"{path}/{name}")


def test_retry_stream_over_batches_equals_batch(spark, tmp_path):
    rng = random.Random(5)
    runs = {f"k{i}": "".join(rng.choice("xxxxo") for _ in range(30)) for i in range(6)}
    whole = attempts(spark, runs)
    progress, out = str(tmp_path / "p"), str(tmp_path / "out")
    source = str(tmp_path / "in")
    for lo, hi in ((0, 7), (7, 8), (8, 20), (20, 30)):
        write(whole.filter(F.col("n_records").between(lo, hi - 1)), source, "part")
        stream = spark.readStream.schema(whole.schema).parquet(f"{source}/part")
        retry_stream(stream, "origin_url", ORDER, failed(), out, progress,
                     max_retries=2, ranges=5).awaitTermination()
    want = retry.decide(retry.number_failures(whole, "origin_url", ORDER, failed()), 2)
    key = ["origin_url", "n_records", "action"]
    got = spark.read.parquet(f"{out}/attempts").select(*key).collect()
    assert sorted(got) == sorted(want.select(*key).collect())
    assert sum(r.action == "defer" for r in got) > 3


def test_attempts_out_of_order_are_numbered_in_order(spark, tmp_path):
    rng = random.Random(6)
    runs = {f"k{i}": "".join(rng.choice("xxxxo") for _ in range(40)) for i in range(5)}
    whole = attempts(spark, runs)
    progress, out, source = str(tmp_path / "p"), str(tmp_path / "out"), str(tmp_path / "in")
    rule = ("origin_url", ORDER, failed(), out, progress, 2)
    for lo, hi in ((10, 20), (0, 10), (25, 33), (20, 25), (33, 40)):  # never later than 25 minutes
        write(whole.filter(F.col("n_records").between(lo, hi - 1)), source, "part")
        stream = spark.readStream.schema(whole.schema).parquet(f"{source}/part")
        retry_stream(stream, *rule, ranges=3, lateness="25 minutes").awaitTermination()
    stored = spark.read.parquet(f"{out}/attempts")
    assert 0 < stored.count() < 200  # the last ones wait
    for _ in range(2):  # again: nothing is left
        number_waiting(spark, whole.schema, *rule)
    want = retry.decide(retry.number_failures(whole, "origin_url", ORDER, failed()), 2)
    key = ["origin_url", "n_records", "action"]
    got = spark.read.parquet(f"{out}/attempts").select(*key).collect()
    assert sorted(got) == sorted(want.select(*key).collect())
    # The stream goes on with the runs that are open.
    more = spark.createDataFrame([("k0", T0 + timedelta(hours=9, minutes=i), 404, 40 + i, "empty") for i in range(3)],
                                 schemas.FETCH_ATTEMPT)
    write(more, source, "part")
    retry_stream(spark.readStream.schema(whole.schema).parquet(f"{source}/part"), *rule).awaitTermination()
    want = retry.decide(retry.number_failures(whole.union(more), "origin_url", ORDER, failed()), 2)
    got = spark.read.parquet(f"{out}/attempts").select(*key).collect()
    assert sorted(got) == sorted(want.select(*key).collect())


def test_keys_come_once_while_they_are_remembered(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema, known = "k string, at timestamp, n int", []
    days = [("a", 0), ("b", 0), ("a", 0), ("c", 1), ("a", 1), (None, 1), ("d", 40), ("e", 90), ("a", 91)]
    for n, (key, day) in enumerate(days):
        write(spark.createDataFrame([(key, T0 + timedelta(days=day, minutes=n), n)] * 3, schema), source, "part")
        stream = spark.readStream.schema(schema).parquet(f"{source}/part")
        query = publish(once_per_key(stream, "k", "at", "2 days"), out, str(tmp_path / "p"))
        query.awaitTermination()
        known += [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    got = sorted((r.k, r.n) for r in spark.read.parquet(out).collect())
    assert got == [("a", 0), ("a", 8), ("b", 1), ("c", 3), ("d", 6), ("e", 7)]  # a is forgotten after its time
    assert max(known) <= 4 and known[-1] <= 2


def test_a_hot_key_is_one_row_a_task_before_the_shuffle(spark, tmp_path):
    spark.range(60_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id % 50)) AS k", "timestamp_seconds(id) AS at") \
        .repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, at timestamp").parquet(str(tmp_path / "in"))
    query = publish(once_per_key(stream, "k", "at", "2 days"), str(tmp_path / "out"), str(tmp_path / "p"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 51
    taken = sum(s["numRowsUpdated"] + s["customMetrics"].get("numDroppedDuplicateRows", 0)
                for p in query.recentProgress for s in p["stateOperators"])
    assert 51 <= taken <= 51 * 8


def test_replayed_batch_replaces_its_rows(spark, tmp_path):
    path = str(tmp_path / "rows")
    for _ in range(2):
        store.write_batch(spark.range(5).withColumn("settled", F.lit("error")), path, 3, ["settled"])
    store.write_batch(spark.range(2).withColumn("settled", F.lit("ack")), path, 3, ["settled"])
    rows = spark.read.parquet(path)
    assert rows.count() == 2 and rows.filter("settled = 'error'").count() == 0


def test_consume_chain_and_insert_once(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    messages = [("1", "a", "75", "general", T0), ("2", "b", "75", "luxury", T0),
                ("3", "a", "34", "general", T0), ("4", "", "75", "general", T0)]
    seen = 0
    for batch in (messages[:2], messages[2:]):
        df = spark.createDataFrame(batch, schemas.MESSAGE)
        df.write.mode("append").partitionBy("route", "cp").parquet(p("queue"))
        stream = queues.subscribe(spark, p("queue"))
        publish(stream.select("correlation_id", "url"), p("stage"), p("c1")).awaitTermination()
        stage = spark.readStream.schema("correlation_id string, url string").parquet(p("stage"))
        consume(stage, lambda b: b.withColumn("settled", F.when(F.col("url") == "", "skip")
                                              .otherwise("ack")), p("rows"), p("c2")).awaitTermination()
        insert_once(stage.filter("url <> ''"), "url", ["correlation_id"], p("store"),
                    p("c3")).awaitTermination()
        seen += len(batch)
        assert spark.read.parquet(p("rows")).count() == seen
    rows = spark.read.parquet(p("rows"))
    assert {r.correlation_id: r.settled for r in rows.collect()} == {
        "1": "ack", "2": "ack", "3": "ack", "4": "skip"}
    stored = spark.read.parquet(p("store")).collect()
    assert sorted((r.url, r.correlation_id) for r in stored) == [("a", "1"), ("b", "2")]
    general = queues.general_ads(spark, p("queue"), "75")
    assert general.isStreaming and queues.luxury_ads(spark, p("queue")).isStreaming
    assert queues.agency_profiles(spark, p("queue")).isStreaming


def test_streams_leave_what_others_stored(spark, tmp_path):
    p = lambda name: str(tmp_path / name)

    def run(action, rows, n):
        spark.createDataFrame(rows, "k string, n int").write.parquet(p(f"in{n}"))
        action(spark.readStream.schema("k string, n int").parquet(p(f"in{n}")), p(f"c{n}")).awaitTermination()

    insert = lambda stream, c: insert_once(stream, "k", ["n"], p("store"), c)
    store.append_documents(spark.createDataFrame([("a", 0)], "k string, n int"), p("store"))
    run(insert, [("a", 1), ("b", 1)], 1)
    run(insert, [("b", 2), ("c", 2)], 2)  # another checkpoint, batch 0 once more
    got = store.stored_rows(spark, p("store")).select("k", "n").collect()
    assert sorted(map(tuple, got)) == [("a", 0), ("b", 1), ("c", 2)]

    keep = lambda stream, c: consume(stream, lambda b: b.withColumn("settled", F.lit("ack")), p("rows"), c)
    run(keep, [("a", 1)], 3)
    run(keep, [("b", 1)], 4)
    assert sorted(r.k for r in spark.read.parquet(p("rows")).collect()) == ["a", "b"]
    assert store.stored_rows(spark, p("nowhere")) is None


def test_retries_go_on_with_a_fresh_checkpoint(spark, tmp_path):
    whole = attempts(spark, {"k": "xxx"})
    out, source = str(tmp_path / "out"), str(tmp_path / "in")
    for n in range(3):
        write(whole.filter(F.col("n_records") == n), source, f"part{n}")
        stream = spark.readStream.schema(whole.schema).parquet(f"{source}/part{n}")
        retry_stream(stream, "origin_url", ORDER, failed(), out, str(tmp_path / f"p{n}"),
                     max_retries=2).awaitTermination()
    got = {r.n_records: r.action for r in spark.read.parquet(f"{out}/attempts").collect()}
    assert len(got) == 3 and got[2] == "defer"


def test_lookup_takes_the_latest_fetch(spark):
    requests = spark.createDataFrame([("u",), ("v",)], "url string")
    pages = spark.createDataFrame([("u", T0, 1), ("u", T0.replace(year=T0.year + 1), 2)],
                                  "url string, fetched_at timestamp, n int")
    got = store.lookup_pages(requests, pages).collect()
    assert {r.url: (r.n, r.fetched) for r in got} == {"u": (2, True), "v": (None, False)} and len(got) == 2


def test_documents_are_appended_to_a_created_table(spark, tmp_path):
    df = spark.range(3).selectExpr("id", "cast(null AS string) AS n", "id % 2 AS d")
    for _ in range(2):
        store.append_documents(df, str(tmp_path / "t"), "json")
        store.append_documents(df, str(tmp_path / "q"), partition_by=["d"])
    lines = spark.read.text(str(tmp_path / "t")).collect()
    assert len(lines) == 6 and '"n":null' in lines[0].value
    assert spark.read.parquet(str(tmp_path / "q")).count() == 6


def test_queue_bodies_are_urls_or_objects(spark):
    raw = spark.createDataFrame(
        [("https://a.example/1", [("message-id", b"m1")]), ('{"url": "https://a.example/2", "correlation_id": "m2", "cp": "01"}', None),
         ("{broken", [("message-id", b"m3")]), ("no address", []), ("", [("other", b"x")]), (None, None)],
        "value STRING, headers ARRAY<STRUCT<key: STRING, value: BINARY>>").selectExpr(
        "CAST(value AS BINARY) AS value", "headers", "TIMESTAMP '2024-01-01' AS timestamp")
    rows = [(r["correlation_id"], r["url"], r["cp"], r["corrupt_body"]) for r in queues.parse_messages(raw).collect()]
    assert rows == [("m1", "https://a.example/1", None, None), ("m2", "https://a.example/2", "01", None),
                    ("m3", None, None, "{broken"), (None, None, None, "no address"), (None, None, None, None),
                    (None, None, None, None)]


def test_queue_is_consumed_in_several_batches(spark):
    rows, batches = streams.consumed(spark, "/root/testdata/sf0.001", queues.luxury_ads)
    assert batches >= 3
    assert {r["cp"] for r in rows.select("cp").distinct().collect()} == {None, "01", "2A"}


def test_parts_out_of_order_are_written_in_files_of_some_events(spark, tmp_path, monkeypatch):
    from pageloom.catalogue import streams
    monkeypatch.setattr(streams, "EVENTS_PER_FILE", 10)
    events = spark.range(400).selectExpr("id AS event_id", "timestamp_seconds(id) AS ts", "nullif(id % 7, 0) AS user_id")
    events = events.union(events.limit(3)).coalesce(1)
    assert streams.out_of_order(events, str(tmp_path / "in")) == 6
    back = spark.read.parquet(str(tmp_path / "in"))
    assert sorted(map(str, back.collect())) == sorted(map(str, events.collect()))
    sizes = back.groupBy("_metadata.file_path").count().collect()
    assert len(sizes) > 8 and max(r["count"] for r in sizes) <= 30
