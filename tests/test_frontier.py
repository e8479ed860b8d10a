"""Canonical URLs, requests over a whole crawl, run logs."""

from datetime import datetime, timedelta
from urllib.parse import parse_qsl, unquote, urlsplit

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pageloom.functions.urls import canonical
from pageloom.operators import settle
from pageloom.operators.key_index import KeyIndex
from pageloom.sources.frontier import unseen_requests
from pageloom.streaming.consume import RUN, consume, runs_so_far


@pytest.mark.parametrize("url, want", [
    ("HTTP://Ex.com:80", "http://ex.com/"),
    ("https://A@B.c:443/x%7e%2f?b=2&a=1&&#f", "https://A@b.c/x~%2F?a=1&b=2"),
    ("http://x/?", "http://x/"), ("http://x/#a?b", "http://x/"), ("http://x?b&a", "http://x/?a&b"),
    ("http://x/a?q=%41b&q=1", "http://x/a?q=1&q=Ab"), ("https://h:8443/p", "https://h:8443/p"),
    ("http://h/p?b=%zz%", "http://h/p?b=%zz%"), ("http://x/%e4%BD", "http://x/%E4%BD"),
    ("mailto:a@b", "mailto:a@b"), ("no url", "no url"), ("", ""), (None, None),
])
def test_canonical_urls(evaluate, url, want):
    assert evaluate(canonical("s"), [url]) == [want]


@settings(max_examples=1, deadline=None)
@given(st.data())
def test_canonical_urls_ask_for_the_same(spark, data):
    part = st.text("aB1-~%/é&=", max_size=6)
    urls = [f"http://H{i}.example/{data.draw(part)}?{data.draw(part)}&{data.draw(part)}#x" for i in range(60)]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").selectExpr("u", f"{canonical('u')} AS c")
    for r in rows.selectExpr("u", "c", f"{canonical('c')} AS cc").collect():
        assert r.c == r.cc  # once is enough
        a, b = urlsplit(r.u), urlsplit(r.c)
        assert unquote(a.path) == unquote(b.path) and a.netloc.lower() == b.netloc and not b.fragment
        assert sorted(parse_qsl(a.query, True)) == sorted(parse_qsl(b.query, True))


def test_each_url_is_asked_for_once_in_a_crawl(spark, tmp_path):
    path = str(tmp_path / "seen")

    def batch(n, rows):
        df = spark.createDataFrame(rows, "url string, is_retry boolean")
        got = unseen_requests(df, F.col("is_retry"), path, n, "crawl", rows_per_bucket=2, fan_in=2)
        return sorted((r.canonical_url, r.is_retry) for r in got.collect())

    first = [("http://a/1", False), ("HTTP://A/1#x", False), ("http://a/2?b&a", False), ("http://a/1", True), ("http://a/1", None)]
    want = [("http://a/1", False), ("http://a/1", True), ("http://a/2?a&b", False)]
    assert [(u, bool(r)) for u, r in batch(0, first)] == want
    second = [("http://a:80/2?a&b", False), ("http://a/3", False), ("http://a/3", True), ("http://a/3", True)]
    want = [("http://a/3", False), ("http://a/3", True), ("http://a/3", True)]
    assert batch(1, second) == batch(1, second) == want  # also when it is tried again
    assert batch(2, [("http://a/3", False)]) == [] and batch(3, [(f"http://a/{n}", False) for n in range(9)]) == [
        (f"http://a/{n}", False) for n in (0, 2, 4, 5, 6, 7, 8)]
    assert sum(r.n_rows for r in KeyIndex(spark, path, "canonical_url").segments()) == 10


def test_a_run_is_counted_while_it_writes(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    t0, rows = datetime(2024, 1, 1), []
    for n in range(3):
        new = [(f"m{n}-{k}", "ERROR" if k % 3 == n else "INFO", t0 + timedelta(minutes=10 * n + k)) for k in range(5 * n)]
        rows += new
        spark.createDataFrame(new, "id string, level string, ts timestamp").coalesce(1).write.mode("append").parquet(p("in"))
        stream = spark.readStream.schema("id string, level string, ts timestamp").parquet(p("in"))
        settled = lambda b: b.withColumn("settled", F.when(F.col("level") == "ERROR", "error").otherwise("ack"))
        consume(stream, settled, p("rows"), p("c"), run_log=p("runs"), time="ts").awaitTermination()
        if rows:
            log = spark.createDataFrame(rows, "id string, level string, ts timestamp").withColumn("run", F.lit("r"))
            want = settle.run_summary(log, "run").drop("run").collect()
            assert runs_so_far(spark, p("runs")).drop("run").collect() == want  # so far
    assert runs_so_far(spark, p("none")).count() == 0 and len(RUN.split(",")) == 5
