"""Commits of batches, the index of keys, and what a batch reads of them."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.operators import key_index, store
from pageloom.operators.commits import Commits
from pageloom.operators.key_index import KeyIndex


def rows_of(df, column="id"):
    return [] if df is None else sorted(r[column] for r in df.collect())


def test_readers_see_the_old_rows_until_a_batch_is_committed_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    store.write_batch(spark.range(5).withColumn("settled", F.lit("ack")), path, 3, ["settled"], stream="s")
    store.write_batch(spark.range(10, 12).withColumn("settled", F.lit("ack")), path, 4, ["settled"], stream="s")
    seen, add = [], Commits.add

    def look_first(self, *args, **about):
        seen.append((rows_of(store.committed_rows(spark, path)), rows_of(store.stored_rows(spark, path))))
        if len(seen) == 1:
            raise OSError("the driver is lost between write and commit")
        add(self, *args, **about)

    monkeypatch.setattr(Commits, "add", look_first)
    again = spark.range(2).withColumn("settled", F.lit("error"))
    with pytest.raises(OSError):
        store.write_batch(again, path, 3, ["settled"], stream="s")
    old = [0, 1, 2, 3, 4, 10, 11]
    assert rows_of(store.committed_rows(spark, path)) == old
    store.write_batch(again, path, 3, ["settled"], stream="s")
    assert seen == [(old, old)] * 2
    now = store.committed_rows(spark, path)
    assert rows_of(now) == rows_of(store.stored_rows(spark, path)) == [0, 1, 10, 11]
    assert now.columns == ["id", "settled"] and now.filter("settled = 'error'").count() == 2
    assert rows_of(store.committed_rows(spark, path, "s", 4)) == [10, 11]
    assert store.committed_rows(spark, path, "t") is None
    assert rows_of(store.stored_rows(spark, path, but=("s", 3))) == [10, 11]


def test_commits_stay_few_files(spark, tmp_path):
    commits = Commits(spark, str(tmp_path / "c"), many=5)
    for n in range(14):
        commits.add(f"f{n}", [f"f{n - 1}"] if n % 3 == 1 else [], stream="s", batch_id=n)
        files = commits._table().inputFiles()
        assert len(files) <= 6
    assert [r.folder for r in commits.live()] == [f"f{n}" for n in range(14) if not (n % 3 == 0 and n < 13)]
    assert [r.batch_id for r in commits.live()] == sorted(r.batch_id for r in commits.live())
    assert Commits(spark, str(tmp_path / "none")).live() == []


def test_filters_let_all_their_own_pass_and_few_others():
    rng = np.random.default_rng(1)
    own, others = rng.integers(-2**63, 2**63, (2, 20_000))
    bits = np.packbits(key_index.bloom(own, 64 * (1 + 12 * 20_000 // 64)), bitorder="little")
    assert key_index.may_hold(bits, own).all() and key_index.may_hold(bits, others).mean() < 0.01


@pytest.mark.parametrize("kind", ["string", "long"])
def test_held_keys_are_those_of_all_segments(spark, tmp_path, kind):
    rng = random.Random(4)
    value = (lambda n: f"k{n}") if kind == "string" else (lambda n: n)
    make = lambda ns: spark.createDataFrame([(value(n),) for n in ns], f"url {kind}")
    index, stored = KeyIndex(spark, str(tmp_path), "url", rows_per_bucket=8, fan_in=2), set()
    assert index.held(make([1])) is None
    for batch in range(4):
        new = {rng.randrange(400) for _ in range(40)} - stored
        index.merge()
        index.add(make(new), len(new), stream="s", batch_id=batch)
        asked = rng.sample(range(400), 60)
        held = index.held(make(asked))
        stored |= new
        assert sorted(r.url for r in held.collect()) == sorted(value(n) for n in asked if n in stored)
        but = index.held(make(asked), but=("s", batch))
        assert sorted(r.url for r in but.collect()) == sorted(value(n) for n in asked if n in stored - new) if batch else but is None
    assert index.held(make(range(500, 510))) is None or index.held(make(range(500, 510))).count() == 0
    assert {r.level for r in index.segments()} > {0}


def test_a_thousand_batches_leave_few_segments(spark, monkeypatch):
    """The merging of levels alone, on a list of commits in memory."""
    class Kept(KeyIndex):
        def __init__(self):
            self.key, self.fan_in, self.rows, self.spark, self.root = "k", 16, [], spark, "none"

        def segments(self, but=None):
            return list(self.rows)

        def add(self, keys, n_rows, replaces=(), level=0, **about):
            from pyspark.sql import Row
            self.rows = [r for r in self.rows if r not in replaces]
            self.rows.append(Row(folder=f"f{n}-{level}-{len(self.rows)}", level=level, n_rows=n_rows, upto=None))

    class Reader:
        option = parquet = select = lambda self, *a: self

    index = Kept()
    index.spark = type("Session", (), {"read": Reader()})()
    most = 0
    for n in range(1000):
        index.merge()
        index.add(None, 10)
        most = max(most, len(index.rows))
    assert sum(r.n_rows for r in index.rows) == 10_000 and most <= 16 + 15 + 15
    assert {r.level for r in index.rows} <= {0, 1, 2}


def test_a_batch_reads_only_the_buckets_its_keys_are_in(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    keys = lambda a, b: spark.range(a, b).selectExpr("concat('u', id) AS url", "id AS n")
    index = KeyIndex(spark, path, "url", rows_per_bucket=100)
    for k, (rows, level) in enumerate([(6400, 2), (1600, 1), (1600, 1), (100, 0)]):  # as many batches leave them
        index.add(keys(10_000 * k, 10_000 * k + rows), rows, level=level, stream="s", batch_id=k)
    assert [r.buckets for r in index.segments()] == [64, 16, 16, 1]
    read, plain = [], KeyIndex._read
    monkeypatch.setattr(KeyIndex, "_read", lambda self, kind, parts: read.append((kind, parts)) or plain(self, kind, parts))
    new = keys(6_398, 6_403).union(keys(20_000, 20_001))
    store.insert_rows(new, path, "url", ["n"], 9, "s", others=False, rows_per_bucket=100)
    got = store.committed_rows(spark, path)
    assert rows_of(got, "n") == [6400, 6401, 6402]
    (kind, filters), (kind2, files) = read
    assert (kind, kind2) == ("filters", "keys")
    assert len(filters) <= 4 * 6 < 97  # of 64 + 16 + 16 + 1 buckets those that six keys fall into
    assert len(files) <= 5  # the three keys that are there, and what filters let pass by mistake
    assert "_index" not in str(got.inputFiles())


def test_a_batch_tried_again_finds_what_it_found_before(spark, tmp_path):
    path = str(tmp_path / "store")
    insert = lambda rows, n, **o: store.insert_rows(spark.createDataFrame(rows, "k string, v int"), path, "k", ["v"], n, "s", **o)
    store.append_documents(spark.createDataFrame([("other", 0)], "k string, v int"), path)
    insert([("a", 1), ("a", 2), ("other", 1), (None, 1)], 0)
    for _ in range(2):
        insert([("a", 3), ("b", 3)], 1, others=False)
    insert([("b", 4)], 2)
    rows = [(r.k, r.v) for r in store.stored_rows(spark, path).collect()]
    assert sorted(rows) == [("a", 1), ("b", 3), ("other", 0)]
    assert sorted(map(tuple, store.committed_rows(spark, path).collect())) == [("a", 1), ("b", 3)]
    store.append_documents(spark.createDataFrame([("late", 0)], "k string, v int"), path)
    insert([("late", 5), ("c", 5)], 3)  # a stream that starts anew looks through the store
    assert sorted(r.k for r in store.stored_rows(spark, path).collect()) == ["a", "b", "c", "late", "other"]


def test_old_batches_are_merged(spark, tmp_path):
    path = str(tmp_path / "rows")
    for n in range(8):
        rows = spark.range(10 * n, 10 * n + (0 if n == 2 else 3)).withColumn("settled", F.lit("ack" if n % 2 else "error"))
        store.write_batch(rows, path, n, ["settled"], stream="s")
    before = sorted(map(tuple, store.committed_rows(spark, path).collect()))
    store.merge_batches(spark, path, ["settled"], fan_in=3)
    assert sorted(map(tuple, store.committed_rows(spark, path).collect())) == before
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "settled").collect())) == before
    live = Commits(spark, f"{path}/_commits").live()
    assert [(r.batch_id, r.level) for r in live] == [(2, 1), (5, 1), (6, None), (7, None)]
    store.write_batch(spark.range(1).withColumn("settled", F.lit("ack")), path, 7, ["settled"], stream="s")
    assert store.committed_rows(spark, path).count() == len(before) - 3 + 1


def test_a_partitioned_append_leaves_one_file_a_partition(spark, tmp_path):
    def append(start):
        docs = spark.range(start, start + 240, 1, 8).select(
            F.when(F.col("id") % 10 > 0, F.col("id") % 10).alias("odd `name`.x"), "id", F.array(F.struct("id")).alias("ids"))
        store.append_documents(docs, str(tmp_path), partition_by=["odd `name`.x"])

    for n in (1, 2):
        append(240 * (n - 1))
        folders = [f for f in tmp_path.iterdir() if f.is_dir()]
        assert len(folders) == 10  # rows without a value have one, too
        assert all(len(list(f.glob("*.parquet"))) == n for f in folders)
    assert rows_of(spark.read.parquet(str(tmp_path))) == list(range(480))


def test_a_large_partition_is_appended_by_several_tasks(spark, tmp_path):
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        docs = spark.range(0, 20_000, 1, 8).select(F.lit("hot").alias("p"), "id")
        store.append_documents(docs, str(tmp_path), "json", ["p"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)
    assert 1 < len(list(tmp_path.glob("p=hot/*.json"))) <= 8
    assert rows_of(spark.read.json(str(tmp_path))) == list(range(20_000))
