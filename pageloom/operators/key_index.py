"""Which keys a store holds, in buckets with Bloom filters, so that a batch reads little of it.

Segments are added by batches and never changed. A segment has its keys in 2^n buckets by hash, each with a
file of keys and a Bloom filter. A batch reads the filters of the buckets its keys fall into, and the keys of
those buckets only whose filter lets one of them pass; the keys themselves decide. ``FAN_IN`` segments of a
level are merged into one of the next, so ``FAN_IN`` - 1 of each level are left however many batches there were,
and a key is written again once per level.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from pageloom.operators.commits import Commits, fresh_name, remove
from pageloom.session import written

ROWS_PER_BUCKET, FAN_IN = 1_000_000, 16
BITS_PER_KEY, HASHES = 12, 7


def _places(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Where each hash sets its bits, by double hashing."""
    h = hashes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    step = (h >> np.uint64(32)) | np.uint64(1)
    for k in range(HASHES):
        yield ((h & np.uint64(0xFFFFFFFF)) + np.uint64(k) * step) % np.uint64(bits)


def bloom(hashes: np.ndarray, bits: int, into: np.ndarray | None = None) -> np.ndarray:
    """The filter of some hashes, a byte per bit; those of ``into`` stay."""
    out = np.zeros(bits, np.uint8) if into is None else into
    for at in _places(hashes, bits):
        out[at] = 1
    return out


def may_hold(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Per hash whether the filter (packed) lets it pass: always, if it is one of the filter's own."""
    out = np.ones(len(hashes), bool)
    for at in _places(hashes, 8 * len(bits)):
        out &= (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


class KeyIndex:
    """The keys ``key`` of the store at ``path``; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, key: str, rows_per_bucket: int = ROWS_PER_BUCKET,
                 fan_in: int = FAN_IN):
        self.spark, self.root, self.key = spark, f"{path}/_index", key
        self.rows_per_bucket, self.fan_in = rows_per_bucket, fan_in
        self.commits = Commits(spark, f"{self.root}/_commits")

    def add(self, keys: DataFrame, n_rows: int, replaces: Sequence[Row] = (), level: int = 0, **about) -> None:
        """Add a segment of ``n_rows`` keys, in place of others."""
        buckets = 1 << max(0, -(-n_rows // self.rows_per_bucket) - 1).bit_length()
        bits = 64 * (1 + BITS_PER_KEY * n_rows // (64 * buckets))
        name = fresh_name()
        dealt = keys.select(F.col(self.key).alias("k"), F.xxhash64(self.key).alias("hash"))
        dealt = dealt.withColumn("bucket", F.pmod("hash", F.lit(buckets)).cast("int"))
        dealt = dealt.repartition(buckets, "bucket") if buckets > 1 else dealt.coalesce(1)
        dealt.sortWithinPartitions("bucket", "hash").write.partitionBy("bucket").parquet(self._path("keys", name))

        def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bucket, held = None, None

            def made() -> pa.RecordBatch:
                packed = np.packbits(held, bitorder="little").tobytes()
                return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), pa.array([packed], pa.binary())],
                                                  ["bucket", "bits"])

            for b in batches:  # one bucket after the other
                of, hashes = b.column("bucket").to_numpy(), b.column("hash").to_numpy()
                for x in np.unique(of).tolist():
                    if x != bucket and held is not None:
                        yield made()
                        held = None
                    bucket, held = x, bloom(hashes[of == x], bits, held)
            if held is not None:
                yield made()

        stored = self.spark.read.parquet(self._path("keys", name)).select("bucket", "hash")
        stored = stored.repartition(buckets, "bucket") if buckets > 1 else stored.coalesce(1)
        (stored.sortWithinPartitions("bucket").mapInArrow(filters, "bucket int, bits binary")
         .write.partitionBy("bucket").parquet(self._path("filters", name)))
        full = {r.bucket for r in stored.select("bucket").distinct().collect()} if buckets > 1 else {0}
        self.commits.add(name, [r.folder for r in replaces], n_rows=n_rows, level=level, buckets=buckets,
                         empty=sorted(set(range(buckets)) - full), **about)
        for r in replaces:
            for kind in ("keys", "filters"):
                remove(self.spark, self._path(kind, r.folder))

    def segments(self, but: tuple[str | None, int] | None = None) -> list[Row]:
        """Segments that count, without that of the stream and batch ``but``, which an earlier try left."""
        return [r for r in self.commits.live() if but is None or (r.stream, r.batch_id) != but]

    def merge(self, but: tuple[str | None, int] | None = None) -> None:
        """Merge segments wherever ``fan_in`` of one level have come together, without that of ``but``."""
        level, rows = 0, self.segments(but)
        while level <= max((r.level for r in rows), default=-1):
            same = [r for r in rows if r.level == level][:self.fan_in]
            if len(same) < self.fan_in:
                level += 1
                continue
            keys = (self.spark.read.option("basePath", f"{self.root}/keys")
                    .parquet(*[self._path("keys", r.folder) for r in same]).select(F.col("k").alias(self.key)))
            self.add(keys, sum(r.n_rows for r in same), same, level + 1,
                     upto=max((r.upto for r in same if r.upto), default=None))
            rows = self.segments(but)

    def _read(self, kind: str, buckets: list[tuple[str, int]]) -> DataFrame:
        """Some buckets of some segments, and no other file."""
        return (self.spark.read.option("basePath", f"{self.root}/{kind}")
                .parquet(*[f"{self._path(kind, segment)}/bucket={bucket}" for segment, bucket in buckets]))

    def _path(self, kind: str, segment: str) -> str:
        return f"{self.root}/{kind}/segment={segment}"

    def held(self, rows: DataFrame, but: tuple[str | None, int] | None = None) -> DataFrame | None:
        """Those keys of ``rows`` that are stored, each once; None if there is none at all. ``rows`` is read
        more than once, so it should be a written table."""
        segments = self.segments(but)
        if not segments:
            return None
        of = F.array(*[F.struct(F.lit(r.folder).alias("segment"), F.lit(r.buckets).alias("buckets")) for r in segments])
        probes = (rows.select(F.col(self.key).alias("k"), F.explode(of).alias("of")).select(
            "k", F.xxhash64("k").alias("hash"), "of.segment",
            F.pmod(F.xxhash64("k"), "of.buckets").cast("int").alias("bucket")))
        # There are as many buckets as millions of keys in the store.
        empty = {r.folder: set(r.empty or ()) for r in segments}
        met = sorted((r.segment, r.bucket) for r in probes.select("segment", "bucket").distinct().collect()
                     if r.bucket not in empty[r.segment])
        if not met:
            return None

        def passing(_: tuple, asked: pa.Table, filters: pa.Table) -> pa.Table:
            keep = np.zeros(asked.num_rows, bool)
            if filters.num_rows and asked.num_rows:
                bits = np.frombuffer(filters.column("bits")[0].as_py(), np.uint8)
                keep = may_hold(bits, asked.column("hash").to_numpy())
            return asked.select(["k", "segment", "bucket"]).filter(pa.array(keep))

        filters = self._read("filters", met).select("segment", "bucket", "bits")
        kind = rows.schema[self.key].dataType.simpleString()
        passed = written(probes.groupBy("segment", "bucket").cogroup(filters.groupBy("segment", "bucket"))
                         .applyInArrow(passing, f"k {kind}, segment string, bucket int"), "passed")
        hit = sorted(tuple(r) for r in passed.select("segment", "bucket").distinct().collect())
        if not hit:
            return None
        keys = self._read("keys", hit).select("k")
        return keys.join(passed.select("k").distinct(), "k", "left_semi").distinct().select(F.col("k").alias(self.key))

    def absent(self, rows: DataFrame, but: tuple[str | None, int] | None = None) -> DataFrame:
        """The rows whose key is not stored; see ``held``."""
        held = self.held(rows, but)
        return rows if held is None else rows.join(held, self.key, "left_anti")
