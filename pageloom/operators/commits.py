"""Which folders of a store count: a list of commits that is written last and that readers go by.

A commit names a folder and the folders it takes the place of. A folder counts if it is named and no commit
takes its place, so the order of commits plays no part, and one that is there twice does no harm. Each commit
is one small file, which Spark shows whole or not at all: until it is there, readers see what was there before.
After ``MANY`` files one takes their place, which still lists what others must not bring back.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Row, SparkSession

MANY = 64
ENTRY = ("folder string, replaces array<string>, stream string, batch_id long, n_rows long, level int, "
         "buckets int, empty array<int>, upto timestamp")
NAMES = [c.split()[0] for c in ENTRY.split(", ")]


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder, wherever it is stored; nothing happens if it isn't there."""
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)


def fresh_name() -> str:
    return f"t{uuid.uuid4().hex}"  # begins with a letter, so that nobody takes it for a number


class Commits:
    """The commits below ``folder``; a name with ``_`` in front keeps them out of other readers' sight."""

    def __init__(self, spark: SparkSession, folder: str, many: int = MANY):
        self.spark, self.folder, self.many = spark, folder, many

    def _table(self) -> DataFrame | None:
        if not exists(self.spark, self.folder):
            return None
        return self.spark.read.schema(ENTRY).json(self.folder)

    def live(self) -> list[Row]:
        """The commits that count, one per folder, in the order of stream, batch and folder."""
        table = self._table()
        rows = table.collect() if table is not None else []
        gone = {f for r in rows for f in r.replaces or ()}
        own = {r.folder: r for r in rows if r.folder and r.folder not in gone}
        return sorted(own.values(), key=lambda r: (r.stream or "", -1 if r.batch_id is None else r.batch_id, r.folder))

    def add(self, folder: str, replaces: Iterable[str] = (), **about) -> None:
        self._write([{**about, "folder": folder, "replaces": list(replaces)}])
        table = self._table()
        files = table.inputFiles()
        if len(files) > self.many:
            rows = self.spark.read.schema(ENTRY).json(files).collect()
            gone = {f for r in rows for f in r.replaces or ()}
            kept = [{**r.asDict(), "replaces": []} for r in rows if r.folder and r.folder not in gone]
            self._write([*kept, {"folder": None, "replaces": sorted(gone)}])
            for f in files:
                remove(self.spark, f)

    def _write(self, rows: list[dict]) -> None:
        table = self.spark.createDataFrame([tuple(r.get(n) for n in NAMES) for r in rows], ENTRY)
        table.coalesce(1).write.mode("append").json(self.folder)
