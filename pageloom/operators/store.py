"""Lookups in and appends to stored tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.operators.commits import Commits, exists, fresh_name, remove
from pageloom.operators.joins import HOT_ROWS, skew_left_join
from pageloom.operators.key_index import FAN_IN, ROWS_PER_BUCKET, KeyIndex
from pageloom.session import written


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``; only one row per key and task is shuffled.

    The generator keeps a later anti-join from being moved below the aggregation, where it would
    shuffle every row of a hot key.
    """
    first = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(key).agg(first.alias("_row")).selectExpr("inline(array(_row))")


def insert_if_absent(new: DataFrame, store: DataFrame, key: str,
                     order: Sequence[str]) -> DataFrame:
    """The new rows whose key is not stored yet, one per key. Rows without a key are left out. A key
    that recurs in the store is made one per task before the shuffle."""
    fresh = first_per_key(new.filter(F.col(key).isNotNull()), key, order)
    return fresh.join(store.select(key).distinct(), key, "left_anti")


def lookup_pages(requests: DataFrame, pages: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Requests with the page fetched for them; a request without a page keeps NULLs.

    ``pages`` must hold extracted columns: page bodies are never shuffled. Of several fetches of a
    URL the latest by ``fetched_at`` counts, or the largest row where there is no such column. Pages that are
    laid out by URL (``sources.pages.laid_out``) are not shuffled.
    """
    if {"html", "rendered_html"} & set(pages.columns):
        raise ValueError("extract first: a page body must not be shuffled")
    others = [c for c in pages.columns if c != "url"]
    order = [c for c in ("fetched_at",) if c in others] + others
    # The URL stays what it is, so that pages laid out by it stay so.
    latest = F.max_by(F.struct(*others), F.struct(*order)) if others else F.lit(None)
    pages = pages.groupBy("url").agg(latest.alias("_page")).select("url", *[f"_page.`{c}`" for c in others])
    found = skew_left_join(requests, pages.withColumn("_found", F.lit(True)), "url", hot_rows)
    return found.withColumn("fetched", F.coalesce("_found", F.lit(False))).drop("_found")


def append_documents(docs: DataFrame, path: str, kind: str = "parquet",
                     partition_by: Sequence[str] = ()) -> None:
    """Append; the table is created when absent. JSON is written one object per line.

    The documents of a partition are brought together first, else every task leaves a file in each folder that
    it has a document for, in the end one file a document. A partition of more than the advisory size is still
    written by several tasks.
    """
    if partition_by:
        docs = docs.hint("rebalance", *[F.col(f"`{c.replace('`', '``')}`") for c in partition_by])
    writer = docs.write.mode("append").format(kind)
    if kind == "json":
        writer = writer.option("ignoreNullFields", "false")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: Sequence[str] = (),
                kind: str = "parquet", stream: str | None = None, upto: datetime | None = None) -> int:
    """Store a batch of a stream, or store it again in place of what an earlier try has left; its number of rows.

    Every try writes a folder of its own, which counts from its commit on; the folder it takes the place of
    counts until then and is deleted afterwards. So readers that go by the commits (``committed_rows``,
    ``stored_rows``) see each batch whole and once at any time; readers that just list ``path`` do so except
    while a batch is stored again. No stream replaces what another one stored.
    """
    spark, commits = df.sparkSession, Commits(df.sparkSession, f"{path}/_commits")
    old = [r.folder for r in commits.live() if (r.stream, r.batch_id) == (stream, batch_id)]
    folder = f"{batch_folder(batch_id, stream)}/try={fresh_name()}"
    writer = df.write.format(kind)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/{folder}")
    n_rows = spark.read.format(kind).schema(df.schema).load(f"{path}/{folder}").count()
    commits.add(folder, old, stream=stream, batch_id=batch_id, n_rows=n_rows, upto=upto)
    for f in old:
        remove(spark, f"{path}/{f}")
    return n_rows


def batch_folder(batch_id: int, stream: str | None) -> str:
    return f"stream={stream}/batch_id={batch_id}" if stream else f"batch_id={batch_id}"


def committed_rows(spark: SparkSession, path: str, stream: str | None = None,
                   batch_id: int | None = None) -> DataFrame | None:
    """Rows of the batches that are committed at ``path``, of one stream or one batch if it is given, without
    listing any other folder; None if there is none. Columns of ``partition_by`` are among them."""
    found = [f"{path}/{r.folder}" for r in Commits(spark, f"{path}/_commits").live()
             if r.n_rows and stream in (None, r.stream) and batch_id in (None, r.batch_id)]
    if not found:
        return None
    return spark.read.option("basePath", path).parquet(*found).drop("stream", "batch_id", "try")


def stored_rows(spark: SparkSession, path: str, but: tuple[str | None, int] | None = None) -> DataFrame | None:
    """All rows stored below ``path``, whoever wrote them and however deep; of batches those that are
    committed, without the stream and batch ``but``. None if nothing is stored. Columns that only folder
    names hold are not read."""
    if not exists(spark, path):
        return None
    try:
        rows = spark.read.option("recursiveFileLookup", "true").parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise
    live = [r.folder.rpartition("try=")[2] for r in Commits(spark, f"{path}/_commits").live()
            if but is None or (r.stream, r.batch_id) != but]
    return rows.filter(_try_of_file().isin("", *live))


def _try_of_file() -> Column:
    """The try that a file belongs to, '' for files that no batch wrote."""
    return F.regexp_extract(F.col("_metadata.file_path"), "/try=([^/]+)/", 1)


def rows_of_others(spark: SparkSession, path: str, since: datetime | None) -> tuple[DataFrame, datetime] | None:
    """Rows below ``path`` that no batch wrote, in files changed at ``since`` or later, and when the last of
    them was; None if there is none."""
    rows = stored_rows(spark, path)
    if rows is None:
        return None
    changed = F.col("_metadata.file_modification_time")
    rows = rows.filter(_try_of_file() == "")
    rows = rows if since is None else rows.filter(changed >= F.lit(since))
    last = rows.agg(F.max(changed)).first()[0]
    return None if last is None else (rows, last)


def merge_batches(spark: SparkSession, path: str, partition_by: Sequence[str] = (), fan_in: int = FAN_IN) -> None:
    """Merge the folders of old batches, ``fan_in`` of a stream and level at a time, so that few are left.

    The newest batch of each stream, the only one that can be stored again, stays as it is. Readers that go by
    the commits see the same rows before, meanwhile and after.
    """
    commits = Commits(spark, f"{path}/_commits")
    while True:
        groups: dict[tuple, list] = {}
        live = commits.live()
        newest = {r.stream: r.batch_id for r in live}  # the last one in order
        for r in live:
            if r.batch_id < newest[r.stream]:
                groups.setdefault((r.stream, r.level or 0), []).append(r)
        full = [(of, rows[:fan_in]) for of, rows in groups.items() if len(rows) >= fan_in]
        if not full:
            return
        for (stream, level), rows in full:
            last = max(r.batch_id for r in rows)
            folder = f"{batch_folder(last, stream)}/try={fresh_name()}"
            filled = [f"{path}/{r.folder}" for r in rows if r.n_rows]
            if filled:
                df = spark.read.option("basePath", path).parquet(*filled).drop("stream", "batch_id", "try")
                df.write.partitionBy(*partition_by).parquet(f"{path}/{folder}")
            commits.add(folder, [r.folder for r in rows], stream=stream, batch_id=last, level=level + 1,
                        n_rows=sum(r.n_rows for r in rows))
            for r in rows:
                remove(spark, f"{path}/{r.folder}")


def insert_rows(new: DataFrame, path: str, key: str, order: Sequence[str], batch_id: int,
                stream: str | None = None, others: bool = True, rows_per_bucket: int = ROWS_PER_BUCKET,
                fan_in: int = FAN_IN) -> None:
    """Store, as a batch, the new rows whose key is not stored yet, one per key; rows without a key are left out.

    What is stored is known from an index of keys (``KeyIndex``), of which a batch reads only what its keys
    can be in; the store itself is not read. With ``others`` the store is looked through once for rows that
    came some other way, which enter the index first. One writer at a time; a batch that is tried again
    finds what it found before, as the index leaves out its own earlier keys.
    """
    spark, own = new.sparkSession, (stream, batch_id)
    index = KeyIndex(spark, path, key, rows_per_bucket, fan_in)
    if others:
        seen = max((r.upto for r in index.segments() if r.upto), default=None)
        if found := rows_of_others(spark, path, seen):
            keys = written(found[0].select(key).filter(F.col(key).isNotNull()).distinct(), "others")
            index.add(keys, keys.count(), upto=found[1])
    index.merge(but=own)
    fresh = written(first_per_key(new.filter(F.col(key).isNotNull()), key, order), "fresh")
    n_rows = write_batch(index.absent(fresh, but=own), path, batch_id, stream=stream)
    if n_rows:
        before = [r for r in index.segments() if (r.stream, r.batch_id) == own]
        index.add(committed_rows(spark, path, stream, batch_id).select(key), n_rows, before, stream=stream, batch_id=batch_id)
