"""Fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom import schemas


#: Pages of one task: extraction takes some 10 ms a page, so a task stays short however large the table is.
PAGES_PER_TASK, MOST_TASKS = 4_000, 10_000


def spread(df: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Rows over all cores where the scan has fewer splits than there are cores, or than ``rows_per_task`` asks for.

    For work that costs far more than reading. The rows are counted from the files' footers. A table with more
    splits is not shuffled.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if rows_per_task:
        wanted = max(wanted, min(-(-df.count() // rows_per_task), MOST_TASKS))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A page table from Parquet files."""
    return spread(spark.read.parquet(path), PAGES_PER_TASK)


def lay_out(pages: DataFrame, table: str, path: str, buckets: int = 256, group_bytes: int = 16 << 20) -> None:
    """Write pages once so that nothing has to move them later: as a table of the catalogue, in ``buckets`` by
    URL and sorted by it, in row groups that a scan can split.

    A lookup or a count by URL reads bucket by bucket and shuffles no page; extraction alone is split by row
    groups, over as many tasks as there are. A bucket should have some hundred MB at most.
    """
    (pages.repartition(buckets, "url").write.bucketBy(buckets, "url").sortBy("url")
     .option("parquet.block.size", group_bytes).option("path", path).format("parquet").saveAsTable(table))


def laid_out(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.table(table)


def fetched_pages(pages: DataFrame, clock: bool = False) -> DataFrame:
    """A table with at least ``url`` and ``html`` in the full page schema, other columns kept. Pages that don't
    tell when they were fetched have no time, or with ``clock`` that of the job, one for all of them."""
    have = set(pages.columns)
    defaults = {
        "final_url": F.col("url"), "status": F.lit(200), "redirect_urls": F.lit(None),
        "retry_times": F.lit(0), "fetched_at": F.lit(None), "rendered_html": F.lit(None)}
    if clock:
        defaults["fetched_at"] = F.current_timestamp()
        if "fetched_at" in have:
            pages = pages.withColumn("fetched_at", F.coalesce("fetched_at", F.current_timestamp()))
    wanted = {f.name: f.dataType for f in schemas.fields(schemas.FETCHED_PAGE)}
    extra = [F.col(c) for c in pages.columns if c not in wanted]
    return pages.select(*extra, *[
        (F.col(n) if n in have else defaults[n]).cast(t).alias(n) for n, t in wanted.items()])
