"""What the operators of this package share."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.session import scratch_dir


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """The rows after a trip through a Parquet table in the shared scratch folder: lineage ends
    there, and a lost executor costs no more than the tasks it ran."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(name: str = "text"):
    """The text column, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def in_training(name: str = "doc_id"):
    """Rows whose labels may be learnt from: crc32 of the id as text is no multiple of five."""
    return F.coalesce(F.crc32(F.col(name).cast("string")) % 5 != 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int,
                    max_bytes: int = 1 << 28) -> DataFrame:
    """(doc_id, text, label) of at most ``max_rows`` labelled documents of the training part,
    those with the smallest hashes of their ids, as many of them as together have ``max_bytes`` of text at
    most (but one). The chosen labels are at most ``max_rows`` pairs of numbers, which bounds what is
    broadcast. An id with several labels takes the largest, one with several documents the text with the
    smallest hash; they are combined before the shuffle."""
    chosen = (labels.where(in_training("doc_id") & F.col(label).isNotNull())
              .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
              .agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))
    found = saved(texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id")
                  .agg(one.alias("of"), F.max("label").alias("label")).select("doc_id", "of.text", "label"), "labelled")
    size = F.octet_length("text")
    if (found.agg(F.sum(size)).first()[0] or 0) <= max_bytes:
        return found
    before = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    fits = (found.select("doc_id", size.alias("size"))  # max_rows pairs of numbers
            .withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
            .where((F.col("before") == 0) | (F.col("before") + F.col("size") <= max_bytes)).select("doc_id"))
    return found.join(F.broadcast(fits), "doc_id")


def whole_rows(docs: DataFrame):
    """All columns of ``docs`` as one, ``own``: no column that an operator adds clashes with one of them, whatever
    its name. ``own.*`` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("own")


def one_of_each(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``chosen`` (doc_id, text_key) names, each once, with all columns;
    text_key is xxhash64 of the text."""
    keep = saved(chosen.select(F.col("doc_id").alias("keep_id"), F.col("text_key").alias("keep_text")), "chosen")
    rows = docs.select(whole_rows(docs), F.col("doc_id").cast("long").alias("own_id"),
                       F.xxhash64(whole_text()).alias("own_text"))
    stay = rows.join(keep.hint("merge"), (F.col("own_text") == F.col("keep_text"))
                     & F.col("own_id").eqNullSafe(F.col("keep_id")))
    return stay.dropDuplicates(["keep_id", "keep_text"]).select("own.*")


def running_totals(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """``df`` with ``out``, the sum of ``value`` over all rows before a row in ``order``.

    Rows are dealt out by ranges, summed up per range, and numbered within their range; only one
    total per range, as many as there are shuffle partitions, comes to the driver.
    """
    spark = df.sparkSession
    dealt = saved(df.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_range", F.spark_partition_id()), "ranges")
    sums = sorted((r["_range"], r["total"]) for r in
                  dealt.groupBy("_range").agg(F.sum(value).alias("total")).collect())
    starts = [0, *accumulate(total for _, total in sums)]
    first = spark.createDataFrame([(k, int(s)) for (k, _), s in zip(sums, starts, strict=False)],
                                  "_range int, _first long")
    before = F.sum(value).over(Window.partitionBy("_range").orderBy(*order)
                               .rowsBetween(Window.unboundedPreceding, -1))
    return (dealt.withColumn(out, F.coalesce(before, F.lit(0)).cast("long"))
            .join(F.broadcast(first), "_range")
            .withColumn(out, F.col(out) + F.col("_first")).drop("_range", "_first"))
