"""Exact deduplication by skew-safe combining.

Texts are equal when they are identical after lower-casing A-Z; null is the empty text. Every stage
of merging groups by the text itself, so two texts that share a digest are never taken for one (only the way
back from classes to documents goes by SHA-256 alone):

1. each task merges the equal texts it has read (the map side of the first grouping);
2. what the tasks found meets by digest, text and a salt taken from the task's number, so that a text
   with copies in a third of all rows is merged in ``salts`` places;
3. the winners of the salts, at most ``salts`` rows per text, are merged for good.

The row with the largest doc_id stays; null is the smallest id. Rows that repeat both id and text
count towards the group's size and all carry its result; ``deduplicate`` keeps one of them. No rows
give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import saved, whole_rows, whole_text

SALTS = 32
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text):
    """A-Z lower-cased and nothing else: by ``lower`` where all is ASCII, as it is faster there."""
    return (F.when(F.octet_length(text) == F.length(text), F.lower(text))
            .otherwise(F.translate(text, UPPER, LOWER)))


def sha256(text):
    return F.unhex(F.sha2(text, 256))


def classes(docs: DataFrame, digest=sha256, salts: int = SALTS) -> DataFrame:
    """(digest, text, keep_id, group_size), one row per different text."""
    one = docs.select(normalised(whole_text()).alias("text"),
                      F.col("doc_id").cast("long").alias("keep_id"), F.lit(1).alias("n"),
                      F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    local = (one.groupBy(digest(F.col("text")).alias("digest"), "salt", "text")
             .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("n")))
    return (local.groupBy("digest", "text")
            .agg(F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")))


def exact_groups(docs: DataFrame, digest=sha256, salts: int = SALTS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = saved(classes(docs, digest, salts)
                  .select(sha256(F.col("text")).alias("sha"), "keep_id", "group_size"), "classes")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       sha256(normalised(whole_text())).alias("sha"))
    return rows.join(found, "sha").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def deduplicate(docs: DataFrame, salts: int = SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, one of each different text, with all their columns."""
    keep = saved(exact_groups(docs, salts=salts).where("kept")
                 .groupBy(F.col("doc_id").alias("keep_id"), F.col("text_sha256").alias("keep_sha"))
                 .agg(F.count("*").alias("keep_rows")), "kept")
    rows = docs.select(whole_rows(docs), F.col("doc_id").cast("long").alias("own_id"),
                       F.sha2(normalised(whole_text()), 256).alias("own_sha"))
    stay = rows.join(keep, F.col("own_id").eqNullSafe(F.col("keep_id")) & (F.col("own_sha") == F.col("keep_sha")))
    if not keep.where("keep_rows > 1").isEmpty():  # whole rows repeat: one of them is enough
        stay = stay.dropDuplicates(["keep_id", "keep_sha"])
    return stay.select("own.*")
