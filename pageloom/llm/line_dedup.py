"""Line deduplication by winnowing.

A document is the sequence of its lines that hold a word, compared without blanks around them. A window
is the shortest run of lines from some line on that has ``min_lines`` lines or ``min_words`` words. A
line goes if it lies in a window whose very lines stood before: in a document of a smaller doc_id (null
is the smallest; equal ids in the order of the texts' hashes), or earlier in the same one. So the first
of several equal runs stays and later ones go, whatever else surrounds them.

Of each window the smallest line hash (the last of equal ones) is a fingerprint. It depends on the
window's lines alone, so equal windows share a fingerprint; and neighbouring windows mostly have the
same one, so there are far fewer of them than windows. Fingerprints are counted first, and only the
places of those that recur are joined. There every match is extended to both sides of the fingerprint,
as far as the windows around it agree, which is decided by a 128-bit hash of their lines; runs are the
unions of such windows. Each place meets the first one only, never all others. What is joined lies in
tables, so both sides of a join come straight from their shuffles and Spark can split a hot key's rows.

Null is the empty text; a text without lines to remove comes back as it is (null as empty). Rows that
repeat id and text are one document and come back alike. No rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import saved, whole_text

MIN_LINES, MIN_WORDS = 3, 50
BLANKS = " \t\n\v\f\r"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def windows(text: str, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> list[tuple[int, bytes, int, int, int]]:
    """(fingerprint, hash of the lines, first line, last line, place of the fingerprint) of each
    window; first and last are numbers of lines in the text."""
    lines = [(k, t) for k, line in enumerate(text.split("\n")) if (t := line.strip(BLANKS))]
    n = np.cumsum([0, *(len(_WORD.findall(t)) for _, t in lines)])
    h = [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) for _, t in lines]
    ends = np.minimum(np.arange(len(lines)) + min_lines, np.searchsorted(n, n[:-1] + min_words, "left")).tolist()
    out = []
    for i, end in enumerate(ends):
        if end > len(lines):
            break
        whole = "\n".join(t for _, t in lines[i:end]).encode("utf-8", "surrogatepass")
        low, at = min((h[j], -j) for j in range(i, end))
        out.append((low, xxhash.xxh3_128_digest(whole), lines[i][0], lines[end - 1][0], -at))
    return out


def places(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(fp, doc_id, text_key, around): one row per fingerprint in a document, with the windows
    around it."""
    around = "array<struct<key:binary,first:int,last:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window = pa.struct([("key", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])
        for b in batches:
            fps, of, found = [], [], []
            for row, text in enumerate(b.column("text")):
                before = None
                for fp, key, first, last, at in windows(text.as_py(), min_lines, min_words):
                    if at != before:
                        fps.append(fp - (1 << 64) if fp >> 63 else fp)
                        of.append(row)
                        found.append([])
                        before = at
                    found[-1].append({"key": key, "first": first, "last": last})
            of = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(fps, pa.int64()), b.column("doc_id").take(of), b.column("text_key").take(of),
                 pa.array(found, pa.list_(window))], ["fp", "doc_id", "text_key", "around"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(whole_text()).alias("text_key"), whole_text().alias("text"))
    return rows.mapInArrow(run, f"fp long, doc_id long, text_key long, around {around}")


def repeats(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_key, lines): numbers of the lines to remove, for documents that have any."""
    found = saved(places(docs, min_lines, min_words), "places")
    shared = saved(found.groupBy("fp").agg(F.count("*").alias("n")).where("n > 1").select("fp"), "shared").hint("merge")
    near = saved(found.join(shared, "fp").select("doc_id", "text_key", F.explode("around").alias("w"))
                 .select("w.key", F.struct("doc_id", "text_key", "w.first").alias("at"), "w.last"), "near")
    start = saved(near.groupBy("key").agg(F.min("at").alias("start")), "starts").hint("merge")
    later = near.join(start, "key").where(F.col("at") != F.col("start"))
    return (later.select("at.doc_id", "at.text_key", "at.first", "last").distinct()
            .groupBy("doc_id", "text_key")
            .agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.sequence("first", "last"))))).alias("lines")))


def without_repeats(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_lines, removed (line numbers), text (what is left). The join is
    a merge at any size: what it adds grows with the corpus, so it must not depend on fitting a broadcast."""
    gone = saved(repeats(docs, min_lines, min_words), "repeats").select(
        F.col("doc_id").alias("_of"), F.col("text_key").alias("_key"), "lines").hint("merge")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(whole_text()).alias("text_key"), whole_text().alias("text"))
    all_lines = F.split("text", "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("lines"))
    return (rows.join(gone, F.col("doc_id").eqNullSafe(F.col("_of")) & (F.col("text_key") == F.col("_key")), "left")
            .select("doc_id", F.size(all_lines).cast("long").alias("n_lines"),
                    F.coalesce("lines", F.array().cast("array<int>")).alias("removed"),
                    F.when(F.col("lines").isNull(), F.col("text")).otherwise(
                        F.array_join(F.transform(left, lambda k: F.get(all_lines, k)), "\n")).alias("text")))
