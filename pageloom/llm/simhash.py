"""SimHash near-duplicates by exact comparison in tiles.

Words are `[^\\x20\\x09-\\x0D]+` after lower-casing A-Z; a shingle is ``words_per_shingle`` words with
single blanks between, repeats included (a shorter text is one shingle); its hash is XXH64 with seed
42. A bit of the fingerprint is set if it is in over half the hashes. A text without words has
fingerprint zero, null is the empty text. Documents whose fingerprints differ in ``radius`` bits or
fewer are linked, and a component is all that links reach.

Different fingerprints are compared once, however many documents share them. They are dealt into
tiles by their count of set bits, and two tiles meet only if these counts differ by no more than the
radius; inside a pair of tiles the same holds for the upper and lower halves. Each pair of tiles keeps
a spanning forest of its links, so a group of near copies never turns into all its pairs.

A null doc_id is ignored when the smallest id of a component is taken (null if it has no other). Rows
that repeat are linked like any equal texts. No rows give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import one_of_each, saved, whole_text
from pageloom.llm.components import components

WORDS_PER_SHINGLE, RADIUS, SEED, BLOCK = 4, 4, 42, 2048
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower_words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode("utf-8", "surrogatepass").translate(_LOWER))


def fingerprint(text: str, words_per_shingle: int = WORDS_PER_SHINGLE, piece: int = 1 << 16) -> int:
    """The fingerprint as a signed 64-bit number; shingles are counted ``piece`` at a time."""
    words = lower_words(text)
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - words_per_shingle + 1)
    first, last = starts[:n], ends[-n:]
    set_bits, of = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for k in range(0, n, piece):
        spans = zip(first[k:k + piece].tolist(), last[k:k + piece].tolist(), strict=True)
        h = np.array([of(line[a:b], SEED) for a, b in spans], ">u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(set_bits * 2 > n).view(">i8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = WORDS_PER_SHINGLE, keyed: bool = False) -> DataFrame:
    """(doc_id, fp), and text_key, xxhash64 of the text, if ``keyed``."""
    names = ["doc_id", "text_key"] if keyed else ["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), words_per_shingle) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(fps, pa.int64())], [*names, "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    if keyed:
        rows = rows.withColumn("text_key", F.xxhash64("text"))
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "fp"]))


def _join(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Take links into a forest: roots hook to smaller roots until all links are inside a tree."""
    while len(a):
        a, b = parent[a], parent[b]
        apart = a != b
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up
        a, b = low, high


def _blocks(fp: np.ndarray, offset: int) -> list[tuple]:
    """(positions, fingerprints, set bits of the upper half, of the lower half), BLOCK rows at most."""
    upper, lower = np.bitwise_count(fp >> np.uint64(32)), np.bitwise_count(fp & np.uint64(0xFFFFFFFF))
    out = []
    for u, low in np.unique(np.stack([upper, lower], 1), axis=0):
        at = np.flatnonzero((upper == u) & (lower == low))
        out += [(at[k:k + BLOCK] + offset, fp[at[k:k + BLOCK]], int(u), int(low))
                for k in range(0, len(at), BLOCK)]
    return out


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, smallest one of its tree) between two tiles, or within one."""
    fps = left if right is None else np.concatenate([left, right])
    parent = np.arange(len(fps))
    a_blocks = _blocks(left, 0)
    b_blocks = a_blocks if right is None else _blocks(right, len(left))
    for i, (a_at, a, a_up, a_low) in enumerate(a_blocks):
        for b_at, b, b_up, b_low in b_blocks[i if right is None else 0:]:
            if abs(a_up - b_up) + abs(a_low - b_low) > radius:
                continue
            near = np.bitwise_count(a[:, None] ^ b[None, :]) <= radius
            x, y = np.divmod(np.flatnonzero(near), len(b))
            _join(parent, a_at[x], b_at[y])
    linked = np.flatnonzero(parent != np.arange(len(fps)))
    return fps[linked], fps[parent[linked]]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) over different fingerprints ``fp``, enough to connect all within the radius."""
    spark = distinct.sparkSession
    bits = distinct.select("fp", F.bit_count("fp").alias("bits"))
    counts = {r["bits"]: r["count"] for r in bits.groupBy("bits").count().collect()}  # 65 at most
    rows = max(1, math.ceil(64 * math.sqrt(sum(counts.values()))))  # of a tile: so tiles grow as the root, too
    per = {p: math.ceil(n / rows) for p, n in counts.items()}
    tiles = [(p, k) for p in sorted(per) for k in range(per[p])]
    number = {t: i for i, t in enumerate(tiles)}
    meets = [(number[s], number[t]) for s in tiles for q in range(s[0], s[0] + radius + 1) if q in per
             for t in ((q, k) for k in range(per[q])) if number[t] >= number[s]]
    roles = [(t, pair, side) for pair, st in enumerate(meets) for side, t in enumerate(st) if side == 0 or st[0] != st[1]]
    if not per:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    part = F.create_map(*[F.lit(x) for p, n in per.items() for x in (p, n)])
    base = F.create_map(*[F.lit(x) for p in per for x in (p, number[p, 0])])
    tiled = bits.select("fp", (base[F.col("bits")] + F.pmod(F.xxhash64("fp"), part[F.col("bits")])).cast("int").alias("tile"))
    table = spark.createDataFrame(roles, "tile int, pair int, side int")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy().view(np.uint64)
        side = pdf["side"].to_numpy()
        right = fp[side == 1]
        a, b = forest(fp[side == 0], right if len(right) else None, radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return (tiled.join(table, "tile").select("fp", "pair", "side")
            .groupBy("pair").applyInPandas(compare, "a long, b long"))


def near_duplicates(docs: DataFrame, radius: int = RADIUS, words_per_shingle: int = WORDS_PER_SHINGLE) -> DataFrame:
    """One row per document: doc_id, fp, component_id (the smallest doc_id that links reach)."""
    rows = saved(fingerprints(docs, words_per_shingle), "fingerprints")
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    stars = components(saved(links(distinct, radius), "links"))
    labelled = saved(distinct.join(stars, F.col("fp") == F.col("node"), "left")
                     .select("fp", "least", F.coalesce("root", "fp").alias("root")), "labelled")
    smallest = labelled.groupBy("root").agg(F.min("least").alias("component_id"))
    of = saved(labelled.join(smallest, "root").select("fp", "component_id"), "components")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id")


def deduplicate(docs: DataFrame, radius: int = RADIUS, words_per_shingle: int = WORDS_PER_SHINGLE) -> DataFrame:
    """One row of each component, with all columns: that with the smallest doc_id (null is the largest;
    equal ids in the order of fingerprints, then of the texts' hashes)."""
    rows = saved(fingerprints(docs, words_per_shingle, keyed=True), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp", "text_key")).alias("keep")
    distinct = saved(rows.groupBy("fp").agg(first), "distinct")
    stars = components(saved(links(distinct, radius), "links"))
    chosen = (distinct.join(stars, F.col("fp") == F.col("node"), "left")
              .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("keep").alias("keep")))
    return one_of_each(docs, chosen.select("keep.doc_id", "keep.text_key"))
