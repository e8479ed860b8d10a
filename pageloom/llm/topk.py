"""Exact top-k search by BM25 over an inverted index in shards, with block-max pruning.

Each task writes the index of the documents it has read: postings by term hash (64 bits stand for a
term), lengths and ids. A shard ends at ``SHARD_DOCS`` documents or ``SHARD_POSTINGS`` postings. Document frequencies, the number of documents and
the mean length are those of all shards together, so scores don't depend on how documents are dealt.

A query's different terms each count once: idf(t) * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean)),
idf(t) = ln(1 + (N - df + 0.5) / (df + 0.5)). In a shard, the terms that few documents have are scored first,
from their postings. Documents lie in blocks of ``BLOCK``; of the frequent terms (of one in ``OFTEN`` documents
or more) a shard has each block's highest part of the score. A block whose best document yet and these
maxima together don't reach the query's k-th best score is skipped; only blocks that could hold one of the k
best are scored by the frequent terms too, which is most of the work, for ``TOGETHER`` queries side by side. This is
done in single precision, with a margin for its roundings, and whatever it leaves is scored again exactly, from
the documents' own terms. Nothing is pruned that could be among the k
best, so the merge of the shards' best is exact.

A task searches some shards, of which it takes up one at a time, and carries each query's k-th best along, so
all but its first shard start with a bound. Queries are taken in blocks of ``BLOCK_QUERIES``, one after the other: a
block is what is sent to all tasks at once. Scores are rounded to 6 places; ties go by doc_id, null last. A
document has score 0 if it shares no term, and such ones aren't returned; so an empty query or text gives no rows.
Null is the empty text; rows that repeat are found as often as they occur. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from struct import calcsize, pack, unpack_from

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pageloom.llm.common import saved, whole_text
from pageloom.llm.hashed_words import pieces, word_hashes

K1, B, K, SHARD_DOCS, SHARD_POSTINGS, BLOCK, BLOCK_QUERIES, SHARDS_PER_TASK = 1.2, 0.75, 10, 8_192, 2_000_000, 64, 4_096, 3
OFTEN, TOGETHER, SINGLE = 16, 64, 2.0 ** -23
HEADER = "<IIII"


def counted(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(different terms, how often each occurs, number of words) of each text."""
    for _, part in pieces(texts):
        doc, h = word_hashes(part)
        cut = np.searchsorted(doc, np.arange(len(part) + 1))
        for a, b in zip(cut, cut[1:], strict=False):
            term, n = np.unique(h[a:b], return_counts=True)
            yield term, n.astype(np.uint32), int(b - a)


def packed(ids: list[int | None], found: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The index of some documents, and its terms with their document frequencies."""
    doc = np.repeat(np.arange(len(found), dtype=np.uint16), [len(t) for t, _, _ in found])
    term, tf = np.concatenate([t for t, _, _ in found]), np.concatenate([c for _, c, _ in found])
    order = np.argsort(term, kind="stable")
    term = term[order]
    first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])[:len(term)])
    terms, df = term[first], np.diff(np.append(first, len(term)))
    known = np.array([i is not None for i in ids], np.uint8)
    data = (pack(HEADER, len(ids), len(terms), len(term), 0) + np.array([i or 0 for i in ids], "<i8").tobytes()
            + known.tobytes() + np.array([m for _, _, m in found], "<u4").tobytes() + terms.astype("<u8").tobytes()
            + df.astype("<u4").tobytes() + doc[order].astype("<u2").tobytes() + tf[order].astype("<u4").tobytes())
    return data, terms, df


class Block:
    """Some queries, and their different terms in order with the idf of each. Queries that share their commonest
    term come together."""

    def __init__(self, rows: list[tuple[int, np.ndarray, np.ndarray]]):
        rows = sorted(rows, key=lambda r: (r[2].min(), r[1][r[2].argmin()], r[0]))
        self.ids = [q for q, _, _ in rows]
        terms, weights = (np.concatenate([r[k] for r in rows]) for k in (1, 2))
        self.terms, first, places = np.unique(terms, return_index=True, return_inverse=True)
        self.idf = weights[first]
        self.asked = np.split(places.astype(np.int32), np.cumsum([len(r[1]) for r in rows])[:-1])


class Shard:
    """What a shard holds of a block's terms, each posting's part of the score worked out."""

    def __init__(self, data: bytes | pa.Buffer, mean: float, block: Block):
        self.docs, n, postings, _ = unpack_from(HEADER, data, 0)
        at = calcsize(HEADER)

        def take(kind, count):
            nonlocal at
            out = np.frombuffer(data, kind, count, at)
            at += out.nbytes
            return out

        self.ids, self.known, length = take("<i8", self.docs), take("u1", self.docs), take("<u4", self.docs)
        terms, df, doc, tf = take("<u8", n), take("<u4", n), take("<u2", postings), take("<u4", postings)
        place = np.minimum(np.searchsorted(block.terms, terms), max(len(block.terms) - 1, 0))
        here = block.terms[place] == terms if len(block.terms) else np.zeros(n, bool)
        #: The number here of each of the block's terms, -1 for those that no document here has.
        self.number = np.full(len(block.terms), -1, np.int32)
        self.number[place[here]] = np.arange(int(here.sum()))
        kept = np.repeat(here, df)
        df = df[here].astype(np.int64)
        doc, tf = doc[kept], tf[kept]
        term = np.repeat(np.arange(len(df), dtype=np.int32), df)
        self.idf, self.norm = block.idf[place[here]] * (K1 + 1), K1 * (1 - B + B * length / mean)
        impact = self.norm.astype(np.float32)[doc]
        impact += tf
        np.divide(tf, impact, out=impact)
        impact *= self.idf.astype(np.float32)[term]
        # Terms that many documents have, a number for each document, and the highest of each block of documents.
        self.blocks = -(-self.docs // BLOCK)
        often = df >= max(1, self.docs // OFTEN)
        self.row = np.where(often, np.cumsum(often) - 1, -1).astype(np.int32)
        in_row = often[term]
        self.dense = np.zeros((int(often.sum()), self.blocks * BLOCK), np.float32)
        self.dense[self.row[term[in_row]], doc[in_row]] = impact[in_row]
        self.dense = self.dense.reshape(-1, self.blocks, BLOCK)
        self.block_max = self.dense.max(axis=2) if len(self.dense) else np.zeros((0, self.blocks), np.float32)
        # The other terms' postings.
        self.doc, self.impact = doc[~in_row], impact[~in_row]
        self.df = np.where(often, 0, df)
        self.start = np.concatenate([[0], np.cumsum(self.df)])[:-1]
        del impact, in_row, kept
        # By document, for exact scores.
        order = np.argsort(doc, kind="stable")
        self.doc_term, self.doc_tf = term[order], tf[order]
        self.doc_start = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=self.docs))])

    def _ranges(self, start: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The places start, start + 1, ... of n places each."""
        ends = np.cumsum(n)
        return np.arange(int(ends[-1]) if len(n) else 0) + np.repeat(start - (ends - n), n)

    def exact(self, docs: np.ndarray, terms: np.ndarray) -> np.ndarray:
        n = self.doc_start[docs + 1] - self.doc_start[docs]
        at, which = self._ranges(self.doc_start[docs], n), np.repeat(np.arange(len(docs)), n)
        asked = np.zeros(len(self.idf), bool)
        asked[terms] = True
        hit = asked[self.doc_term[at]]
        at, which = at[hit], which[hit]
        tf = self.doc_tf[at].astype(np.float64)
        return np.bincount(which, self.idf[self.doc_term[at]] * (tf / (tf + self.norm[docs][which])), len(docs))

    def best(self, asked: list[np.ndarray], k: int, floors: list[float]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each of some queries, documents (their places) and scores of the k best that reach its floor."""
        terms = [t[t >= 0] for t in (self.number[a] for a in asked)]
        has = np.zeros((len(asked), len(self.dense)), np.float32)
        score = np.zeros((len(asked), self.blocks, BLOCK), np.float32)
        for i, t in enumerate(terms):
            row = self.row[t]
            has[i, row[row >= 0]] = 1
            rare = t[row < 0]
            at = self._ranges(self.start[rare], self.df[rare])
            score[i] = np.bincount(self.doc[at], self.impact[at], self.blocks * BLOCK).reshape(self.blocks, BLOCK)
        # What a block's best document has yet, and the most it can still get. A sum of n numbers is off by n
        # roundings at most.
        bound = score.max(axis=2) + has @ self.block_max
        near = SINGLE * (has.sum(axis=1) + 8) * bound.max(axis=1, initial=0)
        alive = bound >= np.array(floors)[:, None] - near[:, None]
        some = np.flatnonzero(alive.any(axis=0))
        dense = self.dense if len(some) == self.blocks else self.dense[:, some]
        score = score[:, some] + (has @ dense.reshape(len(dense), len(some) * BLOCK)).reshape(len(asked), len(some), BLOCK)
        for i, t in enumerate(terms):
            own = alive[i, some]
            mine, blocks = (score[i], some) if own.all() else (score[i, own], some[own])
            yield self._picked(mine.ravel(), blocks, t, k, floors[i], float(near[i]))

    def _picked(self, score: np.ndarray, blocks: np.ndarray, terms: np.ndarray, k: int, floor: float,
                near: float) -> tuple[np.ndarray, np.ndarray]:
        """Of documents of ``blocks``, those that could be among the k best are scored again exactly."""
        found = np.flatnonzero(score >= max(floor - near, 1e-9))
        if len(found) > k:
            those = score[found]
            found = found[those >= np.partition(those, len(those) - k)[len(those) - k] - 2 * near]
        docs = blocks[found // BLOCK] * BLOCK + found % BLOCK
        exact = self.exact(docs, terms)
        good = (exact >= floor) & (exact > 0)
        docs, rounded = docs[good], np.round(exact[good], 6)
        first = np.lexsort((self.ids[docs], 1 - self.known[docs], -rounded))[:k]
        return docs[first], rounded[first]


def index(docs: DataFrame) -> DataFrame:
    """(docs, words, terms, df, data) per shard, written; no document moves to another task."""
    schema = "docs long, words long, terms array<long>, df array<long>, data binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, postings = [], [], 0

        def made():
            # Documents that share the term they have most often lie together, by length: blocks are alike then.
            order = sorted(range(len(ids)), key=lambda i: (int(found[i][0][found[i][1].argmax()]) if found[i][2] else 0, found[i][2]))
            data, terms, df = packed([ids[i] for i in order], [found[i] for i in order])
            return pa.RecordBatch.from_arrays(
                [pa.array([len(ids)]), pa.array([sum(m for _, _, m in found)]), pa.array([terms.view(np.int64)]),
                 pa.array([df]), pa.array([data], pa.binary())], ["docs", "words", "terms", "df", "data"])

        for b in batches:
            for i, x in zip(b.column("doc_id").to_pylist(), counted(b.column("text").to_pylist()), strict=True):
                ids.append(i)
                found.append(x)
                postings += len(x[0])
                if len(ids) == SHARD_DOCS or postings >= SHARD_POSTINGS:
                    yield made()
                    ids, found, postings = [], [], 0
        if ids:
            yield made()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return saved(rows.mapInArrow(run, schema), "index")


def query_terms(queries: DataFrame) -> DataFrame:
    """(query_id, term) of the different terms of each query text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [t.view(np.int64) for t, _, _ in counted(b.column("text").to_pylist())]
            of = pa.array(np.repeat(np.arange(len(found)), [len(t) for t in found]))
            yield pa.RecordBatch.from_arrays(
                [b.column("query_id").take(of), pa.array(np.concatenate([np.zeros(0, np.int64), *found]))],
                ["query_id", "term"])

    return queries.mapInArrow(run, "query_id long, term long").distinct()


def top_k(docs: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, place, doc_id, score) for ``queries(query_id, text)`` against all ``docs``."""
    spark = docs.sparkSession
    table = index(docs)
    shards, n, words = table.agg(F.count("*"), F.sum("docs"), F.sum("words")).first()
    n, mean = n or 0, max(1.0, (words or 0) / (n or 1))
    df = (table.select(F.explode(F.arrays_zip("terms", "df")).alias("x"))
          .groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.df").alias("df")))
    idf = F.round(F.log(F.lit(1.0) + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)), 9)
    weighted = saved(query_terms(queries).join(df, "term").select("query_id", "term", idf.alias("idf"))
                     .groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct("idf", "term")), asc=False).alias("terms")),
                     "queries")
    blocks = -(-weighted.count() // BLOCK_QUERIES)
    found = [_searched(table.select("data").coalesce(-(-shards // SHARDS_PER_TASK)),
                       weighted.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block), mean, k)
             for block in range(blocks)]
    if not found:
        return spark.createDataFrame([], "query_id long, place int, doc_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (reduce(DataFrame.union, found).withColumn("score", F.round("score", 6))
            .withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
            .select("query_id", "place", "doc_id", "score"))


def _searched(shards: DataFrame, queries: DataFrame, mean: float, k: int) -> DataFrame:
    """(query_id, doc_id, score): the k best that each task finds for a block of queries, written. The block
    (``BLOCK_QUERIES`` queries at most) is sent to all tasks, and gone before the next one is."""
    rows = queries.select("query_id", F.col("terms.term").alias("term"), F.col("terms.idf").alias("idf")).toArrow()
    sent = shards.sparkSession.sparkContext.broadcast([
        (q.as_py(), np.array(t.values, np.int64).view(np.uint64), np.array(w.values)) for q, t, w in
        zip(rows.column("query_id"), rows.column("term"), rows.column("idf"), strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(sent.value) if sent.value else None
        best: list[tuple | None] = [None] * len(sent.value)  # (score, id is null, id), in order
        for b in batches:
            for data in b.column("data") if block else ():
                shard = None  # the one before goes first
                shard = Shard(data.as_buffer(), mean, block)
                for first in range(0, len(best), TOGETHER):
                    part = slice(first, first + TOGETHER)
                    floors = [x[0][-1] - 1e-5 if x and len(x[0]) == k else 0.0 for x in best[part]]
                    for i, (at, score) in enumerate(shard.best(block.asked[part], k, floors), first):
                        if len(at):
                            new = score, 1 - shard.known[at], shard.ids[at]
                            new = new if best[i] is None else tuple(map(np.concatenate, zip(best[i], new, strict=True)))
                            order = np.lexsort((new[2], new[1], -new[0]))[:k]
                            best[i] = tuple(x[order] for x in new)
        for query, x in zip(block.ids if block else (), best, strict=False):
            if x is not None:
                yield pa.RecordBatch.from_arrays([pa.array([query] * len(x[0]), pa.int64()),
                                                  pa.array(x[2], pa.int64(), mask=x[1] == 1), pa.array(x[0])],
                                                 ["query_id", "doc_id", "score"])

    found = saved(shards.mapInArrow(run, "query_id long, doc_id long, score double"), "candidates")
    sent.destroy()
    return found
