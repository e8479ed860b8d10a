"""Runs of words that repeat with a period, by an online sparse diagonal table, and texts without them.

Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0. A run is a stretch of words with smallest period q
(words q apart are equal) of at least max(LEAST, TIMES * q) words that neither neighbour extends.

On the diagonal of lag q such a run is a stretch of matches, each of a word and its occurrence q words
before. Following every earlier occurrence of every word is quadratic for a frequent word, and nearly all of
those diagonals break at once. So a step is a window of g words, and there is a table for each g = 16, 32,
64, ...: a run of a period in [g/2, g), or [1, 16) for the first table, has 2q >= g matches in a row or more,
hence a window whose earlier occurrence lies q before it. That is the window's *nearest* earlier occurrence:
a nearer one, at lag d < q < g, would overlap the window, give the stretch both periods over d + q words or
more, and thereby the smaller period gcd(d, q). So each window adds to one diagonal only, that of its nearest
earlier occurrence; where the lag changes the diagonal ends, and if it is long enough the run is emitted.
Its lag is the run's smallest period, for the same reason. Nothing else is looked at, so no lag is lost.

Windows are numbered by doubling, (window, window g words on), so equal numbers are equal words and no hash
decides. Only windows that occur twice in a document are kept, which is what makes the table sparse. Time is
n log n in the words of a text and memory n; documents are handled some at a time, long ones alone.

Null and blank texts have no words and no runs. Rows that repeat give equal rows. No rows give no rows;
other columns of ``docs`` play no part.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import whole_text

LEAST, TIMES, FIRST, BATCH_WORDS = 24, 3, 16, 1 << 18
WORD = re.compile(r"[^\x20\x09-\x0D]+")
Run = tuple[int, int, int]  # start, length, period


def every_run(documents: list[list[str]], least: int = LEAST, times: int = TIMES) -> list[list[Run]]:
    """The runs of each document, by start and period. ``times`` is 3 or more."""
    if times < 3 or least < FIRST + FIRST // 2:
        raise ValueError("runs are found from three periods and 24 words on")
    sizes = np.fromiter(map(len, documents), np.int64, len(documents))
    ends = np.cumsum(sizes)
    n = int(sizes.sum())
    number: dict[str, int] = {}
    words = np.fromiter((number.setdefault(w, len(number)) for d in documents for w in d), np.int64, n)
    of = np.repeat(np.arange(len(documents)), sizes)
    # window[i] numbers the window that begins at word i, -1 if its document has no equal one.
    window = np.full(n, -1)
    at = _recurring(window, np.arange(n), of * max(len(number), 1) + words)
    found: list[list[Run]] = [[] for _ in documents]
    size = 1
    while len(at):
        if size >= FIRST:
            for doc, run in _diagonals(at, window, of, size, least, times):
                start = run[0] - int(ends[doc] - sizes[doc])
                found[doc].append((start, *run[1:]))
        other = at + size
        both = other < n
        at, other = at[both], other[both]
        both = window[other] >= 0  # the same document: windows of two never share a number
        both &= of[at] == of[other]
        at, other = at[both], other[both]
        keys = window[at] * n + window[other]
        window[:] = -1
        at = _recurring(window, at, keys)
        size *= 2
    return [sorted(set(runs), key=lambda r: (r[0], r[2])) for runs in found]


def _recurring(window: np.ndarray, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Number the places ``at`` by their keys in ``window``; returns those whose key recurs."""
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    stay = times[back] > 1
    window[at[stay]] = back[stay]
    return at[stay]


def _diagonals(at: np.ndarray, window: np.ndarray, of: np.ndarray, size: int, least: int,
               times: int) -> Iterator[tuple[int, Run]]:
    """(document, run) for the periods that windows of ``size`` words stand for."""
    order = np.argsort(window[at], kind="stable")
    places, numbers = at[order], window[at][order]
    lag = np.diff(places)
    active = (numbers[1:] == numbers[:-1]) & (lag < size) & (lag >= (size // 2 if size > FIRST else 1))
    here, lag = places[1:][active], lag[active]
    order = np.argsort(here)
    here, lag = here[order], lag[order]
    begins = np.flatnonzero(np.concatenate([[True], (np.diff(here) != 1) | (np.diff(lag) != 0)])[:len(here)])
    matches = np.diff(np.append(begins, len(here))) + size - 1
    first, lag = here[begins], lag[begins]
    long = np.flatnonzero(matches + lag >= np.maximum(least, times * lag))
    for start, length, period in zip((first - lag)[long].tolist(), (matches + lag)[long].tolist(),
                                     lag[long].tolist(), strict=True):
        yield int(of[start]), (start, length, period)


def without_runs(words: list[str], runs: list[Run]) -> list[str]:
    """The words but those that a run holds after its first period."""
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period:start + length] = False
    return words if keep.all() else [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def collapsed(docs: DataFrame, change: Callable[[int | None, list[str]], list[str]] | None = None,
              least: int = LEAST, times: int = TIMES) -> DataFrame:
    """One row per document: doc_id, runs (start, length, period) by start and period, and text, the words
    that stay with one blank between. ``change`` may alter a document's words first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(ids: list, documents: list[list[str]]) -> pa.RecordBatch:
            found = every_run(documents, least, times)
            texts = [" ".join(without_runs(d, r)) for d, r in zip(documents, found, strict=True)]
            rows = [[dict(zip(("start", "length", "period"), x, strict=True)) for x in r] for r in found]
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(rows, RUNS), pa.array(texts, pa.string())],
                                              ["doc_id", "runs", "text"])

        ids, held, size = [], [], 0
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                words = WORD.findall(text.as_py())
                ids.append(doc_id)
                held.append(change(doc_id, words) if change else words)
                size += len(words)
                if size >= BATCH_WORDS or len(ids) == 4_096:
                    yield made(ids, held)
                    ids, held, size = [], [], 0
        if ids:
            yield made(ids, held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, runs array<struct<start: long, length: long, period: long>>, text string")


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def repeated_tail(doc_id: int | None, words: list[str]) -> list[str]:
    """A tenth of all documents (by crc32 of the id) with their last words made to repeat, as the query's
    contract has it; a document without an id stays as it is."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the run of the greatest exponent, and digests of runs and texts."""
    best = """aggregate(runs, cast(null AS struct<start: bigint, length: bigint, period: bigint>),
                        (a, r) -> CASE WHEN a IS NULL OR r.length * a.period > a.length * r.period THEN r ELSE a END)"""
    return found.withColumn("best", F.expr(best)).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')"), 256)
        .alias("runs_sha256"),
        F.sha2("text", 256).alias("collapsed_sha256"))
