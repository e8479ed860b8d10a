"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are the words, the pairs of neighbours and the pairs with one word between, each
hashed into 2^bits slots and counted once. Slices of a bounded sample of labelled texts (``max_rows``, and the
``max_bytes`` of ``labelled_sample``) train apart, with rates per coordinate and an L1 penalty that leaves most weights at zero; the mean of
their weights, at most 2^bits and in fact some thousands, goes out with the scoring function.

A text without words, or null, scores as the intercept alone says. Rows that repeat get equal scores.
If the training part has no label, all scores are 0.5. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import in_training, labelled_sample, saved, whole_text
from pageloom.llm.hashed_words import pieces, word_hashes

MAX_ROWS, BITS, SLICES, EPOCHS = 16_000, 20, 1, 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.0


def features(texts: list[bytes], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, slot), with repeats."""
    doc, h = word_hashes(texts)
    keep = np.uint64(64 - bits)
    odd = np.uint64(0xD6E8FEB86659FD93)
    out = [(doc, h >> keep)]
    for gap, salt in ((1, 0x51), (2, 0xA7)):
        same = doc[gap:] == doc[:-gap]
        pair = ((h[:-gap] * odd) ^ h[gap:]) * np.uint64(_odd_of(salt))
        out.append((doc[gap:][same], (pair >> keep)[same]))
    return np.concatenate([d for d, _ in out]), np.concatenate([s for _, s in out]).astype(np.int64)


def _odd_of(salt: int) -> int:
    return (0x9E3779B97F4A7C15 * (2 * salt + 1)) % (1 << 64) | 1


def _slots(rows: DataFrame, bits: int) -> DataFrame:
    """(doc_id, label, slots), each slot of a text once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for _, texts in pieces(b.column("text").to_pylist()):
                doc, slot = features(texts, bits)
                found += [np.unique(slot[doc == i]).astype(np.int32) for i in range(len(texts))]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("label"), pa.array(found, pa.list_(pa.int32()))],
                ["doc_id", "label", "slots"])

    return rows.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, slots array<int>")


def train(slots: list[np.ndarray], y: np.ndarray, bits: int, epochs: int = EPOCHS) -> np.ndarray:
    """Weights, that of the intercept last."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(i):
        l1 = np.where(i == 1 << bits, 0.0, L1)  # the intercept pays no penalty
        w = -(z[i] - np.sign(z[i]) * l1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(z[i]) <= l1, 0.0, w)

    for _ in range(epochs):
        for s, label in zip(slots, y, strict=True):
            i = np.append(s, 1 << bits)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            root = np.sqrt(n[i])
            z[i] += g - (np.sqrt(n[i] + g * g) - root) / ALPHA * w
            n[i] += g * g
    return weights(np.arange((1 << bits) + 1))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, bits: int = BITS,
        slices: int = SLICES) -> tuple[np.ndarray, np.ndarray, float]:
    """(slots, their weights, intercept)."""
    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(turn=pd.util.hash_array(pdf["doc_id"].to_numpy())).sort_values(["turn", "doc_id"])
        w = train(list(pdf["slots"]), pdf["label"].to_numpy(), bits)
        at = np.flatnonzero(w)
        return pd.DataFrame({"slot": at.astype(np.int32), "weight": w[at]})

    sample = saved(_slots(labelled_sample(docs, labels, "toxic", max_rows), bits), "toxic")
    cut = F.pmod(F.xxhash64("doc_id", F.lit("slice")), F.lit(slices))
    n = sample.select(cut.alias("slice")).distinct().count()
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0), 0.0
    w = (sample.withColumn("slice", cut).groupBy("slice").applyInPandas(learn, "slot int, weight double")
         .groupBy("slot").agg((F.sum("weight") / n).alias("weight")).orderBy("slot").toPandas())
    is_bias = w["slot"] == 1 << bits
    w_bias = float(w.loc[is_bias, "weight"].sum())
    return w.loc[~is_bias, "slot"].to_numpy(np.int64), w.loc[~is_bias, "weight"].to_numpy(), w_bias


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    at, weight, bias = fit(docs, labels, max_rows, bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits)
        table[at] = weight
        for b in batches:
            margin = np.full(b.num_rows, bias)
            for first, texts in pieces(b.column("text").to_pylist()):
                doc, slot = features(texts, bits)
                hit = np.flatnonzero(table[slot])
                once = np.unique((doc[hit] << bits) | slot[hit])
                margin[first:first + len(texts)] += np.bincount(once >> bits, table[once & ((1 << bits) - 1)], len(texts))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(margin, -700, 700))))], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return (rows.mapInArrow(run, "doc_id long, score double")
            .select("doc_id", (~in_training()).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))
