"""Quality classifier: a sparse ensemble of rules over statistics of the text.

Small trees are boosted on statistics of a bounded sample of labelled texts (``max_rows``); every path
from a root is a conjunctive rule; a logistic regression with lasso weighs the rules and most of them
drop out. What is left compiles into one Spark column, so scoring is a narrow native stage over whole
texts.

An empty or null text has all statistics 0 and the score of its rules. Rows that repeat get equal
scores. If the training part has no label, all scores are 0.5; if it has one kind only, they are its
smoothed share. No rows give no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import in_training, labelled_sample, whole_rows, whole_text

MAX_ROWS, TREES, DEPTH, BINS, LASSO, THRESHOLD = 20_000, 30, 3, 32, 2e-3, 0.3


def _share(n: Column, of: Column) -> Column:
    return F.when(of > 0, n / of).otherwise(0.0).cast("double")


NAMES = ("words", "word_length", "upper", "digits", "symbols", "doubled_symbols", "lone_symbols",
         "sentence_ends", "different_words", "short_words", "line_length", "different_lines")


def with_statistics(rows: DataFrame, text: Column, prefix: str = "") -> DataFrame:
    """``rows`` with the statistics of whole texts, named ``prefix`` + NAMES; none is null.

    Patterns match long runs, or run over a skeleton in which every word is one letter and words
    without a symbol are gone, as a match costs more than a character.
    """
    p = f"{prefix}_"
    base = (rows.withColumn(f"{p}text", text)
            .withColumn(f"{p}tokens", F.split(F.regexp_replace(f"{p}text", r"\n", " "), " "))
            .withColumn(f"{p}lines", F.split(f"{p}text", r"\n"))
            .withColumn(f"{p}skeleton", F.replace(F.regexp_replace(f"{p}text", r"[\p{L}\p{N}]++", "a"),
                                                  F.lit("a "), F.lit(""))))

    def left(column, pattern):
        return F.length(F.regexp_replace(f"{p}{column}", pattern, ""))

    def count(pattern):
        return F.regexp_count(f"{p}skeleton", F.lit(pattern))

    chars, words = F.length(f"{p}text"), F.size(f"{p}tokens")
    values = (
        F.when(chars > 0, words).otherwise(0).cast("double"), _share(chars, words),
        _share(left("text", r"[^\p{Lu}]++"), chars), _share(left("text", r"[^\p{N}]++"), chars),
        _share(left("skeleton", r"[a\s]++"), chars),
        _share(count(r"([^a\s])\1"), words), _share(count(r"(?<!\S)[^a\s]+(?!\S)"), words),
        _share(count(r"[.!?](?!\S)"), words), _share(F.size(F.array_distinct(f"{p}tokens")), words),
        _share(F.size(F.filter(f"{p}tokens", lambda t: F.length(t) < 4)), words),
        _share(chars, F.size(f"{p}lines")), _share(F.size(F.array_distinct(f"{p}lines")), F.size(f"{p}lines")))
    return base.select("*", *[v.alias(prefix + n) for n, v in zip(NAMES, values, strict=True)]).drop(
        f"{p}text", f"{p}tokens", f"{p}lines", f"{p}skeleton")


def boosted_paths(x: np.ndarray, y: np.ndarray, trees: int, depth: int, bins: int) -> list[tuple]:
    """Rules, each a tuple of (statistic, is above, cut), from trees boosted on binned statistics."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    code = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    margin, rules = np.full(len(y), math.log((y.sum() + 1) / (len(y) - y.sum() + 1))), {}

    def grow(rows, path, g, h):
        if path:
            rules[path] = None
        value = -g[rows].sum() / (h[rows].sum() + 1.0) if len(rows) else 0.0
        best = (1e-6, None, None)
        if len(path) < depth and len(rows) >= 20:
            whole = g[rows].sum() ** 2 / (h[rows].sum() + 1.0)
            for j, e in enumerate(edges):
                gs = np.bincount(code[rows, j], g[rows], len(e) + 1).cumsum()
                hs = np.bincount(code[rows, j], h[rows], len(e) + 1).cumsum()
                n = np.bincount(code[rows, j], minlength=len(e) + 1).cumsum()
                gain = gs ** 2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - whole
                gain[(n < 5) | (len(rows) - n < 5)] = -1
                k = int(gain[:-1].argmax()) if len(e) else 0
                if len(e) and gain[k] > best[0]:
                    best = (gain[k], j, k)
        if best[1] is None:
            margin[rows] += 0.3 * value
            return
        _, j, k = best
        above = code[rows, j] > k
        for side in (False, True):
            grow(rows[above == side], (*path, (j, side, float(edges[j][k]))), g, h)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grow(np.arange(len(y)), (), p - y, np.maximum(p * (1 - p), 1e-6))
    return list(rules)


def applies(rules: list[tuple], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)), np.float64)
    for i, rule in enumerate(rules):
        for j, above, cut in rule:
            out[:, i] *= (x[:, j] > cut) == above
    return out


def lasso_logistic(r: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Accelerated proximal gradient; the intercept isn't penalised."""
    a = np.hstack([np.ones((len(r), 1)), r])
    step = 4.0 / max(np.linalg.norm(a, 2) ** 2 / len(a), 1e-9)
    w = np.zeros(a.shape[1])
    w[0] = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    ahead, t = w.copy(), 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ ahead, -30, 30)))
        new = ahead - step * (a.T @ (p - y)) / len(a)
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - step * penalty, 0)
        t2 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t2 * (new - w), new, t2
    return float(w[0]), w[1:]


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, trees: int = TREES,
        depth: int = DEPTH, bins: int = BINS, penalty: float = LASSO) -> tuple[float, list[tuple[float, tuple]]]:
    """Intercept and (weight, rule) pairs; the sample that comes to the driver is ``max_rows`` rows of
    statistics at most."""
    sample = with_statistics(labelled_sample(docs, labels, "quality", max_rows), F.col("text")).drop("text")
    got = np.array(sample.select("doc_id", "label", *NAMES).orderBy("doc_id", *NAMES).collect(),
                   np.float64).reshape(-1, len(NAMES) + 2)
    y, x = got[:, 1], got[:, 2:]
    if len(y) == 0:
        return 0.0, []
    if y.min() == y.max():
        return math.log((y.sum() + 1) / (len(y) - y.sum() + 1)), []
    rules = boosted_paths(x, y, trees, depth, bins)
    intercept, weights = lasso_logistic(applies(rules, x), y, penalty)
    kept = [(float(w), tuple((NAMES[j], above, cut) for j, above, cut in rule))
            for w, rule in zip(weights, rules, strict=True) if abs(w) > 1e-6]
    return intercept, kept


def score(model: tuple[float, list], prefix: str = "") -> Column:
    """The model as a column over statistics named with ``prefix``."""
    intercept, rules = model
    margin = F.lit(intercept)
    for weight, rule in rules:
        held = F.lit(True)
        for name, above, cut in rule:
            held = held & (F.col(prefix + name) > cut if above else F.col(prefix + name) <= cut)
        margin = margin + F.when(held, F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def quality_scores(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit(docs, labels, max_rows)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    scored = (with_statistics(rows, F.col("text"))
              .select("doc_id", (~in_training()).alias("held_out"), score(model).alias("score")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS,
             threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts. The one-row generator keeps Spark from
    copying the statistics into the filter, once for every rule."""
    model = fit(docs, labels, max_rows)
    wide = with_statistics(docs.select(whole_rows(docs), whole_text().alias("text")), F.col("text"), "own_")
    scored = wide.select("own", F.explode(F.array(score(model, "own_"))).alias("score"))
    return scored.where(F.col("score") >= threshold).select("own.*")
