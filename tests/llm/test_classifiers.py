"""The classifiers against plain loops, and the sample they learn from."""

import math
import random

import numpy as np
import pytest

from pageloom.llm import quality, toxicity
from pageloom.llm.common import labelled_sample


def plain_ftrl(rows, labels, bits, epochs):
    """FTRL-proximal, a coordinate at a time; the intercept is a coordinate without penalty."""
    z, n, bias = {}, {}, 1 << bits

    def weight(i):
        l1 = 0.0 if i == bias else toxicity.L1
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        sign = math.copysign(1, z[i])
        return -(z[i] - sign * l1) / ((toxicity.BETA + math.sqrt(n[i])) / toxicity.ALPHA + toxicity.L2)

    for _ in range(epochs):
        for slots, y in zip(rows, labels, strict=True):
            at = {i: weight(i) for i in (*slots, bias)}
            g = 1 / (1 + math.exp(-max(-30, min(30, sum(at.values()))))) - y
            for i, w in at.items():
                rate = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - rate * w
                n[i] = n.get(i, 0.0) + g * g
    return np.array([weight(i) if i in z else 0.0 for i in range(bias + 1)])


@pytest.mark.parametrize("share", [0.0, 0.06, 0.5, 1.0])
def test_ftrl_equals_a_plain_loop(share):
    rng = random.Random(int(100 * share))
    rows = [np.array(sorted(rng.sample(range(32), rng.randint(0, 9))), np.int64) for _ in range(150)]
    labels = np.array([int(3 in r or rng.random() < 0.1) if share == 0.5 else int(rng.random() < share) for r in rows])
    got = toxicity.train(rows, labels, 5)
    assert np.allclose(got, plain_ftrl([r.tolist() for r in rows], labels.tolist(), 5, toxicity.EPOCHS))


@pytest.mark.parametrize("labels, least, most", [([0], 0, 0.499), ([0, 0], 0, 0.4), ([1], 0.501, 1), ([0] * 47 + [1] * 3, 0, 0.15)])
def test_the_intercept_follows_the_labels(labels, least, most):
    w = toxicity.train([np.zeros(0, np.int64)] * len(labels), np.array(labels), 3)
    assert least <= 1 / (1 + math.exp(-w[-1])) <= most


def test_scores_are_those_of_the_weights(spark):
    texts = [f"good word{k % 9} more" if k % 3 else f"bad word{k % 9} worse" for k in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(300)], "doc_id long, toxic int")
    at, weight, bias = toxicity.fit(docs, labels)
    of = dict(zip(at.tolist(), weight.tolist(), strict=True))
    got = {r.doc_id: r for r in toxicity.toxicity_scores(docs, labels).collect()}
    for k, text in enumerate(texts):
        slots = set(toxicity.features([text.encode()])[1].tolist())
        p = 1 / (1 + math.exp(-(bias + sum(of.get(s, 0.0) for s in slots))))
        assert got[k].score == pytest.approx(p) and got[k].predicted == int(p >= 0.5) == int(k % 3 == 0)


def test_the_rules_column_is_the_rules_applied(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["Ab", "c!", "12", "longerword", "x.", "###", "e"]) for _ in range(rng.randint(0, 60)))
             for _ in range(400)] + [None, "", "\n\n", "a"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int((t or "").count("#") < 20)) for k, t in enumerate(texts)], "doc_id long, quality int")
    intercept, rules = quality.fit(docs, labels)
    assert rules
    rows = quality.with_statistics(docs.select("doc_id", quality.whole_text().alias("text")), quality.F.col("text"))
    stats = {r.doc_id: [r[n] for n in quality.NAMES] for r in rows.collect()}
    named = [tuple((quality.NAMES.index(n), above, cut) for n, above, cut in rule) for _, rule in rules]
    w = np.array([x for x, _ in rules])
    for r in quality.quality_scores(docs, labels).collect():
        margin = intercept + float(quality.applies(named, np.array([stats[r.doc_id]]))[0] @ w)
        assert r.score == pytest.approx(1 / (1 + math.exp(-margin))) and r.predicted == int(r.score >= 0.3)


def test_the_lasso_is_at_its_minimum():
    rng = np.random.default_rng(3)
    r = (rng.random((300, 12)) < 0.4).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(-(2 * r[:, 0] - 2 * r[:, 1])))).astype(float)

    def loss(b, w):
        m = b + r @ w
        return np.mean(np.logaddexp(0, m) - y * m) + 0.01 * np.abs(w).sum()

    b, w = quality.lasso_logistic(r, y, 0.01, 3000)
    best = loss(b, w)
    assert (w == 0).any() and abs(w[0]) > 0.1
    for k in range(12):
        for step in (-0.01, 0.01):
            moved = w.copy()
            moved[k] += step
            assert loss(b, moved) >= best - 1e-9 and loss(b + step, w) >= best - 1e-9


def test_the_sample_is_bounded_in_bytes_too(spark):
    docs = spark.createDataFrame([(k, "x" * (10_000 if k % 7 == 0 else 100)) for k in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(80)], "doc_id long, toxic int")
    whole = labelled_sample(docs, labels, "toxic", 100).collect()
    part = labelled_sample(docs, labels, "toxic", 100, max_bytes=30_000).collect()
    assert len(whole) > len(part) > 0 and set(part) <= set(whole) and sum(len(r.text) for r in part) <= 30_000
    assert len(labelled_sample(docs, labels, "toxic", 100, max_bytes=1).collect()) == 1
