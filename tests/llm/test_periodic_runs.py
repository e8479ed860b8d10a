"""Runs of repeated words against brute force over all periods."""

import hashlib
import random
import re
import zlib

from pageloom.llm import periodic_runs as R
from pageloom.llm import queries

SF = "/root/testdata/sf0.001"


def brute_force(w):
    found, seen = [], set()
    for q in range(1, len(w) // 3 + 1):
        i = q
        while i < len(w):
            first = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            run = (first - q, i - first + q)
            if run[1] >= max(24, 3 * q) and run not in seen:  # else it has a smaller period
                seen.add(run)
                found.append((*run, q))
            i += 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def made(rnd):
    words = []
    for _ in range(rnd.randint(0, 6)):
        period = rnd.choice([1, 1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 20, 31, 32, 33, 40])
        base = [rnd.choice("ab" if rnd.random() < 0.6 else "abcdefgh") for _ in range(period)]
        words += [base[i % period] for i in range(rnd.randint(1, 6 * period + 20))]
        words += [rnd.choice("abcxyz") for _ in range(rnd.randint(0, 10))]
    return words


def test_every_run_is_found_once():
    rnd = random.Random(1)
    documents = [made(rnd) for _ in range(1500)] + [[], ["a"], ["a"] * 23, ["a"] * 24, list("ab") * 12, ["a"] * 5000]
    want = list(map(brute_force, documents))
    assert R.every_run(documents) == want and sum(map(len, want)) > 1500
    assert R.every_run([]) == [] and R.every_run([["x"] * 24, ["x"] * 24]) == [[(0, 24, 1)]] * 2


def test_long_texts_of_few_words_take_no_quadratic_time():
    rnd = random.Random(2)
    words = [rnd.choice("ab") for _ in range(150_000)] + list("abc") * 20_000 + ["a"] * 50_000
    runs = R.every_run([words])[0]
    assert (150_000 - 0, 60_000) in {(max(s, 150_000), 60_000) for s, n, q in runs if q == 3 and n >= 60_000}
    assert any(q == 1 and n >= 50_000 for _, n, q in runs)


def test_texts_without_runs(spark):
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "a b c"), (5, "x\x0by " * 20 + "end"), (5, "x\x0by " * 20 + "end"),
            (None, "z " * 30 + "tail"), (6, " ".join(f"w{i}" for i in range(50_000)))]
    docs = spark.createDataFrame([(*r, 1, "r") for r in rows], "doc_id long, text string, start int, runs string").repartition(2)
    got = {r.doc_id: r for r in R.collapsed(docs).collect()}
    assert [got[i].text for i in (1, 2, 3, 4)] == ["", "", "", "a b c"] and not got[6].runs
    assert got[5].text == "x y end" and [tuple(r) for r in got[5].runs] == [(0, 40, 2)]
    assert got[None].text == "z tail" and R.collapsed(docs).where("doc_id = 5").count() == 2
    assert R.collapsed(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries.queries()["op12_periodic_runs"](spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        n, h = len(w), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue
        runs, own = brute_force(w), got[r.doc_id]
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        text = " ".join(x for i, x in enumerate(w) if i not in gone)
        listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert own.n_runs == len(runs) and own.collapsed_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert own.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        best = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None,) * 3)
        assert (own.start, own.length, own.period) == best
        assert own.exponent_milli == (1000 * best[1] // best[2] if runs else None)
    assert any(r.n_runs for r in got.values())
