"""Alignment of two tokenizers against a plain loop over the libraries' own tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from pageloom.llm import cross_tokenizer as X
from pageloom.llm import queries
from pageloom.llm.bpe import byte_of_char

P = pytest.importorskip("public_tokenizers")
A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


def brute_force(rows):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of each row."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer
    a_side, b_side, of = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), byte_of_char()
    a_side.encode_special_tokens = True

    def piece(i):
        p = b_side.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("\u2581", " ").encode()

    aligned, counts = [], Counter()
    for doc_id, text in rows:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes, b_bytes = [bytes(of[c] for c in a_side.id_to_token(i)) for i in a], list(map(piece, b))
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            a, b, a_bytes, b_bytes = [], [], [], []
        a_end, b_end = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        links = [(b[k], a[i]) for i, x in enumerate(a_end) for k, y in enumerate(b_end) if x == y] if len(a) < 500 else [
            (b[b_end.index(x)], a[i]) for i, x in enumerate(a_end) if x in set(b_end)]
        groups, i, k = [], 0, 0
        for end in sorted(set(a_end) & set(b_end)):
            i2, k2 = a_end.index(end) + 1, b_end.index(end) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[k:k2])))
            i, k = i2, k2
        counts.update(links)
        aligned.append((doc_id, len(a), len(b), len(groups), links, ";".join(groups)))
    most = {}
    for (b, _), n in counts.items():
        most[b] = max(n, most.get(b, 0))
    return [(d, n_a, n_b, n, len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links), groups)
            for d, n_a, n_b, n, links, groups in aligned]


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is None, r))


@pytest.fixture
def small(monkeypatch):
    """Many spills, several rounds of merging, a table of chunks that overflows, texts taken in pieces."""
    for name, value in (("SPILL_RECORDS", 800), ("FAN_IN", 3), ("KNOWN_CHUNKS", 300), ("LEARNT", 200), ("PIECE", 50)):
        monkeypatch.setattr(X, name, value)


def test_alignment_equals_brute_force(spark, small):
    rnd = random.Random(9)
    chars = [chr(c) for c in range(1, 0x500)] + list("\u6f22\u5b57\u0391\u03a3\u0130\u0301\u2581\u3000\x1c\xa0 ")
    texts = [None, "", "<|endoftext|>", "a<|endoftext|> b <s>x</s><unk> <0x41>", " ", "  ", "\n", " a  b\n c \n\n d ",
             "aaaa" * 40, " " * 70, "ab" * 700, "a\u2581b", "x \x1c y\xa0 \u3000z", "hot word " * 300]
    texts += ["".join(rnd.choice(chars) for _ in range(rnd.randint(1, 40))) for _ in range(200)]
    texts += ["".join(rnd.choice("abcdeTH  \n'19.,!") for _ in range(rnd.randint(1, 60))) for _ in range(200)]
    rows = [(i if i % 50 else None, t) for i, t in enumerate(texts)] + [(7, "the same row")] * 2
    docs = spark.createDataFrame([(*r, 1, "g") for r in rows], SCHEMA + ", n_a int, groups string").repartition(3)
    want = in_order(brute_force(rows))
    assert in_order(X.aligned(docs, A, B).collect()) == want
    assert any(r[1] for r in want) and any(r[7] for r in want)


def test_pair_counts_and_their_bound(spark, small):
    docs = spark.createDataFrame([(i, f"the word {i % 7} of the text") for i in range(60)], SCHEMA).repartition(4)
    table = X.spills(docs, A, B)
    pairs = {(r.b, r.a): r.links for r in X.pair_counts(table).collect()}
    n_links = sum(r[4] for r in brute_force([(i, f"the word {i % 7} of the text") for i in range(60)]))
    assert sum(pairs.values()) == n_links and max(pairs.values()) >= 60
    best = {r.b: r.links for r in X.pair_counts(table).where("best").collect()}
    assert best == {b: max(n for (x, _), n in pairs.items() if x == b) for b, _ in pairs}
    assert len(pairs) <= X.bound(A, B) < 1_000_000
    with pytest.raises(ValueError):
        X.counted(table, 3)


def test_no_rows_and_the_query_digest(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert X.aligned(docs, A, B).count() == 0 and X.pair_counts(X.spills(docs, A, B)).count() == 0
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(r.text or "") < 1500]
    got = {r.doc_id: r for r in queries.queries()["op11_cross_tokenizer"](spark, sf).collect()}
    for r in brute_force(rows):
        own = got[r[0]]
        assert (own.n_a, own.n_b, own.n_groups, own.n_links) == r[1:5]
        assert own.groups_sha256 == (hashlib.sha256(r[7].encode()).hexdigest() if r[1] else "")
