"""Personal data: base patterns against plain regular expressions, added spans by cases."""

import hashlib
import random
import re
import time

from pageloom.llm import personal_data as D
from pageloom.llm import queries

SF = "/root/testdata/sf0.001"
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def confirmed(kind, s):
    digits = [int(c) for c in s if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "phone":
        return 8 <= len(digits) <= 15
    if kind == "card":
        doubled = [2 * d - 9 * (d > 4) if i % 2 else d for i, d in enumerate(reversed(digits))]
        return 16 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return True


def brute_force(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if confirmed(k, m.group())]


def base(text):
    return [s[:3] for s in D.spans_of(text)[0]]


def added(text):
    return [(s.kind, text[s.start:s.end]) for s in D.spans_of(text)[1]]


def test_base_patterns_are_the_plain_ones():
    rnd, n = random.Random(3), 0
    for signs, longest in (("ab@.1-+", 30), ("0123456789 .-", 60), ("+12() .-a", 40), ("1234 -", 30), ("12.", 30), ("0129.", 40)):
        for _ in range(6000):
            text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, longest)))
            assert base(text) == brute_force(text), text
            n += len(base(text))
    assert n > 1000 and base("4111 1111-1111 1111") == [("card", 0, 19)] and not base("4111 1111 1111 1112")
    assert base("\u20acx a.b@c.d") == [("email", 3, 10)] and base("0.00.255.0255 256.1.1.1") == [("ip", 0, 13)]


def test_checksums():
    assert D.luhn("4111111111111111") and not D.luhn("4111111111111121")
    assert D.mod_97("DE89370400440532013000") and not D.mod_97("DE88370400440532013000")
    assert D.mod_97("GB82WEST12345698765432") and D.is_iban("FR14 2004 1010 0505 0001 3M02 606")


def test_added_spans_need_a_check_and_context():
    assert added("x DE89 3704 0044 0532 0130 00 y") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert added("x DE89 3704 0044 0532 0130 01 y") == [] and added("DE89 3704 0044 0532 0130 00a") == []
    assert added("call 017-555-1234 now") == [("phone", "017-555-1234")] and added("part 017-555-1234 now") == []
    assert added("my ssn is 123-45-6789") == [("ssn", "123-45-6789")] and added("no. 123-45-6789") == []
    assert added("ssn 000-45-6789") == [] and added("invoice 123-45-6789, ssn of a sample") == []
    assert added("amex card 378282246310005") == [("card", "378282246310005")] and added("378282246310005") == []
    # A number that a base match has run together with its neighbour, and so dropped.
    assert added("+1 (017) 555-7713 97.51.17.173") == [("phone", "+1 (017) 555-7713")]
    assert added("4111111111111111 473696257") == [("card", "4111111111111111")]
    # Nothing is found twice.
    assert added("card 4111111111111111") == [] and added("call +1 017-555-1234") == []


def test_long_texts_take_linear_time():
    start = time.time()
    for text in ("9" * 300_000, "a" * 300_000, "1." * 100_000, "+1" + " " * 300_000, "a@" * 200_000, "1 " * 200_000,
                 "+1 " * 100_000, "a@" + "b-" * 150_000, "DE12" + " " * 200_000, "AB12 " * 50_000, "1.1.1." * 40_000):
        assert base(text + " x 10.1.2.3") == [*base(text), ("ip", len(text) + 3, len(text) + 11)]
    assert time.time() - start < 30


def test_documents(spark):
    rows = [(1, None), (2, ""), (3, "no digits"), (None, "a@b.c"), (4, "a@b.c " * 20_000), (5, "x 10.0.0.1"), (5, "x 10.0.0.1")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, spans int, kind string").repartition(2)
    got = sorted((r.doc_id or 0, r.n_email, r.n_ip, r.spans[:12]) for r in D.digests(D.found(docs)).collect())
    assert got == [(0, 1, 0, "email:0:5"), (1, 0, 0, ""), (2, 0, 0, ""), (3, 0, 0, ""), (4, 20_000, 0, "email:0:5,em"),
                   (5, 0, 1, "ip:2:10"), (5, 0, 1, "ip:2:10")]
    assert D.found(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    got = {r.doc_id: r for r in queries.queries()["op13_personal_data"](spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want = [f"{k}:{a}:{b}" for k, a, b in brute_force(r.text or "")]
        own = got.pop(r.doc_id)
        assert own.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(own.spans.split(",")) | {""}
        assert (own.n_email, own.n_ip, own.n_card, own.n_phone) == tuple(
            sum(w.startswith(k + ":") for w in want) for k in ("email", "ip", "card", "phone"))
    assert not got
