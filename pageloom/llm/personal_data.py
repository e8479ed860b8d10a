"""Personal data in texts: patterns propose spans, checks confirm them, words nearby move their score.

A span has a kind, a place in code points (end exclusive) and a score in [0, 1]. Every kind has patterns;
each pattern has a check that a proposal must pass (the Luhn sum of card numbers, mod 97 of IBANs, ranges of
address parts, numbers of digits) and a score. A word of the kind's context within ``WINDOW`` characters adds
``NEARBY``, one that speaks against personal data (a sample, a version, an order number) takes ``AGAINST``
away; spans of ``LEAST`` or more are found. ``BASE`` patterns are found whatever the words nearby say.

Matches of one base pattern are the leftmost ones that don't overlap; a match that fails its check is
dropped and its characters aren't tried again by the same pattern. The other patterns are stricter or need
context. They take up just that: a number that a base match has run together with its neighbour, national
formats, IBANs. A span of theirs is found only where it overlaps no span found before; base spans come
first, then the higher score, the longer and the earlier span.

Every pattern takes time linear in the text: each starts at a place that cannot lie inside a stretch it has
read before, and its loops are possessive, so long runs of digits, letters or blanks do no harm. Texts
of any length are searched whole. Null and empty texts have no spans. Rows that repeat give equal rows. No
rows give no rows; other columns of ``docs`` play no part.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import whole_text

LEAST, NEARBY, AGAINST, WINDOW = 0.5, 0.35, 0.25, 48
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

#: Words that speak for a kind when they stand near a span, in the languages of the texts.
CONTEXT = {
    "email": "email e-mail mail mailto contact correo courriel kontakt contacto",
    "ip": "ip address host server login adresse dirección",
    "card": "card credit visa mastercard amex karte kreditkarte carte tarjeta payment",
    "phone": "phone tel telephone call mobile cell fax telefon handy anruf téléphone appel teléfono llamar móvil",
    "iban": "iban account bank konto bankverbindung compte banque cuenta banco",
    "ssn": "ssn social security",
}
#: Words that speak against personal data.
NO_CONTEXT = "version release isbn issn sample example invoice order sku serial checksum"
#: The lengths of IBANs by country.
IBAN_LENGTH = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
    "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19,
    "SK": 24, "SM": 27,
}


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


# ---- checks ------------------------------------------------------------------------------------

def digits_of(s: str) -> str:
    return re.sub(r"[^0-9]+", "", s)


def luhn(digits: str) -> bool:
    """The sum of the digits, each second one from the right doubled and its digits added, ends in 0."""
    doubled = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(doubled[int(d)] for d in even)) % 10 == 0


def mod_97(iban: str) -> bool:
    """The check digits of an IBAN without blanks: moved to the end, letters as numbers, it leaves 1."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def is_ip(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:3] or 0) <= 255 for p in s.split("."))


def is_card(s: str) -> bool:
    # The length is tested first: a proposal may be as long as the text.
    return len(s) <= 40 and 16 <= len(d := digits_of(s)) <= 19 and luhn(d)


def is_short_card(s: str) -> bool:
    return s[:2] in ("34", "37") and luhn(digits_of(s))


def is_phone(s: str) -> bool:
    return 8 <= len(digits_of(s)) <= 15


def is_iban(s: str) -> bool:
    compact = s.replace(" ", "")
    return IBAN_LENGTH.get(compact[:2]) == len(compact) and mod_97(compact)


def is_ssn(s: str) -> bool:
    return s[:3] not in ("000", "666") and s[0] != "9" and s[4:6] != "00" and s[7:] != "0000"


# ---- proposals ---------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from their signs."""
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def by_pattern(pattern: str) -> Callable[[str], Iterator[tuple[int, int]]]:
    find = re.compile(pattern).finditer
    return lambda text: (m.span() for m in find(text))


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """From two capitals and two digits, as many characters as the country's IBANs have, blanks aside."""
    for m in _IBAN.finditer(text):
        left = IBAN_LENGTH.get(text[m.start():m.start() + 2], 0) - 4
        end = m.end()
        while left > 0 and end < len(text) and (text[end] == " " or text[end] in _CAPITALS):
            left -= text[end] != " "
            end += 1
        if left == 0 and not text[end:end + 1].isalnum():
            yield m.start(), end


_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[ A-Z0-9])")
_CAPITALS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


class Pattern(NamedTuple):
    kind: str
    propose: Callable[[str], Iterator[tuple[int, int]]]
    check: Callable[[str], bool]
    score: float
    needs: str  # what a text must hold for this pattern: a sign, or any digit


#: The base patterns, in the order of their kinds.
BASE = (
    Pattern("email", emails, lambda s: True, 0.9, "@"),
    Pattern("ip", by_pattern(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"), is_ip, 0.7, "."),
    Pattern("card", by_pattern(r"[0-9](?:[\x20-]?[0-9])++"), is_card, 0.9, ""),
    Pattern("phone", by_pattern(r"\+[0-9][\x20().0-9-]+[0-9]"), is_phone, 0.8, "+"),
)
#: What the method adds. Those under LEAST need a word of their context nearby.
MORE = (
    Pattern("card", by_pattern(r"(?<![0-9.])(?:[0-9]{16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])"), is_card, 0.55, ""),
    Pattern("card", by_pattern(r"(?<![0-9.])[0-9]{4}([ -]?)[0-9]{6}\1[0-9]{5}(?![0-9])"), is_short_card, 0.35, ""),
    Pattern("phone", by_pattern(r"\+[0-9]{1,3} ?\([0-9]{2,4}\) ?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"), is_phone, 0.75, "+"),
    Pattern("phone", by_pattern(r"(?<![0-9+.(/-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"), is_phone, 0.25, ""),
    Pattern("iban", ibans, is_iban, 0.85, ""),
    Pattern("ssn", by_pattern(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), is_ssn, 0.3, ""),
)
_DIGIT = re.compile(r"[0-9]")


def _words(words: str) -> re.Pattern:
    return re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, words.split()))})(?!\w)")


_NEAR = {kind: _words(words) for kind, words in CONTEXT.items()}
_AGAINST = _words(NO_CONTEXT)


def scored(text: str, p: Pattern, start: int, end: int) -> float:
    """The pattern's score, moved by the words near the span."""
    near = f"{text[max(0, start - WINDOW):start]} {text[end:end + WINDOW]}".lower()
    score = p.score + NEARBY * bool(_NEAR[p.kind].search(near)) - AGAINST * bool(_AGAINST.search(near))
    return round(min(1.0, max(0.0, score)), 2)


def _proposals(text: str, patterns: tuple[Pattern, ...], digits: bool) -> Iterator[Span]:
    for p in patterns:
        if p.needs in text if p.needs else digits:
            for start, end in p.propose(text):
                if p.check(text[start:end]):
                    yield Span(p.kind, start, end, scored(text, p, start, end))


def spans_of(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans and those added."""
    digits = bool(_DIGIT.search(text))
    if not digits and "@" not in text:
        return [], []
    base = list(_proposals(text, BASE, digits))
    taken: list[tuple[int, int]] = []  # stretches of the text with spans, apart and in order
    for start, end in sorted((s.start, s.end) for s in base):
        if taken and start < taken[-1][1]:
            taken[-1] = taken[-1][0], max(end, taken[-1][1])
        else:
            taken.append((start, end))
    more = []
    for s in sorted((s for s in _proposals(text, MORE, digits) if s.score >= LEAST),
                    key=lambda s: (-s.score, s.start - s.end, s.start)):
        i = bisect_left(taken, (s.end, 0))  # the first stretch that begins where this span ends, or later
        if not i or taken[i - 1][1] <= s.start:
            more.append(s)
            taken.insert(i, (s.start, s.end))
    return base, more


_FIELDS = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]


def found(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and its spans (kind, start, end, score, base), by kind and start."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {k: i for i, k in enumerate(KINDS)}
        for b in batches:
            rows = []
            for text in b.column("text"):
                base, more = spans_of(text.as_py())
                all_ = [(s, True) for s in base] + [(s, False) for s in more]
                all_.sort(key=lambda x: (place[x[0].kind], x[0].start))
                rows.append([{**s._asdict(), "base": is_base} for s, is_base in all_])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(rows, pa.list_(pa.struct(_FIELDS)))],
                                             ["doc_id", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long, score: double, base: boolean>>")


def digests(found: DataFrame) -> DataFrame:
    """doc_id, the number of base spans by kind, a digest of these, and all spans as text."""
    def listed(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"

    counts = [F.size(F.expr(f"filter(spans, s -> s.base AND s.kind = '{k}')")).cast("long").alias(f"n_{k}")
              for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(F.expr(listed("filter(spans, s -> s.base)")), 256).alias("base_sha256"),
                        F.expr(listed("spans")).alias("spans"))
