"""Byte-level BPE encoding by speculating and verifying, and decoding.

The tokens of a word are proposed greedily, the longest first. A proposal is what merging would give if
each of its tokens is what its own bytes merge to, and if for no two neighbours a merge across their
border comes before both are complete. All pairs of a batch of new words are checked together with
array operations; only the words that fail are merged by rank. Words are looked up once per task, in a
table of bounded size.

Ids are those of a tokenizers file of this kind (byte level, no prefix space, no normaliser): its
special strings are single ids wherever they occur. Ids travel as little-endian unsigned 32-bit
integers. Null is the empty text, which has no ids and decodes to itself; texts of any length are
handled a piece at a time, cut where no word can span. Rows that repeat get equal results; no rows give none.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from itertools import chain
from struct import pack

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import whole_text

KNOWN_WORDS, PIECE, ROWS = 200_000, 1 << 20, 256
NEVER = 1 << 40
#: The pattern of words and the printable stand-ins for bytes of this file format.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The same pattern over the first 256 characters, whose letters and numbers can be listed.
L1, N1, S1 = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
WORDS_1 = (f"'s|'t|'re|'ve|'m|'ll|'d| ?[{L1}]+| ?[{N1}]+| ?[^{S1}{L1}{N1}]+"
           f"|[{S1}]+(?![^{S1}])|[{S1}]+")
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_of_char() -> dict[str, int]:
    others = [b for b in range(256) if b not in PRINTABLE]
    return {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(others)}


def loaded(path: str) -> tuple[dict, dict[str, int], list[bytes]]:
    """The file, its special strings, and the bytes of each id."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    of, special = byte_of_char(), {t["content"]: t["id"] for t in file["added_tokens"]}
    named = file["model"]["vocab"]
    bytes_of = [b""] * (max([*named.values(), *special.values()]) + 1)
    for t, i in named.items():
        if t not in special:
            bytes_of[i] = bytes(map(of.__getitem__, t))
    for t, i in special.items():
        bytes_of[i] = t.encode()
    return file, special, bytes_of


class Vocabulary:
    """Tokens, merges and special strings of a file, and arrays for checking pairs."""

    def __init__(self, path: str):
        file, self.special, self.bytes_of = loaded(path)
        named, special_ids = file["model"]["vocab"], set(self.special.values())
        self.id_of = {b: i for i, b in enumerate(self.bytes_of) if b and i not in special_ids}
        size = len(self.bytes_of)
        self.longest: dict[bytes, int] = {}  # by the first two bytes
        for b in self.id_of:
            self.longest[b[:2]] = max(self.longest.get(b[:2], 1), len(b))
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in file["model"]["merges"]]
        self.merge = {(named[a], named[b]): (rank, named[a + b]) for rank, (a, b) in reversed(list(enumerate(pairs)))}
        self.made = [named[a + b] for a, b in pairs]
        self.size, self.rank = size, np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        for (a, b), (rank, made) in self.merge.items():
            if self.rank[made] < 0 or rank < self.rank[made]:
                self.rank[made], self.left[made], self.right[made] = rank, a, b
        keys = np.array([a * size + b for a, b in self.merge], np.int64)
        order = np.argsort(keys)
        self.keys, self.key_rank = keys[order], np.array([r for r, _ in self.merge.values()], np.int64)[order]
        made = np.flatnonzero(self.rank >= 0)
        first = self.crossing(self.left[made], self.right[made])
        self.whole = np.ones(size, bool)  # tokens that their own bytes merge to
        self.whole[made] = first == self.rank[made]
        for t in made[np.argsort(self.rank[made])]:  # parts come before what is made of them
            self.whole[t] &= self.whole[self.left[t]] and self.whole[self.right[t]]

    def crossing(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge across the border of tokens a and b that comes before one of them is
        complete, or of the pair itself once both are; NEVER where there is none. Both tokens are
        taken apart from the last merge to the first, b before a where ranks are equal, as merging
        goes from the left; of all pairs that stood side by side the earliest merge counts."""
        x, y = a.copy(), b.copy()
        until_x, until_y = np.full(len(a), NEVER), np.full(len(a), NEVER)
        found = np.full(len(a), NEVER)
        live = np.arange(len(a))
        while len(live):
            u, v = x[live], y[live]
            key = u * self.size + v
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.key_rank[at], NEVER)
            now = (rank < until_x[live]) & (rank <= until_y[live]) & (rank < NEVER)
            found[live[now]] = rank[now]
            ru, rv = self.rank[u], self.rank[v]
            apart_x = ru > rv
            move = live[apart_x]
            until_x[move], x[move] = ru[apart_x], self.right[u[apart_x]]
            apart_y = ~apart_x & (rv >= 0)
            move = live[apart_y]
            until_y[move], y[move] = rv[apart_y], self.left[v[apart_y]]
            live = live[apart_x | apart_y]
        return found

    def merged(self, word: bytes) -> list[int]:
        """The word's ids by merging pairs, the lowest rank first and from the left."""
        ids = [self.id_of[word[i:i + 1]] for i in range(len(word))]
        return self._merged_short(ids) if len(ids) <= 64 else self._merged_long(ids)

    def _merged_short(self, ids: list[int]) -> list[int]:
        rank = lambda a, b: self.merge.get((a, b), (NEVER,))[0]
        ranks = [*map(rank, ids, ids[1:]), NEVER]
        while (low := min(ranks)) < NEVER:
            i = ranks.index(low)
            ids[i:i + 2] = [self.made[low]]
            del ranks[i]
            if i + 1 < len(ids):
                ranks[i] = rank(ids[i], ids[i + 1])
            if i:
                ranks[i - 1] = rank(ids[i - 1], ids[i])
        return ids

    def _merged_long(self, ids: list[int]) -> list[int]:
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(m[0], i, a, b) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))
                if (m := self.merge.get((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.merge[a, b][1], -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if m := self.merge.get((ids[i], ids[after[i]])):
                    heapq.heappush(heap, (m[0], i, ids[i], ids[after[i]]))
            if (h := before[i]) >= 0 and (m := self.merge.get((ids[h], ids[i]))):
                heapq.heappush(heap, (m[0], h, ids[h], ids[i]))
        return [i for i in ids if i >= 0]

    def proposed(self, word: bytes) -> list[int]:
        """The longest token at each place."""
        out, at, end, get, longest = [], 0, len(word), self.id_of.get, self.longest.get
        while at < end:
            stop = min(end, at + longest(word[at:at + 2], 1))
            while (t := get(word[at:stop])) is None:
                stop -= 1
            out.append(t)
            at = stop
        return out

    def encode_words(self, words: list[str]) -> tuple[list[bytes], int]:
        """The ids of each word, and how many words had to be merged exactly."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        guess = list(map(self.proposed, raw))
        n = np.fromiter(map(len, guess), np.int64, len(guess))
        flat = np.fromiter(chain.from_iterable(guess), np.int64, int(n.sum()))
        of = np.repeat(np.arange(len(guess)), n)
        bad = np.zeros(len(guess), bool)
        bad[of[~self.whole[flat]]] = True
        inner = np.flatnonzero(of[1:] == of[:-1])
        pair, back = np.unique(flat[inner] * self.size + flat[inner + 1], return_inverse=True)
        fails = self.crossing(pair // self.size, pair % self.size) < NEVER
        bad[of[inner[fails[back]]]] = True
        line, end = flat.astype("<u4").tobytes(), (4 * np.cumsum(n)).tolist()
        out = [line[a:b] for a, b in zip([0, *end], end, strict=False)]
        for i in np.flatnonzero(bad).tolist():
            ids = self.merged(raw[i])
            out[i] = pack(f"<{len(ids)}I", *ids)
        return out, int(bad.sum())


class Encoder:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.any, self.first_256, self.known = regex.compile(WORDS).findall, re.compile(WORDS_1).findall, {}
        self.safe = regex.compile(r"(?<=\p{L}) (?=\p{L})")
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def find(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any(text)
        return self.first_256(text)

    def pieces(self, text: str) -> Iterator[str]:
        """The text in pieces of about PIECE characters, cut between a letter and a blank."""
        at = 0
        while len(text) - at > PIECE and (m := self.safe.search(text, at + PIECE)):
            yield text[at:m.start()]
            at = m.start()
        yield text[at:] if at else text

    def parts(self, text: str) -> Iterator[list[str] | int]:
        """Words of each piece, and the ids of special strings, in order."""
        if not self.special or not self.special.search(text):
            yield from map(self.find, self.pieces(text))
            return
        for k, part in enumerate(self.special.split(text)):
            if k % 2:
                yield self.vocabulary.special[part]
            elif part:
                yield from map(self.find, self.pieces(part))

    def learn(self, words: set[str]) -> None:
        new = list(words - self.known.keys())
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, new = {}, list(words)
        self.known.update(zip(new, self.vocabulary.encode_words(new)[0], strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; words are learnt for about PIECE characters of text at once."""
        out, held, size = [], [], 0
        for text in texts:
            made: list[bytes] = []
            out.append(made)
            for part in self.parts(text):
                held.append((made, part))
                size += 1 if isinstance(part, int) else sum(map(len, part))
                if size >= PIECE:
                    self.settle(held)
                    held, size = [], 0
        self.settle(held)
        return list(map(b"".join, out))

    def settle(self, held: list) -> None:
        self.learn(set().union(*(p for _, p in held if not isinstance(p, int))))
        get = self.known.__getitem__
        for made, part in held:
            made.append(part.to_bytes(4, "little") if isinstance(part, int) else b"".join(map(get, part)))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of each whole text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                b = batch.slice(k, ROWS)
                ids = encoder.encode(b.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array([len(i) // 4 for i in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the text that the ids stand for, special strings
    included. Bytes that aren't UTF-8 turn into U+FFFD, and an id beyond the vocabulary into nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array([*loaded(path)[2], b""], object)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                b = batch.slice(k, ROWS)
                texts = [b"".join(table[np.minimum(np.frombuffer(x, "<u4"), len(table) - 1)].tolist())
                         .decode("utf-8", "replace") for x in b.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in ("doc_id", "n_tokens", "ids")), pa.array(texts, pa.string())],
                    ["doc_id", "n_tokens", "ids", "decoded"])

    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        run, "doc_id long, n_tokens long, ids binary, decoded string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return decode(encode(docs, path), path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
