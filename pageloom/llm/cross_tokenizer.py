"""Two tokenizers aligned over a corpus, with counts of the token pairs that end together.

Tokenizer A is a byte-level file of the tokenizers library, B a sentencepiece model. Both encode a blank and
the text (B adds the blank itself), special strings as plain text. Token bytes are A's entries byte-level
decoded and B's pieces in UTF-8, U+2581 as a blank, <0xHH> as that byte. Where tokens of both end at one byte
a group of tokens ends, and the two are linked. No token is empty, so a group has one link. A text whose
joined bytes differ from the blank and the text, in A or B, has no tokens, as have null and empty texts.

Texts are cut before a blank that follows no white space. No token lies across such a place: A's pattern of
words ends there, and B has no piece with a blank behind anything else (``Aligner`` looks for one, and cuts
nothing if there is). So each chunk is aligned once, a batch of new ones together, and looked up from then on, in
a table of bounded size.

Counting, by external spills:

1. A task collects records (pair, document, number of links) and at ``SPILL_RECORDS`` of them spills: they are
   sorted by B's id, A's id and document, parted by radix of B's id, and each part is a run, compressed by
   zstd, of the pairs with their counts and of their documents. A spill is a row of a written table, together
   with its documents, so a lost task leaves no half a spill.
2. The runs of a radix are merged by a heap, ``FAN_IN`` at a time, until one is left. Only pairs with their counts
   are shuffled, documents stay where they are; so a pair that a third of all documents hold is a number a run.
   The order is by B's id first, so its highest count is known as soon as the merge gets to the next id.
3. The counts go back to the spills: each run is read in the order of the merged one beside it, and adds to its
   documents the counts of their links. A document is in one spill only, so nothing is joined or shuffled.

What step 3 sends out is bounded by the vocabularies, whatever the corpus: linked tokens end at the same byte,
so the shorter one is a suffix of the other, and a token has no more suffixes than bytes. ``bound`` is that
number (some 500,000 pairs for vocabularies of 50,000 and 32,000); ``counted`` holds on to it.

Documents without an id keep null; rows that repeat id and text are documents of their own. No rows give
no rows; other columns of ``docs`` play no part. Very long texts are taken some chunks at a time.
"""

from __future__ import annotations

import heapq
import math
import os
import re
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.bpe import loaded
from pageloom.llm.common import saved, whole_text
from pageloom.llm.token_files import without_cache

RADICES, SPILL_RECORDS, SPILL_DOCS, FAN_IN = 32, 1 << 20, 1 << 15, 64
KNOWN_CHUNKS, PIECE, LEARNT = 200_000, 1 << 20, 1 << 15
BLANK, A_BITS = "▁", 17
NO_TOKENS = None

#: Rows of spills: their documents, and per radix the pairs and the documents of the run.
SPILLS = ("spill long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, groups binary, "
          "pairs array<binary>, docs array<binary>")
OUT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")


class Aligner:
    """Tokens of both sides for pieces of text, each aligned once in a while."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        without_cache(self.a)
        self.b = SentencePieceProcessor(model_file=path_b)
        self.bytes_a = loaded(path_a)[2]
        self.bytes_b = [self._piece(i) for i in range(self.b.vocab_size())]
        if len(self.bytes_a) > 1 << A_BITS or len(self.bytes_b) > 1 << 32 - A_BITS:
            raise ValueError("a pair of ids takes more than 32 bits")
        self.len_a, self.len_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.bytes_a, self.bytes_b))
        self.name_a, self.name_b = (list(map(str, range(len(x)))) for x in (self.bytes_a, self.bytes_b))
        self.cuts = not any(b" " in x.lstrip(b" ") for x in self.bytes_b)
        self.known: dict[str, tuple[str, bytes, int, int] | None] = {}

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self.b.is_unknown(i) or self.b.is_control(i):
            return b"\xff"  # occurs in no text
        return piece.replace(BLANK, " ").encode()

    def chunks(self, piece: str) -> list[str]:
        """A piece that begins with a blank, cut; the blank that each chunk begins with left out."""
        if not self.cuts:
            return [piece[1:]]
        if piece[-1] == " " or _AFTER_SPACE.search(piece):
            return [c[1:] for c in _CUT.split(piece)]
        return piece.split(" ")[1:]

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The chunks of a blank and the text, those of about PIECE characters at once."""
        line, at = " " + text, 0
        while self.cuts and len(line) - at > PIECE and (m := _CUT.search(line, at + PIECE)):
            yield self.chunks(line[at:m.start()])
            at = m.start()
        yield self.chunks(line[at:] if at else line)

    def aligned(self, line: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """Ids of both sides, the bytes at which both end, and the tokens on both sides that do."""
        data = line.encode()
        ids_a = np.array(self.a.encode_batch_fast([line], add_special_tokens=False)[0].ids, np.int64)
        ids_b = np.array(self.b.encode(line[1:], num_threads=1), np.int64)
        if (b"".join(map(self.bytes_a.__getitem__, ids_a.tolist())) != data
                or b"".join(map(self.bytes_b.__getitem__, ids_b.tolist())) != data):
            return NO_TOKENS
        ends, i, j = np.intersect1d(np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b]), True, True)
        return ids_a, ids_b, ends, i, j

    def learn(self, new: list[str]) -> None:
        """Align chunks: those that end inside a word together, others one by one."""
        together, size = [], 0
        for c in new:
            if c[-1].isspace() or BLANK in c:
                self.known.update(self.entries([c]))
                continue
            together.append(c)
            size += len(c) + 1
            if size >= LEARNT:
                self.known.update(self.entries(together))
                together, size = [], 0
        if together:
            self.known.update(self.entries(together))

    def entries(self, chunks: list[str]) -> dict[str, tuple[str, bytes, int, int] | None]:
        """For each chunk its groups, the pairs linked and the numbers of tokens; None if it has none."""
        found = self.aligned(" " + " ".join(chunks))
        if found is NO_TOKENS:
            return {chunks[0]: None} if len(chunks) == 1 else {k: v for c in chunks for k, v in self.entries([c]).items()}
        ids_a, ids_b, ends, i, j = found
        a, b = [self.name_a[x] for x in ids_a.tolist()], [self.name_b[x] for x in ids_b.tolist()]
        stop_a, stop_b = [0, *(i + 1).tolist()], [0, *(j + 1).tolist()]
        groups = [f"{a[x] if y - x == 1 else ','.join(a[x:y])}|{b[u] if v - u == 1 else ','.join(b[u:v])}"
                  for (x, y), (u, v) in zip(pairwise(stop_a), pairwise(stop_b), strict=True)]
        links = ((ids_b[j] << A_BITS) | ids_a[i]).astype("<u4").tobytes()
        sizes = np.fromiter((len(c.encode()) + 1 for c in chunks), np.int64, len(chunks))
        last = [0, *(np.searchsorted(ends, np.cumsum(sizes)) + 1).tolist()]
        return {c: (";".join(groups[x:y]), links[4 * x:4 * y], stop_a[y] - stop_a[x], stop_b[y] - stop_b[x])
                for c, (x, y) in zip(chunks, pairwise(last), strict=True)}

    def prepare(self, chunks: set[str]) -> None:
        """Have all of ``chunks`` known."""
        new = [c for c in chunks if c not in self.known]
        if len(self.known) + len(new) > KNOWN_CHUNKS:
            self.known, new = {}, list(chunks)
        self.learn(new)

    def documents(self, texts: Iterable[str]) -> Iterator[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """Of each text n_a, n_b, n_groups, the groups as text, the different pairs and how many links each
        has. Texts are taken together up to PIECE characters."""
        held, size = [], 0
        for text in texts:
            if len(text) > PIECE:
                yield from self._together(held)
                yield self._long(text)
                held, size = [], 0
                continue
            held.append(next(self.pieces(text)) if text else [])
            size += len(text)
            if size >= PIECE:
                yield from self._together(held)
                held, size = [], 0
        yield from self._together(held)

    def _together(self, held: list[list[str]]) -> Iterator[tuple]:
        self.prepare(set().union(*held))
        for chunks in held:
            yield self._joined([chunks])

    def _long(self, text: str) -> tuple:
        def prepared() -> Iterator[list[str]]:
            for chunks in self.pieces(text):
                self.prepare(set(chunks))
                yield chunks

        return self._joined(prepared())

    def _joined(self, pieces: Iterable[list[str]]) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        n_a = n_b = 0
        groups: list[str] = []
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for chunks in pieces:
            entries = list(map(self.known.__getitem__, chunks))
            if None in entries:
                return 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
            groups.append(";".join([e[0] for e in entries]))
            n_a += sum([e[2] for e in entries])
            n_b += sum([e[3] for e in entries])
            links = np.frombuffer(b"".join([e[1] for e in entries]), "<u4")
            some, n = np.unique(links, return_counts=True)
            keys, counts = _added(np.concatenate([keys, some]), np.concatenate([counts, n])) if len(keys) else (some, n)
        return n_a, n_b, int(counts.sum()), ";".join(groups), keys.astype(np.int64), counts


_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)  # a blank at the end is no chunk: B adds none to an empty text


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


# ---- runs --------------------------------------------------------------------------------------

def _squeezed(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(
        len(arrays[0]).to_bytes(8, "little") + b"".join(a.tobytes() for a in arrays))


def _opened(run: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(run)
    n, at, out = int.from_bytes(data[:8], "little"), 8, []
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return out


PAIRS = ("<u4", "<i8", "<u4")  # pair, its links, its documents
DOCS = ("<u2", "<u4")  # the difference to the document before, links of the pair there


def runs(keys: np.ndarray, docs: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Records as runs by radix, in the order of pair and document: the pairs, and their documents."""
    order = np.argsort((keys << 16) | docs)
    keys, docs, counts = keys[order], docs[order], counts[order]
    radix = (keys >> A_BITS) % RADICES
    pairs, of = [], []
    for r in range(RADICES):
        at = np.flatnonzero(radix == r)
        key, doc, n = keys[at], docs[at], counts[at]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        links = np.add.reduceat(n, first) if len(first) else n
        pairs.append(_squeezed(key[first].astype("<u4"), links.astype("<i8"), np.diff(np.append(first, len(key))).astype("<u4")))
        of.append(_squeezed(np.diff(doc.astype("<u2"), prepend=np.zeros(1, "<u2")), n.astype("<u4")))
    return pairs, of


def spills(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The written table of spills."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, number, held, size = Aligner(path_a, path_b), 0, [], 0

        def made() -> pa.RecordBatch:
            nonlocal number
            ids, found = [d for d, _ in held], [x for _, x in held]
            keys, counts = (np.concatenate([x[k] for x in found]) for k in (4, 5))
            pairs, of = runs(keys, np.repeat(np.arange(len(found)), [len(x[4]) for x in found]), counts)
            text = zstandard.ZstdCompressor(level=1).compress("\n".join(x[3] for x in found).encode())
            number += 1
            columns = [[(TaskContext.get().partitionId() << 32) + number], [ids], *([[x[k] for x in found]] for k in range(3)),
                       [text], [pairs], [of]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _NAMES)

        for b in batches:
            texts = (t.as_py() for t in b.column("text"))
            for doc_id, found in zip(b.column("doc_id").to_pylist(), aligner.documents(texts), strict=True):
                held.append((doc_id, found))
                size += len(found[4]) + len(found[3]) // 16
                if size >= SPILL_RECORDS or len(held) == SPILL_DOCS:
                    yield made()
                    held, size = [], 0
        if held:
            yield made()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return saved(rows.mapInArrow(run, SPILLS), "spills")


_LONGS, _RUNS = pa.list_(pa.int64()), pa.list_(pa.binary())
_TYPES = [pa.int64(), *[_LONGS] * 4, pa.binary(), _RUNS, _RUNS]
_NAMES = [c.split()[0] for c in SPILLS.split(", ")]


# ---- merging -----------------------------------------------------------------------------------

def merged(frames: Iterable[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order and the sums of their counts, by a heap over the runs."""
    opened = (_opened(f, *PAIRS) for f in frames)
    keys: list[int] = []
    sums: list[int] = []
    for key, n in heapq.merge(*(zip(k.tolist(), c.tolist(), strict=True) for k, c, _ in opened)):
        if keys and keys[-1] == key:
            sums[-1] += n
        else:
            keys.append(key)
            sums.append(n)
    return np.array(keys, np.int64), np.array(sums, np.int64)


def highest(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each pair's count is the highest of its B id; pairs are in order of that id."""
    side = keys >> A_BITS
    first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]])[:len(side)])
    most = np.maximum.reduceat(counts, first) if len(first) else counts
    return counts == np.repeat(most, np.diff(np.append(first, len(side))))


def merged_runs(table: DataFrame) -> DataFrame:
    """(radix, pairs): one run for each radix, from all spills."""
    def merge(group: pa.Table) -> pa.Table:
        keys, sums = merged(x.as_py() for x in group.column("pairs"))
        return pa.table({"radix": group.column("radix")[:1], "turn": pa.array([group.column("turn")[0].as_py()], pa.int64()),
                         "pairs": pa.array([_squeezed(keys.astype("<u4"), sums, np.zeros(len(keys), "<u4"))], pa.binary())})

    left = table.count()
    level = table.select(F.posexplode("pairs").alias("radix", "pairs"), F.col("spill").alias("turn"))
    while left > 0:
        left = math.ceil(left / FAN_IN) if left > FAN_IN else 1
        dealt = level.select("radix", F.pmod(F.xxhash64("turn"), F.lit(left)).alias("turn"), "pairs")
        level = saved(dealt.groupBy("radix", "turn").applyInArrow(merge, "radix int, turn long, pairs binary"), "merged")
        left = 0 if left == 1 else left
    return level.select("radix", "pairs")


def bound(path_a: str, path_b: str) -> int:
    """More different pairs than this cannot be linked: the suffixes of all tokens."""
    aligner = Aligner(path_a, path_b)
    return int(aligner.len_a.sum() + aligner.len_b.sum())


def counted(table: DataFrame, most: int) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per radix the pairs in order, their counts and whether these are their B id's highest. The
    vocabularies bound it: ``most`` pairs, see ``bound``."""
    out, size = {}, 0
    for r in merged_runs(table).toLocalIterator():
        keys, counts, _ = _opened(r.pairs, *PAIRS)
        size += len(keys)
        if size > most:
            raise ValueError("more pairs than the vocabularies allow")
        out[r.radix] = keys, counts, highest(keys, counts)
    return out


def pair_counts(table: DataFrame) -> DataFrame:
    """(a, b, links, best) of every linked pair of ids in the corpus."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for frame in b.column("pairs"):
                keys, counts, _ = _opened(frame.as_py(), *PAIRS)
                keys = keys.astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys & ((1 << A_BITS) - 1)), pa.array(keys >> A_BITS),
                                                  pa.array(counts), pa.array(highest(keys, counts))], ["a", "b", "links", "best"])

    return merged_runs(table).select("pairs").mapInArrow(run, "a long, b long, links long, best boolean")


def contributions(pairs: list[bytes], of: list[bytes], n: int, counts: dict) -> tuple[np.ndarray, np.ndarray]:
    """What the runs of a spill add to its n documents: links with the highest count, and all counts."""
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for radix, (pair_run, doc_run) in enumerate(zip(pairs, of, strict=True)):
        keys, _, per = _opened(pair_run, *PAIRS)
        if len(keys):
            apart, links = _opened(doc_run, *DOCS)
            doc = np.cumsum(apart, dtype=np.uint16)
            known, sums, top = counts[radix]
            at = np.searchsorted(known, keys)
            np.add.at(total, doc, np.repeat(sums[at], per) * links)
            np.add.at(best, doc, np.repeat(top[at], per) * links)
    return best, total


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose pair has the highest
    count of its B id), count_sum (of the counts of all links' pairs) and the groups, ``a1,a2|b1;a3|b2``."""
    table = spills(docs, path_a, path_b)
    counts = docs.sparkSession.sparkContext.broadcast(counted(table, bound(path_a, path_b)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                own = {c: b.column(c)[row] for c in b.schema.names}
                ids = own["doc_id"].values
                best, total = contributions(own["pairs"].as_py(), own["docs"].as_py(), len(ids), counts.value)
                groups = zstandard.ZstdDecompressor().decompress(own["groups"].as_py()).decode().split("\n")
                columns = [ids, *(own[c].values for c in ("n_a", "n_b", "n_groups", "n_groups")), pa.array(best), pa.array(total)]
                for k in range(0, len(ids), 256):
                    yield pa.RecordBatch.from_arrays([*(c.slice(k, 256) for c in columns), pa.array(groups[k:k + 256], pa.string())],
                                                     [c.split()[0] for c in OUT.split(", ")])

    return table.drop("spill").mapInArrow(run, OUT)
