"""Token ids as binary segments with Elias-Fano document boundaries.

A segment is one value of a binary column, at most ``SEGMENT_IDS`` ids beyond one document's, in a
table that Spark commits: a lost task leaves no half-written file. Segments hold documents in ascending
order of doc_id (nulls first, ties by a hash of the text). A segment's bytes, all little-endian:

    header   magic "PLTK", id width in bytes (u16), null doc_ids at the start (u16), documents (u32), ids (u32)
    ids      concatenated, 2 or 4 bytes each as the largest id needs
    bounds   the documents' ends among the ids, Elias-Fano
    doc_ids  first doc_id (i64), then the differences to it, Elias-Fano

An Elias-Fano sequence of n values up to u has low = floor(log2(u / n)) low bits each, packed, and the
rest in unary in a bit vector: about n (2 + low) bits in place of 64 n. Every 64th set bit's position is
kept (u32), so that ``select`` reads one value without decoding those before it.

A null text is the empty text; every document ends with ``end_id``, so none has no ids. Rows that
repeat are written as often as they occur. No rows give no segments and no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from struct import calcsize, pack, unpack_from

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.bpe import L1, N1, S1
from pageloom.llm.common import saved, whole_text

MAGIC, HEADER, SEQUENCE = b"PLTK", "<4sHHII", "<QIBxxxI"
END_ID, SEGMENT_IDS, SAMPLE, TEXTS, KNOWN_WORDS = 1, 1 << 20, 64, 256, 600_000


class EliasFano:
    """A sequence of ascending numbers, as bytes at a place of a buffer."""

    @staticmethod
    def encoded(values: np.ndarray) -> bytes:
        v = values.astype(np.uint64)
        n, top = len(v), int(v[-1]) if len(v) else 0
        low = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = ((v[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        ones = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(ones[-1]) // 64 + 1) * 64 if n else 0, np.uint8)
        high[ones] = 1
        samples = ones[::SAMPLE].astype("<u4").tobytes()
        lows = np.packbits(bits.ravel(), bitorder="little").tobytes()
        return pack(SEQUENCE, top, n, low, len(high) // 8) + samples + lows + np.packbits(high, bitorder="little").tobytes()

    def __init__(self, buffer: bytes, at: int):
        self.top, self.n, self.low, high = unpack_from(SEQUENCE, buffer, at)
        at += calcsize(SEQUENCE)
        samples, lows = -(-self.n // SAMPLE), -(-self.n * self.low // 8)
        self.samples = np.frombuffer(buffer, "<u4", samples, at)
        self.lows = np.frombuffer(buffer, np.uint8, lows, at + 4 * samples)
        self.high = np.frombuffer(buffer, np.uint8, high, at + 4 * samples + lows)
        self.end = at + 4 * samples + lows + high

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        bits = np.unpackbits(self.lows, bitorder="little")[:self.n * self.low].reshape(self.n, self.low)
        low = (bits.astype(np.uint64) << np.arange(self.low, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return ((ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)) | low

    def select(self, i: int) -> int:
        """Value i alone: from the sample before it, over the bytes up to the wanted set bit."""
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        byte = place // 8
        first = int(self.high[byte]) >> (place % 8)
        if left < first.bit_count():
            bits, base = first, place
        else:
            left -= first.bit_count()
            byte += 1
            while left >= (count := int(self.high[byte]).bit_count()):
                left, byte = left - count, byte + 1
            bits, base = int(self.high[byte]), 8 * byte
        for _ in range(left):
            bits &= bits - 1
        one = base + (bits & -bits).bit_length() - 1
        a, b = i * self.low, (i + 1) * self.low
        word = int.from_bytes(self.lows[a // 8:-(-b // 8)].tobytes(), "little") >> (a % 8)
        return ((one - i) << self.low) | (word & ((1 << self.low) - 1))


def segment(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """The bytes of a segment; ``ids`` are little-endian unsigned 32-bit integers per document."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if not len(flat) or flat.max() < 1 << 16 else 4
    nulls = sum(d is None for d in doc_ids)
    named = np.array(doc_ids[nulls:], np.int64)
    first = int(named[0]) if len(named) else 0
    apart = named.view(np.uint64) - np.array(first, np.int64).view(np.uint64)
    ends = np.cumsum([len(i) // 4 for i in ids])
    return (pack(HEADER, MAGIC, width, nulls, len(ids), len(flat)) + flat.astype(f"<u{width}").tobytes()
            + EliasFano.encoded(ends) + pack("<q", first) + EliasFano.encoded(apart))


class Segment:
    def __init__(self, data: bytes):
        magic, width, self.nulls, self.documents, n = unpack_from(HEADER, data, 0)
        if magic != MAGIC:
            raise ValueError("these bytes are no segment")
        at = calcsize(HEADER)
        self.ids = np.frombuffer(data, f"<u{width}", n, at)
        self.ends = EliasFano(data, at + width * n)
        self.first = unpack_from("<q", data, self.ends.end)[0]
        self.apart = EliasFano(data, self.ends.end + 8)

    def document(self, i: int) -> tuple[int | None, int, np.ndarray]:
        """doc_id, start in the segment and ids of document i, by two selects."""
        start = self.ends.select(i - 1) if i else 0
        of = None if i < self.nulls else (self.first + self.apart.select(i - self.nulls) + 2 ** 63) % 2 ** 64 - 2 ** 63
        return of, start, self.ids[start:self.ends.select(i)]

    def __iter__(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        starts = [0, *self.ends.all().tolist()]
        names = [None] * self.nulls + (np.array(self.first, np.int64).view(np.uint64) + self.apart.all()).view(np.int64).tolist()
        for name, a, b in zip(names, starts, starts[1:], strict=False):
            yield name, a, self.ids[a:b]


def without_cache(tokenizer) -> None:
    """Each word comes once in a while only, so that the library's own cache of words is a cost."""
    if hasattr(tokenizer.model, "_resize_cache"):
        tokenizer.model._resize_cache(0)


class Words:
    """Ids by the tokenizers library, which gets each different word of a Python worker once while it is remembered.

    The file's pattern cuts a lower-cased text into words that are encoded apart. Over the first 256
    characters its classes can be listed and lower-casing and composing change nothing else, so texts
    are cut here, and the library is given the words not met before: those of letters some at a time
    with blanks between (the token that ends a word tells where the next one begins), others one by
    one. A text with other characters, or with what may be a special string, it is given as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        without_cache(self.tokenizer)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[[i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if t.endswith("</w>")]] = True
        self.cut = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{L1}]+|[{N1}]|[^{S1}{L1}{N1}]+").findall
        self.known: dict[str, bytes] = {}

    def one_by_one(self, words: list[str]) -> None:
        for w, e in zip(words, self.tokenizer.encode_batch_fast(words, add_special_tokens=False), strict=True):
            self.known[w] = pack(f"<{len(e.ids)}I", *e.ids)

    def together(self, words: list[str]) -> None:
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(ends) != len(words):
            self.one_by_one(words)
            return
        data = ids.tobytes()
        self.known.update(zip(words, [data[a:b] for a, b in zip([0, *ends], ends, strict=False)], strict=True))

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self.known, new = {}, list(words)
        letters = [w for w in new if w.isalpha()]
        for k in range(0, len(letters), 100):
            self.together(letters[k:k + 100])
        others = [w for w in new if not w.isalpha()]
        for k in range(0, len(others), 10_000):
            self.one_by_one(others[k:k + 10_000])

    def encode(self, texts: list[str]) -> list[bytes]:
        words: list[list[str] | None] = []
        for t in texts:
            try:
                t.encode("latin-1")
                words.append(None if "<|" in t else self.cut(t.lower()))
            except UnicodeEncodeError:
                words.append(None)
        self.learn(set().union(*(w for w in words if w)))
        get = self.known.__getitem__
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
                if w is None else b"".join(map(get, w)) for t, w in zip(texts, words, strict=True)]


@lru_cache(maxsize=1)
def words_of(path: str) -> Words:
    """One table of words for all tasks that a Python worker runs one after the other, bounded by ``KNOWN_WORDS``."""
    return Words(path)


def segments(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """The written table (bucket, part, n_ids, before, data, first_id) of all documents in order; ``before`` is
    the number of ids of the bucket ahead of the segment, ``first_id`` of all buckets.

    A bucket is a range of (doc_id, hash of the text), one for each task: so many rows of one id, or without
    any, take as many buckets as they need. The texts are dealt out, and each task encodes what it has in
    order and cuts segments as it goes; segments stay where they were written. One number for each bucket
    comes to the driver and goes out again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = words_of(path), end_id.to_bytes(4, "little")
        part, before, names, ids, size, bucket = 0, 0, [], [], 0, None

        def made() -> pa.RecordBatch:
            nonlocal part, before, names, ids, size
            out = pa.RecordBatch.from_pydict(
                {"bucket": [bucket], "part": [part], "n_ids": [size], "before": [before], "data": [segment(names, ids)]},
                schema=pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("n_ids", pa.int64()),
                                  ("before", pa.int64()), ("data", pa.binary())]))
            part, before, names, ids, size = part + 1, before + size, [], [], 0
            return out

        for batch in batches:
            for k in range(0, batch.num_rows, TEXTS):
                b = batch.slice(k, TEXTS)
                bucket = b.column("bucket")[0].as_py()
                for name, x in zip(b.column("doc_id").to_pylist(), words.encode(b.column("text").to_pylist()), strict=True):
                    names.append(name)
                    ids.append(x + end)
                    size += len(x) // 4 + 1
                    if size >= SEGMENT_IDS or len(names) == 65_535:
                        yield made()
        if names:
            yield made()

    order = (F.asc_nulls_first("doc_id"), F.asc("hash"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    dealt = rows.withColumn("hash", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    table = saved(dealt.select("doc_id", "text", F.spark_partition_id().alias("bucket"))
                  .mapInArrow(run, "bucket int, part int, n_ids long, before long, data binary"), "segments")
    sizes = sorted((r.bucket, r.n_ids) for r in table.groupBy("bucket").agg(F.sum("n_ids").alias("n_ids")).collect())
    starts = [0, *accumulate(n for _, n in sizes)]
    base = table.sparkSession.createDataFrame([(k, int(s)) for (k, _), s in zip(sizes, starts, strict=False)],
                                              "bucket int, base long")
    return table.join(F.broadcast(base), "bucket").withColumn("first_id", F.col("base") + F.col("before")).drop("base")


def documents_in(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the segments by select."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, data in zip(b.column("first_id").to_pylist(), b.column("data"), strict=True):
                s = Segment(data.as_buffer())
                for k in range(0, s.documents, 1_024):
                    rows = [(of, first + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                            for of, start, ids in map(s.document, range(k, min(k + 1_024, s.documents)))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32"])

    return segments.select("first_id", "data").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
