"""Words of many texts at once, as hashes, by array operations on their bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_ODD = 0x9E3779B97F4A7C15
PIECE = 1 << 20  # bytes of text handled at once

_table = np.arange(256, dtype=np.uint8)
_table[65:91] += 32
_table[[c for c in range(128) if not chr(c).isalnum()]] = 0


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    one = np.full(n, _ODD, np.uint64)
    inverse = np.full(n, pow(_ODD, -1, 1 << 64), np.uint64)
    one[0] = inverse[0] = 1
    return np.cumprod(one), np.cumprod(inverse)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, 64-bit hash of the word) for each word in order. A word is a run of
    ASCII letters and digits, A-Z lower-cased, and of bytes beyond ASCII."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    b = _table[np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)]
    inside = np.concatenate([[0], (b != 0).view(np.int8), [0]])
    turn = np.diff(inside)
    start, end = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
    up, down = _powers(len(b) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(up[:len(b)] * (b.astype(np.uint64) + np.uint64(1)))])
    h = _mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    return np.searchsorted(ends, start, "right"), h


def pieces(texts: list[str], piece: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as bytes in order, some at a time: (index of the first, texts). One that is longer
    than ``piece`` comes alone."""
    first, size, held = 0, 0, []
    for i, t in enumerate(texts):
        t = t.encode("utf-8", "surrogatepass")
        if held and size + len(t) > piece:
            yield first, held
            first, size, held = i, 0, []
        held.append(t)
        size += len(t)
    if held:
        yield first, held
