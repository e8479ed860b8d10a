"""Sharding: a minimax contiguous partition of ordered atomic groups.

Equal texts form a group, which no cut divides; groups are ordered by the 63 upper bits of the text's
hash (texts that share them travel together). The smallest shard capacity is found by binary search,
each capacity checked greedily, and the cuts are made there.

The driver never sees all groups. It holds sums over ranges of the order, and a capacity is checked
twice: with every range taken whole (what fits then fits for sure) and with every range divisible
(what doesn't fit then never does). Where the two leave a gap, only the ranges in which a cut may
fall are divided further, so the answer is exact after a few rounds of bounded size.

A group above the fair share can't be balanced: it is a shard of its own, and the search goes on
with the rest and the other shards. Below the least capacity, cuts are drawn towards equal sizes.

Null is the empty text. Rows that repeat are rows like others. No rows give no rows; with fewer groups
than shards some shards are empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageloom.llm.common import running_totals, saved, whole_text

SHARDS, PER_ROW = 24, 8
SHIFTS = (47, 39, 31, 23, 15, 7, 0)  # bits of the order left out, round by round


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key)."""
    text = whole_text()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + F.lit(PER_ROW)).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"),
                       F.shiftrightunsigned(F.xxhash64(text), 1).alias("key"))


def greedy(sizes: np.ndarray, capacity: int, most: int) -> list[int] | None:
    """Ends of the shards when each takes what fits; None if that needs more than ``most``."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    ends, at = [], 0
    while at < len(sizes):
        end = int(np.searchsorted(sums, sums[at] + capacity, "right")) - 1
        if end <= at or len(ends) == most:
            return None
        ends.append(end)
        at = end
    return ends


def reached(nodes: list[tuple], capacity: int, shards: int, at_least: bool) -> list[int]:
    """Bytes in the first 1, 2 ... shards when each takes what fits: a bound from below or from above,
    as the atoms inside a range of several aren't known. Below, the largest of them doesn't fit."""
    sums = np.concatenate([[0], np.cumsum([x[1] for x in nodes])])
    ends, mass = [], 0
    for _ in range(shards):
        goal = min(mass + capacity, int(sums[-1]))
        i = int(np.searchsorted(sums, goal, "right")) - 1
        if i < len(nodes) and (at_least or nodes[i][3] == 1):
            inside = goal - nodes[i][2] if nodes[i][3] > 1 else 0
            goal = max(int(sums[i]), inside)
        mass = max(mass, goal)
        ends.append(mass)
    return ends


def least(test, low: int, high: int) -> int:
    """The smallest value in (low, high] that passes; ``high`` does."""
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (low, mid) if test(mid) else (mid, high)
    return high


def drawn(sizes: np.ndarray, capacity: int, most: int) -> list[int]:
    """Starts of the shards within the capacity, each cut as near to an equal share of the rest as
    the capacity lets the remaining shards hold."""
    sums = np.concatenate([[0], np.cumsum(sizes)])
    starts, at = [0], 0
    for left in range(most, 1, -1):
        goal = sums[at] + (sums[-1] - sums[at]) / left
        i = int(np.searchsorted(sums, goal, "right")) - 1
        full = int(np.searchsorted(sums, sums[at] + capacity, "right")) - 1
        near = sorted({max(i, at), min(i + 1, len(sizes)), full}, key=lambda e: abs(sums[e] - goal))
        at = next(e for e in near if sums[e] - sums[at] <= capacity
                  and greedy(sizes[e:], capacity, left - 1) is not None)
        starts.append(at)
    return starts


def cuts(groups: DataFrame, shards: int) -> tuple[int, list[int]]:
    """The least capacity, and the first key of each shard, over (key, bytes)."""
    def ranges(df: DataFrame, step: int) -> list[tuple]:
        found = (df.groupBy(F.shiftright("key", SHIFTS[step]).alias("cell"))
                 .agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("most"),
                      F.count("*").alias("n"), F.min("key").alias("first")).collect())
        return [(r["first"], r["bytes"], r["most"], r["n"], step) for r in found]

    nodes = sorted(ranges(groups, 0))
    total, big = sum(x[1] for x in nodes), max((x[2] for x in nodes), default=0)
    low = max(big, -(-total // shards)) - 1
    while nodes:
        sure = least(lambda c: reached(nodes, c, shards, True)[-1] == total, low, total + 1)
        fits = least(lambda c: reached(nodes, c, shards, False)[-1] == total, low, sure)
        sums = np.concatenate([[0], np.cumsum([x[1] for x in nodes])])
        many = np.array([x[3] > 1 for x in nodes])
        opened = np.zeros(len(nodes), bool)
        for a, b in zip(reached(nodes, fits, shards, True), reached(nodes, sure, shards, False), strict=True):
            opened |= many & (sums[:-1] < b) & (sums[1:] > a)
        if not opened.any():
            return sure, [nodes[i][0] if i < len(nodes) else 2 ** 63 - 1
                          for i in drawn(np.diff(sums), sure, shards)]
        kept = [x for x, o in zip(nodes, opened, strict=True) if not o]
        for step in {x[4] for x, o in zip(nodes, opened, strict=True) if o}:
            inside = [x[0] >> SHIFTS[step] for x, o in zip(nodes, opened, strict=True) if o and x[4] == step]
            kept += ranges(groups.where(F.shiftright("key", SHIFTS[step]).isin(inside)), step + 1)
        nodes = sorted(kept)
    return 0, [0] * shards


def assigned(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, shard, slot (gapless from 0 in a shard)."""
    rows = saved(sized(docs), "sized")
    groups = saved(rows.groupBy("key").agg(F.sum("size").alias("bytes")), "groups")
    rest = groups.agg(F.sum("bytes")).first()[0] or 0
    whole: list[int] = []  # groups that are a shard each; fewer than there are shards
    for r in groups.orderBy(F.desc("bytes"), "key").limit(shards - 1).collect():
        if r["bytes"] * (shards - len(whole)) <= rest:
            break
        whole.append(r["key"])
        rest -= r["bytes"]
    _, starts = cuts(groups.where(~F.col("key").isin(whole)), shards - len(whole))
    shard = sum(((F.col("key") >= F.lit(s)).cast("int") for s in starts[1:]), F.lit(0)) + len(whole)
    for k, key in enumerate(whole):
        shard = F.when(F.col("key") == key, k).otherwise(shard)
    placed = rows.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"),
                         "key", F.lit(1).alias("one"))
    numbered = saved(running_totals(placed, ["shard", "doc_id", "key"], "one", "place"), "placed")
    first = numbered.groupBy("shard").agg(F.min("place").alias("first"))
    return (numbered.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot")))
