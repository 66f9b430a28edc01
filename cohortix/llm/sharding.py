"""Sharding by a minimax contiguous partition.

Groups of equal texts are atomic and ordered by their smallest doc_id.  The
smallest capacity that lets a greedy walk over the ordered groups fill at most
``n_shards`` shards is found by binary search, and the greedy walk at that
capacity gives the cuts.

The driver never sees the groups.  It works on at most ``max_blocks`` blocks of
consecutive groups (start and size in bytes).  Each round bounds the capacity
from both sides: cuts only at block borders can't beat the true optimum, blocks
cut at any byte can't miss it.  For every cut, the greedy positions under the
two bounds give an interval that holds the true cut; only blocks inside these
intervals are split, by one aggregation per round, until they are single groups.

Defined results: a null text has size 1 and crc32 0, and null texts form one
group; rows with equal ids and texts share a group; an empty table gives no
rows; a group larger than the even share fills a shard alone, later shards may
stay empty; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import running, stored, table

N_SHARDS = 16
MAX_BLOCKS = 16384


def _walk(ends: np.ndarray, single: np.ndarray, capacity: int, cuts: int, fluid: bool) -> list[int]:
    """Greedy cut positions.  ``fluid``: blocks of several groups may be cut at
    any byte; else only at their ends."""
    at, out, total = 0, [], int(ends[-1])
    for _ in range(cuts):
        reach = min(at + capacity, total)
        i = int(np.searchsorted(ends, reach, "right"))  # first block that ends beyond
        if not (fluid and i < len(ends) and not single[i]):
            reach = int(ends[i - 1]) if i else 0
        at = max(at, reach)
        out.append(at)
    return out


def _smallest(ends, single, n_shards: int, fluid: bool) -> int:
    total = int(ends[-1])
    low, high = -(-total // n_shards), total
    while low < high:
        mid = (low + high) // 2
        if _walk(ends, single, mid, n_shards, fluid)[-1] == total:
            high = mid
        else:
            low = mid + 1
    return low


def _blocks(groups: DataFrame, ranges: list[tuple[int, int]], width: int) -> list[tuple[int, int, int]]:
    inside = reduce(lambda a, b: a | b, [(F.col("before_weight") >= a) & (F.col("before_weight") < b) for a, b in ranges])
    low = F.coalesce(*[F.when((F.col("before_weight") >= a) & (F.col("before_weight") < b), F.lit(a)) for a, b in ranges])
    block = low + F.floor((F.col("before_weight") - low) / F.lit(width)) * F.lit(width)
    got = groups.where(inside).groupBy(block.alias("b")).agg(
        F.min("before_weight").alias("start"), F.sum("weight").alias("size"), F.count("*").alias("n")
    )
    return [(r["start"], r["size"], r["n"]) for r in got.collect()]


def minimax_cuts(groups: DataFrame, n_shards: int, max_blocks: int = MAX_BLOCKS) -> tuple[int, list[int]]:
    """Smallest capacity and the n_shards - 1 cut positions, in bytes before the
    cut.  ``groups`` has weight (1 or more) and before_weight."""
    total = groups.agg(F.sum("weight")).first()[0]
    if not total:
        return 0, [0] * (n_shards - 1)
    width = -(-total // max_blocks)
    blocks = {b[0]: b for b in _blocks(groups, [(0, total)], width)}
    while True:
        rows = [blocks[k] for k in sorted(blocks)]
        start = np.array([r[0] for r in rows], dtype=np.int64)
        ends = start + np.array([r[1] for r in rows], dtype=np.int64)
        single = np.array([r[2] == 1 for r in rows])
        high = _smallest(ends, single, n_shards, False)
        low = _smallest(ends, single, n_shards, True)
        first, last = _walk(ends, single, low, n_shards - 1, False), _walk(ends, single, high, n_shards - 1, True)
        open_ = np.zeros(len(rows), dtype=bool)
        for a, b in zip(first, last, strict=True):
            open_ |= (start <= b) & (ends >= a)
        open_ &= ~single
        if not open_.any():
            return high, _walk(ends, single, high, n_shards - 1, False)
        ranges: list[tuple[int, int]] = []
        for a, b in zip(start[open_].tolist(), ends[open_].tolist(), strict=True):
            if ranges and ranges[-1][1] == a:
                ranges[-1] = (ranges[-1][0], b)
            else:
                ranges.append((a, b))
        ranges = _merged(ranges, 4 * n_shards)
        width = max(1, min(width // 2, -(-sum(b - a for a, b in ranges) // max_blocks)))
        blocks = {k: v for k, v in blocks.items() if not any(a <= k < b for a, b in ranges)}
        blocks.update({b[0]: b for b in _blocks(groups, ranges, width)})


def _merged(ranges: list[tuple[int, int]], most: int) -> list[tuple[int, int]]:
    """At most ``most`` ranges, by closing the smallest gaps."""
    while len(ranges) > most:
        i = min(range(len(ranges) - 1), key=lambda k: ranges[k + 1][0] - ranges[k][1])
        ranges[i : i + 2] = [(ranges[i][0], ranges[i + 1][1])]
    return ranges


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot: one row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.coalesce(F.unhex(F.md5("text")), F.unhex(F.lit("00"))).alias("same"),
    )
    groups = rows.groupBy("same").agg(F.sum("size").alias("weight"), F.min("doc_id").alias("first_id"))
    groups = stored(running(groups, ["first_id", "same"], ["weight"], "shard-groups"), "shard-sums")
    _, cuts = minimax_cuts(groups, n_shards, max_blocks)
    # a group lies after every cut at or before its first byte
    shard = sum((F.when(F.col("before_weight") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    rows = rows.join(groups.select("same", shard.cast("int").alias("shard")), "same").drop("same")
    rows = rows.withColumn("one", F.lit(1).cast("long"))
    ranked = running(rows, ["shard", "doc_id", "size", "text_crc32"], ["one"], "shard-rows")
    ranked = stored(ranked, "shard-ranked")
    firsts = ranked.groupBy("shard").agg(F.min("before_one").alias("first"))
    slot = (F.col("before_one") - F.col("first")).cast("long")
    return ranked.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_documents(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
