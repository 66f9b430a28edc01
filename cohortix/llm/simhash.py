"""SimHash near-dedup with BK-trees.

A fingerprint has the majority bit of the XXH64 values of a text's word
shingles.  Two fingerprints within ``radius`` bits agree exactly on some
``keep`` of ``radius + keep`` bit blocks, so the distinct fingerprints are
dealt into one shard per (choice of blocks, value of those blocks): every link
lies inside a shard.  Each shard gets a BK-tree (a child's key is its Hamming
distance to the parent); each of its fingerprints is looked up by following
only the edges whose key is within ``radius`` of its distance to the node.
Trees of many small shards are built and searched side by side in numpy.

A task hands on one edge per fingerprint to the root of its group in the shard,
never the pairs, so a group of thousands of near copies gives linearly many
edges.  A shard of more than ``max_shard`` fingerprints is dealt into cells of
two blocks each, one task per cell, which together hold every pair.  Components
of the edges are found by alternating large and small stars on tables in the
shared folder; nothing of this is collected to the driver.

Defined results: null and empty texts have fingerprint zero and link like any
other; exact copies share a fingerprint and so a component; a null doc_id never
names a component (its rows carry the component of their fingerprint, null if
no id is in it); repeated rows are all returned; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import stored, table

SHINGLE, RADIUS = 3, 3
#: bit blocks that a shard fixes, of RADIUS + KEEP
KEEP = 2
MAX_SHARD = 16384
#: (query, node) pairs that a search holds at once
_FRONTIER = 1 << 20


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of one text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, 42) for g in grams), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_udf(shingle: int = SHINGLE):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of


class Forest:
    """One BK-tree per shard over distinct codes; ``shard`` is sorted."""

    def __init__(self, codes: np.ndarray, shard: np.ndarray):
        self.codes = codes
        new = np.r_[True, shard[1:] != shard[:-1]] if len(shard) else np.zeros(0, bool)
        self.root = np.flatnonzero(new)[np.cumsum(new) - 1] if len(shard) else np.zeros(0, np.int64)
        keys, children = [], []
        item, node = np.flatnonzero(~new), self.root[~new]
        while len(item):
            key = node * 65 + np.bitwise_count(codes[item] ^ codes[node]).astype(np.int64)
            own, first, back = np.unique(key, return_index=True, return_inverse=True)
            keys.append(own)
            children.append(item[first])  # the first item at (node, distance) becomes that child
            rest = np.ones(len(item), bool)
            rest[first] = False
            node, item = item[first][back][rest], item[rest]
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        order = np.argsort(self.keys)
        self.keys = self.keys[order]
        self.children = (np.concatenate(children) if children else np.zeros(0, np.int64))[order]

    def links(self, radius: int):
        """Yields arrays (a, b), a < b, of the codes of one shard within ``radius``."""
        queue = [(np.arange(len(self.codes)), self.root)]
        while queue:
            query, node = queue.pop()
            if len(query) > _FRONTIER:
                half = len(query) // 2
                queue += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            apart = np.bitwise_count(self.codes[query] ^ self.codes[node]).astype(np.int64)
            hit = (apart <= radius) & (query < node)
            if hit.any():
                yield query[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(apart - radius, 1))
            many = np.searchsorted(self.keys, node * 65 + np.minimum(apart + radius, 64), "right") - low
            if many.sum():
                at = np.repeat(low - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
                queue.append((np.repeat(query, many), self.children[at]))


def _united(n: int, links) -> np.ndarray:
    """Smallest index of each item's group."""
    label = np.arange(n)
    for a, b in links:
        while len(a):
            a, b = label[a], label[b]
            apart = a != b
            a, b = np.minimum(a[apart], b[apart]), np.maximum(a[apart], b[apart])
            np.minimum.at(label, b, a)
            while (label != (up := label[label])).any():
                label = up
    return label


def _edges(radius: int):
    """Rows (shard, fp) sorted by shard -> edges (fp, root) of each shard's groups."""

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        shard = rows["shard"].to_numpy()
        code = rows["fp"].to_numpy()
        same = shard[1:] == shard[:-1]
        shared = np.r_[False, same] | np.r_[same, False]
        shard, code = shard[shared], code[shared]
        forest = Forest(code.view(np.uint64), shard)
        label = _united(len(code), forest.links(radius))
        own = label != np.arange(len(code))
        return pd.DataFrame({"a": code[own], "b": code[label[own]]})

    def run(batches):
        held: list[pd.DataFrame] = []
        size = 0
        for rows in batches:
            held.append(rows)
            size += len(rows)
            last = rows["shard"].iloc[-1] if len(rows) else None
            if size < 1 << 17 or last is None:
                continue
            whole = pd.concat(held, ignore_index=True)
            cut = int(np.searchsorted(whole["shard"].to_numpy(), last))  # the last shard may go on
            held, size = [whole.iloc[cut:]], len(whole) - cut
            if cut:
                yield solve(whole.iloc[:cut].reset_index(drop=True))
        if size:
            yield solve(pd.concat(held, ignore_index=True))

    return run


def block_masks(radius: int, keep: int) -> list[int]:
    """Signed 64-bit masks: every choice of ``keep`` of ``radius + keep`` blocks."""
    n = radius + keep
    cut = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << cut[i + 1]) - 1) ^ ((1 << cut[i]) - 1) for i in range(n)]
    masks = [sum(c) for c in combinations(blocks, keep)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def link_edges(prints: DataFrame, radius: int = RADIUS, keep: int = KEEP, max_shard: int = MAX_SHARD) -> DataFrame:
    """a, b: edges that connect all distinct fingerprints ``fp`` within ``radius``."""
    shards = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m)).alias("value")) for i, m in enumerate(block_masks(radius, keep))])
    rows = prints.select("fp", F.explode(shards).alias("s")).select("fp", "s.mask", "s.value")
    large = stored(rows.groupBy("mask", "value").count().where(F.col("count") > max_shard), "simhash-large")
    # the shard's name is a hash: two shards under one name only share a tree
    if large.isEmpty():
        rows = rows.select(F.xxhash64("mask", "value").alias("shard"), "fp")
    else:
        cells = F.ceil(F.col("count") / max_shard).cast("int")
        rows = rows.join(large, ["mask", "value"], "left").withColumn("cells", F.coalesce(cells, F.lit(1)))
        own = F.pmod(F.xxhash64("fp", F.lit("cell")), F.col("cells")).cast("int")
        rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        cell = F.xxhash64("mask", "value", F.least("own", "other"), F.greatest("own", "other"))
        rows = rows.select(cell.alias("shard"), "fp")
    rows = rows.repartition("shard").sortWithinPartitions("shard", "fp")
    return rows.mapInPandas(_edges(radius), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """fp, root (smallest fp of its component) for every end of an edge."""
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v"), "simhash-edges")
    mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = mark(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))
        )).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        edges = stored(small, "simhash-stars")
        after = mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("fp"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("fp"), F.col("v").alias("root")).distinct()
    )


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, keep: int = KEEP, max_shard: int = MAX_SHARD
) -> DataFrame:
    """doc_id, fp, component_id: one row per row of ``docs``."""
    rows = stored(docs.select("doc_id", fingerprint_udf(shingle)("text").alias("fp")), "simhash-prints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    linked = components(link_edges(prints.select("fp"), radius, keep, max_shard))
    prints = prints.join(linked, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = prints.groupBy("root").agg(F.min("first").alias("component_id"))
    prints = prints.join(first, "root").select("fp", "component_id")
    return rows.join(prints, "fp").select("doc_id", "fp", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
