"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items (questions and answers) and documents are brought to words:
A-Z lower-cased, words are runs of ASCII letters, digits and all other code
points beyond ASCII.  Every window of 13 consecutive item words (the whole item
if it is shorter) is a pattern `` w1 w2 ... ``; the automaton scans `` words of
the text `` once and finds every occurrence of every pattern.  Occurrences are
mapped back to word numbers and, for texts with hits, to code-point offsets of
the original text.

The texts stay where they are: one map over the documents, no shuffle.  The
automaton is built once per worker from broadcast items, whose total size is
checked on Spark first.  A benchmark beyond ``max_bytes`` is cut into blocks of
whole items, one automaton and one map each, and the hits of the blocks (rows
with hits only) are joined back per document.

Defined results: null and empty texts and items have no words; a null item_id
still marks words but names no item; rows of one item_id are one item with all
their windows; repeated documents are each judged; empty tables give no rows or
no hits; further columns are ignored.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import stored, table

WINDOW = 13
#: contaminated if at least one word in so many is hit
SHARE = 20
#: UTF-8 bytes of items that one automaton may hold
MAX_BYTES = 8 << 20

_WORD = "[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def build(items: list[tuple[str | None, str | None]], window: int = WINDOW):
    """Automaton whose values are (pattern length in words, item ids)."""
    patterns: dict[bytes, tuple[int, set]] = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            patterns.setdefault(b" ".join(words[i : i + size]), (size, set()))[1].add(item)
    found = ahocorasick.Automaton()
    for pattern, (size, names) in patterns.items():
        found.add_word(f" {pattern.decode('latin-1')} ", (len(pattern) + 2, size, frozenset(names - {None})))
    if patterns:
        found.make_automaton()
    return found


def scan(text: str | None, automaton) -> tuple[int, np.ndarray, set]:
    """Number of words, mask of the words that are hit, items that occur."""
    words = words_of(text)
    hit = np.zeros(len(words), bool)
    items: set = set()
    if words and len(automaton):
        line = f" {b' '.join(words).decode('latin-1')} "
        found = list(automaton.iter(line))
        if found:
            starts = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
            edge = np.zeros(len(words) + 1, np.int64)
            at = np.searchsorted(starts, [end - size + 1 for end, (size, _, _) in found])
            np.add.at(edge, at, 1)
            np.add.at(edge, at + [n for _, (_, n, _) in found], -1)
            hit = np.cumsum(edge[:-1]) > 0
            items.update(*(names for _, (_, _, names) in found))
    return len(words), hit, items


def spans_of(text: str, hit: np.ndarray) -> list[tuple[int, int]]:
    """Code-point offsets (start, end) in the original text of runs of hit words."""
    out: list[tuple[int, int]] = []
    before = False
    for word, on in zip(re.finditer(_WORD, text), hit, strict=True):
        if on and before:
            out[-1] = (out[-1][0], word.end())
        elif on:
            out.append(word.span())
        before = on
    return out


_SCHEMA = "n_words long, n_hit long, items array<string>, hit_spans array<struct<start:int,end:int>>, hit_words array<int>"


def _mapper(items, window: int):
    """Scans of a column of texts against the broadcast items."""
    held: list = []

    @F.pandas_udf(_SCHEMA)
    def scanned(texts: pd.Series) -> pd.DataFrame:
        if not held:
            held.append(build(items.value, window))
        rows = []
        for text in texts:
            n, hit, names = scan(text, held[0])
            some = bool(hit.any())
            rows.append((n, int(hit.sum()), sorted(names), spans_of(text, hit) if some else [], np.flatnonzero(hit).tolist() if some else []))
        return pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "hit_spans", "hit_words"])

    return scanned


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_bytes: int = MAX_BYTES, carry: bool = False) -> DataFrame:
    """All columns of ``docs`` and ``_scan``: n_words, n_hit, items, hit_spans, hit_words.
    With ``carry`` the columns come as one struct ``_row``, whatever their names;
    without it an incoming ``_scan`` gives way."""
    found = _found(docs.select(F.struct(*docs.columns).alias("_row"), "text"), benchmark, window, max_bytes)
    return found if carry else found.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c != "_scan"], "_scan")


def _found(docs: DataFrame, benchmark: DataFrame, window: int, max_bytes: int) -> DataFrame:
    """_row, _scan."""
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), "text").where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0))).first()[0]
    n = max(1, -(-size // max_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n)))

    def scanned(frame: DataFrame, block: int) -> DataFrame:
        rows = [(r["id"], r["text"]) for r in items.where(F.col("block") == block).collect()]
        return frame.withColumn("_scan", _mapper(spark.sparkContext.broadcast(rows), window)("text"))

    if n == 1:
        return scanned(docs, 0).select("_row", "_scan")
    key = [F.xxhash64("text").alias("_h"), F.md5("text").alias("_m")]
    found = None
    for block in range(n):  # the number of blocks follows the benchmark, not the corpus
        got = scanned(docs.select("text", *key).where("text is not null"), block).where("_scan.n_hit > 0").select("_h", "_m", "_scan")
        got = stored(got.dropDuplicates(["_h", "_m"]), "decontam-hits")
        found = got if found is None else found.unionByName(got)
    flat = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    found = found.groupBy("_h", "_m").agg(flat("_scan.items").alias("_items"), flat("_scan.hit_spans").alias("_spans"), flat("_scan.hit_words").alias("_hits"))
    plain = docs.withColumn("_scan", _mapper(spark.sparkContext.broadcast([]), window)("text")).withColumns({"_h": key[0], "_m": key[1]})
    merged = plain.join(found, ["_h", "_m"], "left")
    none = lambda c, own: F.coalesce(F.col(c), F.col(own))
    whole = F.struct(
        F.col("_scan.n_words").alias("n_words"), F.size(none("_hits", "_scan.hit_words")).cast("long").alias("n_hit"),
        none("_items", "_scan.items").alias("items"), none("_spans", "_scan.hit_spans").alias("hit_spans"), none("_hits", "_scan.hit_words").alias("hit_words"),
    )
    return merged.select("_row", whole.alias("_scan"))


def contaminated(scan_col: str = "_scan"):
    n, hit = F.col(f"{scan_col}.n_words"), F.col(f"{scan_col}.n_hit")
    return (hit > 0) & (SHARE * hit >= n)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    names = F.col("_scan.items")
    return out.select(
        "doc_id", F.col("_scan.n_words").alias("n_words"), F.col("_scan.n_hit").alias("n_hit"),
        F.size(names).cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"), F.col("_scan.hit_spans").alias("hit_spans"),
    )

