"""Substring dedup by compacting a de Bruijn graph of token k-mers.

Edges are the 16-word k-mers of the texts.  Every 50-word window is led by the
k-mer with the least hash in it, so the windows of a text fall into paths: runs
of neighbouring windows led by one k-mer occurrence (up to 35 windows, 84
words).  A path is named by that k-mer and a 128-bit digest of all its words.

Compaction: equal paths collapse to one row with their smallest doc_id.  A
k-mer with one path only does not branch; all its occurrences outside the
smallest document repeat that document, window by window.  A k-mer with several
paths branches: its paths agree near the k-mer and differ further out.  Only
there, and only for one document of each path, the path is opened into its
windows, whose 128-bit digests meet in a join; other copies of the path are
settled by the path itself.

Source coordinates: every row carries document and word position, the spans
found are joined back to the texts, and words are counted and cut there.  A
window is removed if and only if its word sequence also starts in a document
with a smaller doc_id; windows are judged on the input.

Texts are shuffled twice by document (to open branching paths and to cut); all
other shuffles carry paths, about one per 18 words, or what is left of them.

Defined results: null and empty texts have no words; rows that share a doc_id
are judged each by its own text and never remove one another; a null doc_id
counts as larger than every id; repeated rows are all returned; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm.common import stored, table

WINDOW, KMER = 50, 16
_LAST = (1 << 63) - 1
#: words that a task hashes at once
_CHUNK = 1 << 19
#: fixed odd multipliers of the mixing steps
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_C, _D = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_29, _32 = np.uint64(29), np.uint64(32)


def _mix(a: np.ndarray, b: np.ndarray, m: np.uint64, k: np.uint64) -> np.ndarray:
    x = (a ^ (a >> _29)) * m
    x += b
    x ^= x >> _32
    x *= k
    x ^= x >> _29
    return x


def _grams(h: np.ndarray, size: int, m: np.uint64, k: np.uint64) -> np.ndarray:
    """Digest of the ``size`` words from each position on, by doubling."""
    out, have, power, span = None, 0, h, 1
    while True:
        if size & span:
            if out is None:
                out, have = power, span
            else:
                n = len(power) - have
                out, have = _mix(out[:n], power[have : have + n], m, k), have + span
        if have == size:
            return out[: max(0, len(h) - size + 1)]
        power = _mix(power[:-span], power[span:], m, k) if len(power) > span else power[:0]
        span *= 2


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Position of the least (leftmost) of the ``width`` values from each position on."""
    at, span = np.arange(len(h)), 1

    def less(a, b):
        return np.where(h[b] < h[a], b, a)

    while 2 * span <= width:
        at = less(at[:-span], at[span:])
        span *= 2
    rest = width - span
    return less(at[: len(at) - rest], at[rest:]) if rest else at


def _hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """Word digests of all texts in a row, and the number of words of each."""
    digest, parts = xxhash.xxh3_64_intdigest, []
    for t in texts:
        words = t.encode().split() if t else []
        parts.append(np.fromiter(map(digest, words), np.uint64, len(words)))
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), sizes


def _pieces(rows: pd.DataFrame):
    """Rows in pieces of about _CHUNK words (by length in characters)."""
    if not len(rows):
        return
    end = np.cumsum(rows["text"].str.len().fillna(0).to_numpy())
    piece = (end // (_CHUNK * 6)).astype(np.int64)
    for _, part in rows.groupby(piece, sort=False):
        yield part


def _windows(sizes: np.ndarray, window: int, n: int) -> np.ndarray:
    """Which positions start a window that lies in one text."""
    ok = np.zeros(n, bool)
    for end, size in zip(np.cumsum(sizes), sizes, strict=True):
        if size >= window:
            ok[end - size : end - window + 1] = True
    return ok


_PATH = "did long, th long, kmer long, p1 long, p2 long, lo int, n int"


def _paths(window: int, kmer: int):
    def run(batches):
        for rows in batches:
            for part in _pieces(rows):
                h, sizes = _hashes(part["text"])
                if len(h) < window:
                    continue
                ok = _windows(sizes, window, len(h))[: len(h) - window + 1]
                start = np.flatnonzero(ok)
                if not len(start):
                    continue
                k = _grams(h, kmer, _A, _C)
                lead = _least(k, window - kmer + 1)[start]
                new = np.r_[True, (lead[1:] != lead[:-1]) | (start[1:] != start[:-1] + 1)]
                lo = start[new]
                many = np.diff(np.r_[np.flatnonzero(new), len(start)])
                shape = (many * 64 + (lead[new] - lo)).astype(np.uint64)
                w1, w2 = _grams(h, window, _A, _D), _grams(h, window, _B, _C)
                first, last = lo, lo + many - 1
                p1 = _mix(_mix(w1[first], w1[last], _A, _D), shape, _B, _C)
                p2 = _mix(_mix(w2[first], w2[last], _B, _C), shape, _A, _D)
                doc = np.repeat(np.arange(len(sizes)), sizes)[lo]
                begin = (np.cumsum(sizes) - sizes)[doc]
                yield pd.DataFrame({
                    "did": part["did"].to_numpy()[doc], "th": part["th"].to_numpy()[doc], "kmer": k[lead[new]].view(np.int64),
                    "p1": p1.view(np.int64), "p2": p2.view(np.int64), "lo": (lo - begin).astype(np.int32), "n": many.astype(np.int32),
                })

    return run


_WIN = "w1 long, w2 long, did long, th long, lo int"


def _opened(window: int):
    """Digests of the windows of the paths listed in ``spans``."""

    def run(batches):
        for rows in batches:
            for part in _pieces(rows):
                h, sizes = _hashes(part["text"])
                if len(h) < window:
                    continue
                w1, w2 = _grams(h, window, _A, _D), _grams(h, window, _B, _C)
                begin = np.cumsum(sizes) - sizes
                for at, did, th, spans in zip(begin, part["did"], part["th"], part["spans"], strict=True):
                    lo = np.unique(np.concatenate([np.arange(s["lo"], s["lo"] + s["n"]) for s in spans]))
                    yield pd.DataFrame({"w1": w1[at + lo].view(np.int64), "w2": w2[at + lo].view(np.int64), "did": did, "th": th, "lo": lo.astype(np.int32)})

    def merged(batches):
        held, size = [], 0
        for frame in run(batches):
            held.append(frame)
            size += len(frame)
            if size >= 1 << 16:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
        if held:
            yield pd.concat(held, ignore_index=True)

    return merged


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("did", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))).withColumn("th", F.xxhash64("text"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, kmer: int = KMER) -> DataFrame:
    """did, th, spans: per document the runs (lo, n) of windows that also start
    in a document with a smaller id."""
    keyed = _keyed(docs.select("doc_id", "text")).select("did", "th", "text")
    paths = stored(keyed.mapInPandas(_paths(window, kmer), _PATH), "paths")
    path = ["kmer", "p1", "p2"]
    unitigs = paths.groupBy(*path).agg(F.min("did").alias("first"), F.max("did").alias("last"))
    kmers = unitigs.groupBy("kmer").agg(F.count("*").alias("ways"), F.min("first").alias("lo_id"), F.max("last").alias("hi_id"))
    kmers = kmers.where("lo_id < hi_id").select("kmer", (F.col("ways") > 1).alias("branch"))
    unitigs = unitigs.join(kmers, "kmer").where("branch OR first < last").select(*path, "first", "branch")
    marks = paths.join(unitigs, path).where("did > first OR branch")
    # rows that are equal in id and text have equal paths: each counts once, so lists are bounded by one text
    marks = marks.select("did", "th", "lo", "n", (F.col("did") > F.col("first")).alias("again")).distinct()
    marks = marks.groupBy("did", "th").agg(
        F.collect_list(F.when(F.col("again"), F.struct("lo", "n"))).alias("known"),
        F.collect_list(F.when(~F.col("again"), F.struct("lo", "n"))).alias("spans"),
    )
    marks = stored(marks, "path-marks")
    branching = keyed.join(marks.where(F.size("spans") > 0).select("did", "th", "spans"), ["did", "th"])
    windows = stored(branching.mapInPandas(_opened(window), _WIN), "windows")
    firsts = windows.groupBy("w1", "w2").agg(F.min("did").alias("first"), F.max("did").alias("last")).where("first < last")
    late = windows.join(firsts, ["w1", "w2"]).where("did > first").select("did", "th", "lo").distinct()
    late = late.groupBy("did", "th").agg(F.collect_list(F.struct("lo", F.lit(1).alias("n"))).alias("spans"))
    both = marks.where(F.size("known") > 0).select("did", "th", F.col("known").alias("spans")).unionByName(late)
    return stored(both.groupBy("did", "th").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")


def _removed(n: int, spans, window: int) -> np.ndarray:
    edge = np.zeros(n + 1, np.int64)
    for s in spans if spans is not None else ():
        edge[s["lo"]] += 1
        edge[min(n, s["lo"] + s["n"] + window - 1)] -= 1
    return np.cumsum(edge[:-1]) > 0


def cut(docs: DataFrame, window: int = WINDOW, kmer: int = KMER, carry: bool = False) -> DataFrame:
    """All columns of ``docs`` and ``_cut``: n_words, n_removed, kept_sha256 of
    the kept words joined by one space, and kept_text, the text without the
    removed words (unchanged if there are none).  With ``carry`` the columns come
    as one struct ``_row``, whatever their names; without it an incoming ``_cut``
    gives way."""
    spans = repeated_spans(docs, window, kmer)

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string, kept_text string")
    def cutting(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, found in zip(texts, spans, strict=True):
            words = text.encode().split() if text else []
            gone = 0
            if found is not None and len(found):
                mask = _removed(len(words), found, window)
                gone = int(mask.sum())
                kept = b" ".join([w for w, off in zip(words, mask, strict=True) if not off])
                after = kept.decode() if gone else text
            else:
                kept, after = b" ".join(words), text
            rows.append((len(words), gone, hashlib.sha256(kept).hexdigest(), after))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256", "kept_text"])

    keyed = _keyed(docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", "text"))
    out = keyed.join(spans, ["did", "th"], "left").select("_row", cutting("text", "spans").alias("_cut"))
    return out if carry else out.select(*[F.col("_row")[c].alias(c) for c in docs.columns if c != "_cut"], "_cut")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cut(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "_cut.n_words", "_cut.n_removed", "_cut.kept_sha256")


SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS rid, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), wins AS (
  SELECT doc_id, rid, s, list_slice(w, s, s + 49) AS g FROM (SELECT doc_id, rid, w, unnest(range(1, len(w) - 48)) AS s FROM docs WHERE len(w) >= 50)
), hashed AS (SELECT doc_id, rid, s, md5(array_to_string(g, ' ')) AS g FROM wins),
firsts AS (SELECT g, min(doc_id) AS first FROM hashed GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT rid, unnest(range(s, s + 50)) AS i FROM hashed JOIN firsts USING (g) WHERE doc_id > first),
lists AS (SELECT rid, list(i) AS gone FROM gone GROUP BY rid),
kept AS (
  SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed, w, gone, docs.rid
  FROM docs LEFT JOIN lists ON docs.rid = lists.rid
), words AS (
  SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM docs
), left_over AS (
  SELECT words.rid, string_agg(word, ' ' ORDER BY words.i) AS text FROM words LEFT JOIN gone ON words.rid = gone.rid AND words.i = gone.i
  WHERE gone.i IS NULL GROUP BY words.rid
)
SELECT doc_id, n_words, n_removed, sha256(coalesce(left_over.text, '')) AS kept_sha256
FROM kept LEFT JOIN left_over ON kept.rid = left_over.rid
"""
