"""Language identification with string kernels.

A text is the set of its character 1- to 3-grams (blended spectrum, presence
only).  The kernel of two texts is the number of grams they share, over the
root of the product of their own numbers.  Landmark texts give a Nystroem map
z(x) = k(x, landmarks) K^(-1/2); one-versus-rest kernel ridge regression on z
gives one column of weights per language.  A batch is scored by matrix products:
its presence matrix times (landmark presence times weights), each row over the
root of its number of grams.

Fitting takes a bounded sample: at most ``sample`` labelled training documents,
shared out evenly over the languages, those with the smallest hash of doc_id;
the ``landmarks`` among them with the smallest hash.  Their gram sets are made
in Spark from whole texts; scoring covers whole texts of all documents in one
map without a shuffle.

Grams run over 64 symbols: white space, a-z, decimal digits, other ASCII, and
35 residues of the code points beyond ASCII (lower-cased).

Defined results: a null text or one without a letter is ``und`` with score 0,
as is every text if there is nothing to learn from; with one language learned
all texts with letters get it; rows with a null doc_id are never held out
and not learned from; rows that share doc_id and language are one row of the
sample; repeated rows are all returned; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortix.llm.common import stored, table

SAMPLE, LANDMARKS, RIDGE = 1200, 240, 1e-3
UNDETERMINED = "und"

_SIZES = (64, 64**2, 64**3)
_SPACE = (*range(9, 14), 32)


def _symbols() -> np.ndarray:
    """Symbol of every code point."""
    out = np.arange(0x110000) % 35 + 29
    out[:128] = 28
    out[list(_SPACE)] = 0
    out[97:123] = np.arange(1, 27)
    out[48:58] = 27
    return out.astype(np.uint8)


def grams(text: str, symbols: np.ndarray) -> np.ndarray:
    """Numbers of the grams in a text, one per position and length."""
    s = symbols[np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)].astype(np.int32)
    pairs = s[:-1] * 64 + s[1:]
    triples = pairs[:-1] * 64 + s[2:]
    return np.concatenate([s, pairs + _SIZES[0], triples + _SIZES[0] + _SIZES[1]])


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def held_out(doc_id: Column, divisor: int) -> Column:
    remainder = F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % divisor
    return F.coalesce(remainder == 1, F.lit(False))


def _sample(docs: DataFrame, size: int) -> DataFrame:
    """lang, grams of the documents to learn from, in order of their hash."""
    rows = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~F.col("held_out")).withColumn("h", F.xxhash64("doc_id", F.lit("langid")))
    # ids, not rows: a language of few ids in many rows keeps them all
    counts = rows.select("lang", "doc_id").distinct().groupBy("lang").agg(F.count("*").alias("n")).withColumn("langs", F.count("*").over(Window.partitionBy()))
    share = F.greatest(F.lit(1), F.floor(F.lit(size) / F.col("langs")))
    # a share of the hashes that holds some four times the wanted rows (all of a small language), then the exact number
    part = F.least(F.lit(1.0), (4 * share + 64) / F.col("n"))
    # a stored table has a known size: Spark broadcasts it if small, before rows are dealt out by language
    near = rows.join(stored(counts.select("lang", share.alias("share"), part.alias("part")), "langid-counts"), "lang")
    near = near.where(F.pmod("h", F.lit(1 << 30)) < F.col("part") * (1 << 30))
    first = Window.partitionBy("lang").orderBy("h", "doc_id")
    picked = near.groupBy("lang", "doc_id", "h").agg(F.first("share").alias("share")).withColumn("r", F.row_number().over(first)).where("r <= share")
    symbols = _symbols()

    @F.pandas_udf("array<int>")
    def gram_set(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(grams(t, symbols)) if has_letter(t) else [] for t in texts])

    # rows that share an id and a language count once, with the text of the smallest hash
    text = F.struct(F.xxhash64("text"), "text")
    chosen = rows.join(F.broadcast(picked.select("lang", "doc_id")), ["lang", "doc_id"]).groupBy("lang", "doc_id", "h")
    return chosen.agg(F.min(text)["text"].alias("text")).select("lang", "h", gram_set("text").alias("grams"))


def fit(rows: list, landmarks: int, ridge: float) -> tuple[list[str], np.ndarray, np.ndarray] | None:
    """Languages, gram numbers of the landmarks, and weights (gram x language)."""
    langs = sorted({r["lang"] for r in rows})
    if not langs:
        return None
    by_lang = {g: [r for r in rows if r["lang"] == g] for g in langs}
    turn = [(i, g, r) for g in langs for i, r in enumerate(by_lang[g])]
    turn.sort(key=lambda x: (x[0], x[1]))  # languages take turns
    marks = [r for _, _, r in turn[:landmarks]]
    vocabulary = np.unique(np.concatenate([np.asarray(r["grams"]) for r in marks]))
    place = np.full(sum(_SIZES), -1, np.int32)
    place[vocabulary] = np.arange(len(vocabulary))

    def presence(some) -> np.ndarray:
        out = np.zeros((len(some), len(vocabulary)), np.float32)
        for i, r in enumerate(some):
            at = place[np.asarray(r["grams"])]
            out[i, at[at >= 0]] = 1
        return out / np.sqrt(np.maximum(out.sum(axis=1, keepdims=True), 1))

    of_marks = presence(marks)
    values, vectors = np.linalg.eigh((of_marks @ of_marks.T).astype(np.float64))
    good = values > 1e-6 * values[-1]
    root = vectors[:, good] / np.sqrt(values[good])  # K^(-1/2) up to a rotation
    z = np.vstack([presence([r for _, _, r in turn[a : a + 256]]) @ of_marks.T for a in range(0, len(turn), 256)]).astype(np.float64) @ root
    target = np.array([[1.0 if g == h else -1.0 for h in langs] for _, g, _ in turn])
    # ridge with the mean taken out, so that rare languages keep their margin
    mean_z, mean_y = z.mean(axis=0), target.mean(axis=0)
    zc = z - mean_z
    beta = np.linalg.solve(zc.T @ zc + ridge * len(turn) * np.eye(z.shape[1]), zc.T @ (target - mean_y))
    weights = of_marks.T.astype(np.float64) @ (root @ beta)
    return langs, vocabulary, np.vstack([weights, mean_y - mean_z @ beta]).astype(np.float32)


def _predictor(model):
    """UDF text -> (lang_pred, score): presence matrix of a batch times weights."""
    symbols = _symbols()

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        langs, vocabulary, weights = model.value or ([], np.zeros(0, np.int32), np.zeros((1, 0), np.float32))
        place = np.full(sum(_SIZES), len(vocabulary), np.int32)
        place[vocabulary] = np.arange(len(vocabulary))
        names, scores = [], []
        for at in range(0, len(texts), 256):
            some = texts.iloc[at : at + 256]
            seen = np.zeros((len(some), len(vocabulary) + 1), bool)
            good = [has_letter(t) for t in some]
            for i, (t, ok) in enumerate(zip(some, good, strict=True)):
                if ok:
                    seen[i, place[grams(t, symbols)]] = True
            present = seen[:, :-1].astype(np.float32)
            length = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
            margin = present @ weights[:-1] / length + weights[-1]
            for i, ok in enumerate(good):
                if not ok or not langs:
                    names.append(UNDETERMINED)
                    scores.append(0.0)
                else:
                    best = int(margin[i].argmax())
                    names.append(langs[best])
                    scores.append(float(np.clip((margin[i, best] + 1) / 2, 0, 1)))
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return predict


def identify(docs: DataFrame, sample: int = SAMPLE, landmarks: int = LANDMARKS, ridge: float = RIDGE) -> DataFrame:
    """All rows of ``docs`` (doc_id, text, lang, held_out) as doc_id, held_out, lang_pred, score."""
    # the filter stays here: in the plan it would move below the join and run on all texts
    rows = sorted((r for r in _sample(docs, sample).collect() if r["grams"]), key=lambda r: (r["lang"], r["h"]))
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, landmarks, ridge))
    out = docs.select("doc_id", "held_out", _predictor(model)("text").alias("p"))
    return out.select("doc_id", "held_out", "p.lang_pred", "p.score")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", held_out(F.col("doc_id"), 3).alias("held_out"))
    return identify(docs)
