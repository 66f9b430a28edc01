"""Corpus preparation pipeline: quality rules, near-duplicate removal, substring
dedup, benchmark decontamination, BPE encoding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's documents.  All stages but the
last return the columns of ``documents``; further columns pass through.

Defined results: null texts have no words and are rejected by the first stage;
of rows with one doc_id and one fingerprint one stays; documents without an id
stay if no document with an id is in their group, one per fingerprint; a
document that loses words to an earlier one keeps the rest, joined by one space
(its n_chars follows), even if nothing is left; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.llm import bpe, decontam, quality, simhash, substrings
from cohortix.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie near their language."""
    return quality.judge(docs, carry=docs.columns).where("kept").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every SimHash component."""
    found = stored(simhash.near_duplicates(docs), "pipeline-components")
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "fp").agg(F.count("*").alias("rows"))
    total = found.groupBy("doc_id").agg(F.count("*").alias("all"))
    kept = stored(kept.join(total, kept["doc_id"].eqNullSafe(total["doc_id"])).select(kept["doc_id"], "fp", (F.col("all") == 1).alias("single")), "pipeline-kept")
    single = kept.where("single").select("doc_id")
    out = docs.join(single, docs["doc_id"].eqNullSafe(single["doc_id"]), "left_semi")
    shared = kept.where("NOT single").select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"))
    if shared.isEmpty():
        return out
    # several rows have this id: tell them apart by their own fingerprint
    ids = shared.select("_id").distinct()
    rows = docs.join(ids, docs["doc_id"].eqNullSafe(ids["_id"]), "left_semi")
    rows = rows.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_own"), simhash.fingerprint_udf()("text").alias("_print"))
    rows = rows.join(shared, rows["_own"].eqNullSafe(shared["_id"]) & (rows["_print"] == shared["_fp"]), "left_semi")
    return out.unionByName(rows.dropDuplicates(["_own", "_print"]).select("_row.*"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-word passages that an earlier document has."""
    out = substrings.cut(docs, carry=True)
    changed = F.col("_cut.n_removed") > 0
    own = {c: F.col("_row")[c] for c in docs.columns}
    own["text"] = F.col("_cut.kept_text")
    if "n_chars" in own:
        own["n_chars"] = F.when(changed, F.length("_cut.kept_text").cast("long")).otherwise(own["n_chars"])
    return out.select(*[c.alias(name) for name, c in own.items()])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    out = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=True)
    return out.where(~decontam.contaminated()).select("_row.*")


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text."""
    return bpe.encode(docs.select("doc_id", "text"), digests=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontaminate),
    ("bpe_encoding", bpe_tokens),
]

#: SQL can't express SimHash fingerprints or BPE
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
