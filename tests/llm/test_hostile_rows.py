"""Repeated rows, clashing column names, and workers that lack the package."""

import os
import subprocess
import sys
import time

import pytest

pytest.importorskip("cohortix.llm")

import corpus_pipeline  # noqa: E402
from cohortix.llm import decontam, langid, queries, substrings  # noqa: E402

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
NAMES = ("_row", "_scan", "_cut", "_did", "did", "th", "_th", "_spans", "spans", "fp", "fp_", "_fp", "_id", "_own", "_print", "_h", "_m")
PASSAGE = " ".join(f"w{i * i % 89}x{i}" for i in range(70))


def test_substring_dedup_is_linear_in_copies(spark):
    text = PASSAGE + " tail"
    copies = spark.range(20_000).selectExpr("CAST(IF(id = 0, 5, NULL) AS LONG) AS doc_id", "'" + text + "' AS text")
    more = spark.createDataFrame([(7, "head " + PASSAGE)] * 50, "doc_id long, text string")
    start = time.time()
    got = substrings.cut(copies.unionByName(more)).groupBy("doc_id", "_cut.n_removed").count().collect()
    assert time.time() - start < 120
    assert {(r["doc_id"], r["n_removed"]): r["count"] for r in got} == {(5, 0): 1, (None, 71): 19_999, (7, 70): 50}
    spans = substrings.repeated_spans(copies.unionByName(more)).selectExpr("max(size(spans)) AS most").first()["most"]
    assert spans <= 71


def test_language_sample_counts_ids(spark):
    rare = spark.range(40_000).selectExpr("id % 40 AS doc_id", "concat('zwei drei vier ', id % 40) AS text", "'de' AS lang", "false AS held_out")
    other = spark.range(100).selectExpr("1000 + id AS doc_id", "concat('two three four ', id) AS text", "'en' AS lang", "false AS held_out")
    got = langid._sample(rare.unionByName(other), 1200).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in got} == {"de": 40, "en": 100}


@pytest.fixture(scope="module")
def clashing(spark):
    words = " ".join(f"word{i}" for i in range(60))
    data = [(1, f"{PASSAGE} {words}"), (2, f"start {PASSAGE} end"), (3, None), (3, None), (None, words), (4, ""), (4, words)]
    columns = ", ".join(f"{n} string" for n in NAMES)
    return spark.createDataFrame([(*r, "en", "s", 1, *NAMES) for r in data], f"doc_id long, text string, lang string, source string, n_chars long, {columns}")


def test_columns_with_clashing_names_come_back(spark, clashing):
    bench = spark.createDataFrame([("b", " ".join(f"word{i}" for i in range(20)))], "item_id string, text string")
    for out, own in ((substrings.cut(clashing), "_cut"), (decontam.find_contamination(clashing, bench), "_scan"), (decontam.find_contamination(clashing, bench, max_bytes=10), "_scan")):
        rows = out.collect()
        assert len(rows) == 7 and all(r[n] == n for r in rows for n in NAMES if n != own)
    bench_dir = os.path.join(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"), "clash")
    bench.write.mode("overwrite").parquet(f"{bench_dir}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, clashing, bench_dir)
        assert out.columns == clashing.columns, name
        assert all(r[n] == n for r in out.collect() for n in NAMES), name


def test_stages_and_run_take_empty_tables(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() == 0, name
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


CLEAN = """
import os, sys
from pyspark.sql import SparkSession
sys.path.insert(0, {root!r})
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
import corpus_pipeline
from cohortix.llm import queries
def probe(rows):
    try:
        import cohortix
        yield 1
    except ImportError:
        yield 0
assert spark.sparkContext.parallelize([0], 1).mapPartitions(probe).sum() == 0, "workers see the package"
for name, run in [*queries.QUERIES.items(), ("pipeline", corpus_pipeline.run)]:
    print("ran", name, run(spark, "/root/testdata/sf0.001").count(), flush=True)
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    out = subprocess.run([sys.executable, "-c", CLEAN.format(root=ROOT)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    ran = [line.split()[1] for line in out.stdout.splitlines() if line.startswith("ran ")]
    assert ran == [*queries.QUERIES, "pipeline"], out.stderr[-3000:]
