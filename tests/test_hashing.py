"""Hash draws equal the source system's Python arithmetic."""

import hashlib

import pytest

from pyspark.sql import functions as F

from cohortix.functions.hashing import (
    bucket,
    choice,
    cumulative_thresholds,
    inclusive_threshold,
    md5_prefix_id,
)
from cohortix.operators.experiments import assign_variant, poisson_cuts


def py_bucket(s: str) -> int:
    return int(hashlib.md5(s.encode()).hexdigest(), 16) % 1_000_000


def py_assign(user_id, exp, variants, allocation):
    p = py_bucket(f"{user_id}_{exp}") / 1_000_000
    cum = 0
    for v, a in zip(variants, allocation):
        cum += a
        if p <= cum:
            return v
    return variants[0]


def test_bucket_matches_python_bigint(spark):
    df = spark.range(0, 3000).select(F.col("id").alias("user_id"))
    rows = df.select("user_id", bucket(F.col("user_id"), F.lit("_exp")).alias("b")).collect()
    for r in rows:
        assert r.b == py_bucket(f"{r.user_id}_exp")


def test_variant_assignment_matches_python(spark):
    variants, alloc = ["a", "b", "c"], [0.33, 0.33, 0.34]
    df = spark.range(0, 2000).select(F.col("id").alias("user_id"))
    rows = df.select("user_id", assign_variant(F.col("user_id"), "exp1", variants, alloc).alias("v")).collect()
    for r in rows:
        assert r.v == py_assign(r.user_id, "exp1", variants, alloc)


def test_assignment_is_deterministic(spark):
    df = spark.range(0, 500).select(F.col("id").alias("user_id"))
    a = df.select(assign_variant(F.col("user_id"), "e", ["x", "y"], [0.5, 0.5]).alias("v")).collect()
    b = df.repartition(7).select(assign_variant(F.col("user_id"), "e", ["x", "y"], [0.5, 0.5]).alias("v")).collect()
    assert sorted(r.v for r in a) == sorted(r.v for r in b)


def test_thresholds_follow_float_semantics():
    for c in [0.33, 0.66, 1.0, 0.1 + 0.2, 0.5]:
        t = inclusive_threshold(c)
        assert t / 1_000_000 <= c
        assert t == 999_999 or (t + 1) / 1_000_000 > c
    assert cumulative_thresholds([0.33, 0.33, 0.34])[-1] == 999_999


def test_choice_fallback_is_first_value(spark):
    # weights summing below one leave buckets above the last cut: first value
    df = spark.createDataFrame([(999_999,), (0,)], "b long")
    rows = df.select(choice(F.col("b"), ["x", "y"], [0.1, 0.1]).alias("c")).collect()
    assert [r.c for r in rows] == ["x", "x"]


def test_md5_prefix_id(spark):
    df = spark.createDataFrame([(7,)], "u long")
    r = df.select(md5_prefix_id(F.col("u"), F.lit("exp"), F.lit("2024-01-01")).alias("i")).first()
    assert r.i == hashlib.md5(b"7_exp_2024-01-01").hexdigest()[:16]


def test_poisson_table_reaches_one():
    cuts = poisson_cuts(0.24)
    assert cuts[-1] == 999_999
    assert cuts == sorted(cuts)


@pytest.mark.parametrize("mean", [0.0, 0.24, 50, 200, 800])
def test_poisson_table_for_any_mean(mean):
    cuts = poisson_cuts(mean)
    assert cuts[-1] == 999_999 and cuts == sorted(cuts)
    p = [float(c + 1 - max(0, b + 1)) / 1e6 for b, c in zip([-1, *cuts], cuts)]
    got = sum(k * x for k, x in enumerate(p))
    assert got == pytest.approx(mean, abs=1e-3 + mean * 1e-4)
    assert sum((k - mean) ** 2 * x for k, x in enumerate(p)) == pytest.approx(mean, abs=1e-3, rel=0.01)
