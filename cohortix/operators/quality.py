"""Declarative data-quality checks.

Each check returns the DataFrame of violating rows (empty = pass), so that a
failing check can be stored as a table; ``summarize`` turns a list of checks
into one row per check with its failure count and severity.  Checks never
abort a job unless their severity is ``error`` and ``enforce`` is called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    name: str
    violations: DataFrame
    severity: str = "warn"


def unique(df: DataFrame, *keys: str) -> DataFrame:
    """Keys occurring more than once (partial aggregation, skew-safe)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def not_null(df: DataFrame, id_col: str, columns) -> DataFrame:
    """(id, failed_column) for every null among ``columns``, in one pass."""
    arr = F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns])
    return df.select(id_col, F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("failed_column"))


def rule_violations(df: DataFrame, id_col: str, rules) -> DataFrame:
    """Several row-level rules in one pass: ``rules`` is a list of
    (column_name, bad_condition, reported_value); one output row per
    (row, failed rule).  A union of per-rule filters would recompute the
    input once per rule."""
    arr = F.array(*[
        F.when(F.coalesce(bad, F.lit(False)), F.struct(F.lit(name).alias("column_name"), value.alias("value")))
        for name, bad, value in rules
    ])
    return df.select(id_col, F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("_v")).select(
        id_col, "_v.column_name", "_v.value"
    )


def accepted_values_rule(column: str, values):
    c = F.col(column)
    return (column, c.isNotNull() & ~c.isin(list(values)), c.cast("string"))


def range_rule(column: str, min_value=None, max_value=None):
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < F.lit(min_value))
    if max_value is not None:
        bad = bad | (c > F.lit(max_value))
    return (column, c.isNotNull() & bad, c.cast("double"))


def count_rule_failures(df: DataFrame, rules, weighted=()) -> DataFrame:
    """Failure count per row-level rule in a single aggregate (one scan).
    ``weighted`` are (name, per-row failure count) pairs, e.g. the number of
    null required columns of a row."""
    aggs = [F.count_if(F.coalesce(bad, F.lit(False))).alias(name) for name, bad in rules]
    aggs += [F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(name) for name, n in weighted]
    rules = list(rules) + list(weighted)
    wide = df.agg(*aggs)
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("check_name"), F.col(name).alias("n_failures")) for name, _ in rules
    ])).alias("_r")).select("_r.check_name", "_r.n_failures")


def accepted_values(df: DataFrame, id_col: str, column: str, values) -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values))).select(
        id_col, F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value")
    )


def accepted_range(df: DataFrame, id_col: str, column: str, min_value=None, max_value=None) -> DataFrame:
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < F.lit(min_value))
    if max_value is not None:
        bad = bad | (c > F.lit(max_value))
    return df.filter(c.isNotNull() & bad).select(
        id_col, F.lit(column).alias("column_name"), c.cast("double").alias("value")
    )


def between(df: DataFrame, id_col: str, column: str, lo, hi) -> DataFrame:
    """Values outside the inclusive range [lo, hi]."""
    return accepted_range(df, id_col, column, lo, hi)


def conditional(df: DataFrame, where: Column, check) -> DataFrame:
    """Apply a check to the rows matching ``where`` only."""
    return check(df.filter(where))


def row_rule(df: DataFrame, id_col: str, rule: Column, name: str) -> DataFrame:
    """Rows where a cross-column rule does not hold (null counts as failing)."""
    return df.filter(~F.coalesce(rule, F.lit(False))).select(id_col, F.lit(name).alias("rule"))


def key_preservation(source: DataFrame, output: DataFrame, key: str) -> DataFrame:
    """Keys lost or invented by a transformation (two anti joins)."""
    lost = source.select(key).join(output.select(key), key, "left_anti").select(key, F.lit("missing_in_output").alias("issue"))
    extra = output.select(key).join(source.select(key), key, "left_anti").select(key, F.lit("not_in_source").alias("issue"))
    return lost.unionByName(extra)


def required_columns(df: DataFrame, columns) -> list[str]:
    """Columns missing from a DataFrame's schema (plan-time, reads no data)."""
    have = set(df.columns)
    return [c for c in columns if c not in have]


def summarize(checks: list[Check]) -> DataFrame:
    """One row per check: failures, severity, pass/fail.  Each count is its
    own aggregate; the union has one row per check."""
    parts = []
    for ch in checks:
        parts.append(ch.violations.agg(F.count(F.lit(1)).alias("n_failures")).select(
            F.lit(ch.name).alias("check_name"), "n_failures", F.lit(ch.severity).alias("severity"),
        ))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("n_failures") == 0, "pass").otherwise("fail"))


def store_failures(checks: list[Check], base_path: str) -> DataFrame:
    """Write each check's violating rows to ``base_path/<check name>``
    (overwrite: a rerun replaces the previous failures) and return the
    summary read back from the stored tables."""
    spark = checks[0].violations.sparkSession
    stored = []
    for ch in checks:
        path = f"{base_path.rstrip('/')}/{ch.name}"
        ch.violations.write.mode("overwrite").parquet(path)
        stored.append(Check(ch.name, spark.read.parquet(path), ch.severity))
    return summarize(stored)


def enforce(summary: DataFrame) -> None:
    """Raise when an error-severity check failed (warn-level checks only report)."""
    bad = summary.filter((F.col("severity") == "error") & (F.col("n_failures") > 0)).select("check_name").collect()
    if bad:
        raise AssertionError("data quality failures: " + ", ".join(r["check_name"] for r in bad))
