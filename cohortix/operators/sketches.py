"""Approximate distinct counts from sketches that can be stored and merged.

A sketch has a fixed size (``2 ** precision`` bytes), is combined map-side and
merges with others of its kind, so counts over any set of days come from the
stored sketches of the days, without reading their rows again.  Nulls are not
counted, as by count(DISTINCT); a group of nulls alone counts nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 1.6 % standard error
PRECISION = 12


def distinct_sketches(df: DataFrame, by: list, key: str | Column, precision: int = PRECISION) -> DataFrame:
    """One row per group: its rows and the sketch of its different keys."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(key, F.lit(precision)).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch").alias("sketch"))


def estimate(sketch: str | Column = "sketch") -> Column:
    """Estimated number of different keys."""
    return F.hll_sketch_estimate(sketch)


def relative_error(precision: int = PRECISION, deviations: float = 3.0) -> float:
    """Bound on the relative error of a merged sketch, in standard deviations."""
    return deviations * 1.04 / 2 ** (precision / 2)
