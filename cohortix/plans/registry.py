"""Key -> (DataFrame builder, oracle SQL) registry used by the catalog."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortix.session import apply_runtime_conf

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    """Register a catalog query; ``sql`` is its DuckDB oracle (None when the
    operator has no SQL equivalent and gets a rows-only check)."""

    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate catalog key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_runtime_conf(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return deco
