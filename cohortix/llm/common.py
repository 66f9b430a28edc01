"""Helpers shared by the corpus operators: tables in the shared folder,
running sums over globally sorted rows, let-bindings for SQL lambdas."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortix.session import checkpoint_dir

#: the six ASCII white-space characters that separate words
SPACE = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _shuffles_dropped_after_use(spark: SparkSession):
    """While a table is written, the shuffle files behind it go as soon as the
    write has committed; the caller's setting is put back."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder named by ``spark.checkpoint.dir``.

    Cuts the lineage: what follows survives lost executors without a rerun of
    what came before, and sees fixed rows.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:16]}"
    with _shuffles_dropped_after_use(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column used inside a higher-order function may be inlined and computed
    for every element; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def running(df: DataFrame, order: list[str], sums: list[str], name: str) -> DataFrame:
    """Adds ``before_<c>`` for every column ``c`` of ``sums``: its total over all
    rows that sort before this one by ``order`` (which must order the rows fully
    for the result to be unique).

    Rows are range-partitioned by ``order`` and stored with the number of their
    range; each range adds its own running sum to the total of earlier ranges
    (one row per range).  No task sees more than one range.
    """
    ranged = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), name)
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranged.groupBy("_range").agg(*[F.sum(c).alias(f"_all_{c}") for c in sums])
    ranges = ranges.select("_range", *[F.coalesce(F.sum(f"_all_{c}").over(earlier), F.lit(0)).alias(f"_off_{c}") for c in sums])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(ranges, "_range")
    for c in sums:
        out = out.withColumn(f"before_{c}", F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_off_{c}"))
    return out.drop("_range", *[f"_off_{c}" for c in sums])
