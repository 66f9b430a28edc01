"""Layered materialisation: raw -> staging -> intermediate -> marts.

Staging and intermediate layers are lazy views (lineage only); marts are
written tables.  Schema (database) names follow the source system's rule:
a model without a custom schema lands in the target schema, otherwise in
``<prefix>_<custom>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LAYER_MATERIALIZATION = {"staging": "view", "intermediate": "view", "marts": "table"}


def schema_name(custom: str | None, target: str = "default", prefix: str = "analytics") -> str:
    return target if custom is None else f"{prefix}_{custom.strip()}"


def materialize(spark: SparkSession, df: DataFrame, name: str, layer: str, location: str | None = None,
                materialized: str | None = None) -> DataFrame:
    """Register ``df`` as ``name`` in its layer.  Views stay lazy; tables are
    written (to ``location`` when given, else the session catalog) and read
    back, which also cuts the lineage for downstream layers."""
    kind = materialized or LAYER_MATERIALIZATION.get(layer, "view")
    if kind == "view":
        df.createOrReplaceTempView(name)
        return spark.table(name)
    if location:
        df.write.mode("overwrite").parquet(location)
        out = spark.read.parquet(location)
        out.createOrReplaceTempView(name)
        return out
    df.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)
