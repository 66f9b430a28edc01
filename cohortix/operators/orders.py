"""Order staging, baseline+overlay union and the order-level analysis mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.functions.dates import calendar_days, elapsed_days, in_window, ts_lit
from cohortix.params import ExperimentConfig, ExperimentWindow

STG_COLUMNS = ("order_id", "user_id", "experiment_name", "variant", "status", "gender", "num_of_item",
               "created_at", "shipped_at", "delivered_at", "data_source", "_loaded_at")


def _loaded_at(run_at: str | None) -> F.Column:
    return (ts_lit(run_at) if run_at else F.localtimestamp()).alias("_loaded_at")


def stg_baseline_orders(orders: DataFrame, run_at: str | None = None) -> DataFrame:
    """Conform baseline orders: typed null experiment columns, lineage, audit."""
    return orders.select(
        "order_id", "user_id",
        F.lit(None).cast("string").alias("experiment_name"),
        F.lit(None).cast("string").alias("variant"),
        "status", "gender", "num_of_item", "created_at", "shipped_at", "delivered_at",
        F.lit("thelook_baseline").alias("data_source"),
        _loaded_at(run_at),
    )


def stg_overlay_orders(overlay: DataFrame, run_at: str | None = None) -> DataFrame:
    """Conform overlay orders (timestamps re-typed from their stored form)."""
    return overlay.select(
        "order_id", "user_id", "experiment_name", "variant", "status", "gender", "num_of_item",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
        F.col("shipped_at").cast("timestamp_ntz").alias("shipped_at"),
        F.col("delivered_at").cast("timestamp_ntz").alias("delivered_at"),
        F.lit("synthetic_overlay").alias("data_source"),
        _loaded_at(run_at),
    )


def orders_union_all(baseline: DataFrame, overlay: DataFrame) -> DataFrame:
    return baseline.select(*STG_COLUMNS).unionByName(overlay.select(*STG_COLUMNS))


def participation(assignments: DataFrame, experiment_name: str) -> DataFrame:
    return assignments.filter(F.col("experiment_name") == experiment_name).select(
        F.col("object_identifier").cast("bigint").alias("user_id"),
        F.col("experiment_name").alias("a_experiment_name"),
        F.col("variant").alias("control_treatment"),
        "variant_description",
    )


def int_orders_union(stg_baseline: DataFrame, stg_overlay: DataFrame, assignments: DataFrame,
                     cfg: ExperimentConfig) -> DataFrame:
    """Baseline in [baseline_start, experiment_end] + overlay, left-joined to
    the experiment's assignments (one row per user, checked by dq_unique)."""
    w = cfg.window
    base = stg_baseline.filter(in_window("created_at", w.baseline_start, w.experiment_end, w.inclusive_days))
    unioned = orders_union_all(base, stg_overlay)
    a = participation(assignments, cfg.name).drop("a_experiment_name")
    return unioned.join(a, "user_id", "left").select(
        *STG_COLUMNS, "control_treatment", "variant_description",
        F.when(F.col("control_treatment").isNotNull(), "experiment_participant")
        .otherwise("non_participant").alias("experiment_status"),
    )


def time_period(col: F.Column, w: ExperimentWindow) -> F.Column:
    return (
        F.when(in_window(col, w.experiment_start, w.experiment_end, w.inclusive_days), "experiment_period")
        .when(in_window(col, w.baseline_start, w.baseline_end, w.inclusive_days), "baseline_period")
        .otherwise("other")
    )


def order_flags(df: DataFrame) -> DataFrame:
    return df.select(
        "order_id",
        F.when(F.col("status") == "Complete", 1).otherwise(0).alias("is_completed"),
        F.when(F.col("status") == "Cancelled", 1).otherwise(0).alias("is_cancelled"),
        F.lit(0).alias("is_returned"),
    )


def experiment_mart(union: DataFrame, cfg: ExperimentConfig, run_at: str | None = None,
                    day_count: str = "calendar") -> DataFrame:
    """Order-level analysis mart.  ``day_count='calendar'`` counts date
    boundaries (the warehouse's date_diff on dates); ``'elapsed'`` counts whole
    24-hour periods between the timestamps."""
    w = cfg.window
    days = calendar_days if day_count == "calendar" else elapsed_days
    return union.filter(in_window("created_at", w.baseline_start, w.experiment_end, w.inclusive_days)).select(
        "order_id", "user_id", "data_source", "experiment_name", "variant", "control_treatment",
        "variant_description", "experiment_status",
        time_period(F.col("created_at"), w).alias("time_period"),
        "status", "gender", "num_of_item", "created_at", "shipped_at", "delivered_at",
        F.when(F.col("status") == "Complete", 1).otherwise(0).alias("is_completed"),
        F.when(F.col("status") == "Cancelled", 1).otherwise(0).alias("is_cancelled"),
        F.lit(0).alias("is_returned"),
        days(F.col("shipped_at"), F.col("created_at")).alias("days_to_ship"),
        days(F.col("delivered_at"), F.col("created_at")).alias("days_to_deliver"),
        (ts_lit(run_at) if run_at else F.localtimestamp()).alias("analysis_run_at"),
        "_loaded_at",
    )
