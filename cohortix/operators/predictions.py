"""Prediction-log cache re-expressed as tables: an append-only keyed write log,
a latest-per-key view with a time-to-live, routing to two sinks, pending /
uploaded bookkeeping, and the freshness / health report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.functions.dates import ts_lit
from cohortix.params import CACHE_TTL_DAYS, FRESHNESS_WINDOW_HOURS, QUEUE_ALERT_THRESHOLD, STALE_AFTER_HOURS

PRED_PREFIX = "pred:"
TX_PREFIX = "tx:"


def stamp_default_time(log: DataFrame, run_at: str) -> DataFrame:
    """A write without its own timestamp gets the write-time default."""
    return log.withColumn("written_at", F.coalesce(F.col("written_at"), ts_lit(run_at)))


def latest_per_key(log: DataFrame) -> DataFrame:
    """Last write wins per key; ties on time broken by the write sequence.
    Partial aggregation keeps a hot key from landing whole in one task."""
    order = F.struct("written_at", "seq")
    return log.groupBy("record_key").agg(
        F.max_by("payload", order).alias("payload"),
        F.max("written_at").alias("written_at"),
        F.max_by("seq", order).alias("seq"),
        F.count(F.lit(1)).alias("n_writes"),
    )


def latest_per_key_ttl(log: DataFrame, as_of: str, ttl_days: int = CACHE_TTL_DAYS,
                       run_at: str | None = None) -> DataFrame:
    """Keys still alive at ``as_of``: last write within the TTL.  Writes
    without a time take ``run_at`` (the write-time default) when given."""
    if run_at is not None:
        log = stamp_default_time(log, run_at)
    horizon = F.timestamp_add("DAY", F.lit(-ttl_days), ts_lit(as_of))
    return latest_per_key(log).filter((F.col("written_at") > horizon) & (F.col("written_at") <= ts_lit(as_of)))


def key_lookup(live: DataFrame, keys: DataFrame) -> DataFrame:
    """Batch lookup of a key list; missing or expired keys give found=False."""
    return keys.join(live.select("record_key", "payload", "written_at"), "record_key", "left").select(
        "record_key", "payload", "written_at", F.col("payload").isNotNull().alias("found")
    )


def pending(live: DataFrame, uploaded: DataFrame) -> DataFrame:
    """Live keys not yet uploaded (the upload queue)."""
    return live.join(uploaded.select("record_key"), "record_key", "left_anti")


def route(pending_rows: DataFrame, prefix: str, run_at: str) -> DataFrame:
    """Rows of one sink with the ingestion stamp."""
    return pending_rows.filter(F.col("record_key").startswith(prefix)).select(
        "record_key", "written_at", "payload", ts_lit(run_at).alias("_ingestion_timestamp")
    )


def route_predictions(pending_rows: DataFrame, run_at: str) -> DataFrame:
    return route(pending_rows, PRED_PREFIX, run_at)


def route_transactions(pending_rows: DataFrame, run_at: str) -> DataFrame:
    """Transactions go to the raw JSON table, so they are wrapped in the
    three-column envelope first."""
    return pending_rows.filter(F.col("record_key").startswith(TX_PREFIX)).select(
        F.col("written_at").alias("_timestamp"),
        F.col("payload").alias("json_body"),
        ts_lit(run_at).alias("_ingestion_timestamp"),
    )


def key_prefix(col: F.Column) -> F.Column:
    return F.substring_index(col, ":", 1)


def cache_stats(live: DataFrame, uploaded: DataFrame) -> DataFrame:
    """Live keys per prefix and the pending queue length per prefix."""
    marked = live.join(uploaded.select("record_key", F.lit(1).alias("_up")), "record_key", "left")
    return marked.groupBy(key_prefix(F.col("record_key")).alias("prefix")).agg(
        F.count(F.lit(1)).alias("live_keys"),
        F.count_if(F.col("_up").isNull()).alias("queue_length"),
    )


def upload_summary(pending_rows: DataFrame, run_at: str) -> DataFrame:
    """One row per daily run: rows routed to each sink, success flags."""
    p = key_prefix(F.col("record_key"))
    return pending_rows.agg(
        F.count_if(p == "pred").alias("predictions_uploaded"),
        F.count_if(p == "tx").alias("transactions_uploaded"),
    ).select(
        ts_lit(run_at).alias("start_time"),
        "predictions_uploaded", "transactions_uploaded",
        F.lit(True).alias("predictions_success"), F.lit(True).alias("transactions_success"),
        F.lit(0).alias("errors"),
    )


def upload_freshness(tables: dict[str, DataFrame], now: str,
                     window_hours: int = FRESHNESS_WINDOW_HOURS, stale_hours: int = STALE_AFTER_HOURS) -> DataFrame:
    """Per uploaded table: rows ingested in the last window, latest upload,
    alerts (none in the window; latest older than the stale bound)."""
    since = F.timestamp_add("HOUR", F.lit(-window_hours), ts_lit(now))
    stale = F.timestamp_add("HOUR", F.lit(-stale_hours), ts_lit(now))
    parts = []
    for name, df in tables.items():
        recent = df.filter(F.col("_ingestion_timestamp") >= since)
        parts.append(recent.agg(
            F.count(F.lit(1)).alias("uploads_in_window"),
            F.min("_ingestion_timestamp").alias("earliest_upload"),
            F.max("_ingestion_timestamp").alias("latest_upload"),
        ).select(F.lit(name).alias("table_name"), "*"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    alert = (
        F.when(F.col("uploads_in_window") == 0, "no uploads in window")
        .when(F.col("latest_upload") < stale, "uploads may be stale")
    )
    return out.withColumn("alert", alert).withColumn(
        "status", F.when(F.col("alert").isNull(), "healthy").otherwise("warning")
    )


def service_statuses(freshness: DataFrame, queue: DataFrame, threshold: int = QUEUE_ALERT_THRESHOLD) -> DataFrame:
    """(service, status) rows: uploads from freshness, queue from backlog."""
    uploads = freshness.agg(
        F.max(F.when(F.col("status") == "warning", 1).otherwise(0)).alias("w")
    ).select(F.lit("uploads").alias("service"), F.when(F.col("w") == 1, "warning").otherwise("healthy").alias("status"))
    q = queue.agg(F.sum("queue_length").alias("n")).select(
        F.lit("queue").alias("service"),
        F.when(F.coalesce(F.col("n"), F.lit(0)) > threshold, "warning").otherwise("healthy").alias("status"),
    )
    return uploads.unionByName(q)


def health_status(services: DataFrame) -> DataFrame:
    """Overall = worst service: error/down -> critical, warning, healthy."""
    sev = F.when(F.col("status").isin("error", "down"), 2).when(F.col("status") == "warning", 1).otherwise(0)
    agg = services.agg(F.max(sev).alias("worst"), F.count(F.lit(1)).alias("n_services"))
    return agg.select(
        F.when(F.col("worst") == 2, "critical").when(F.col("worst") == 1, "warning").otherwise("healthy")
        .alias("overall_status"),
        "n_services",
    )
