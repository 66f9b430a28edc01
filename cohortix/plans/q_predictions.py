"""Catalog: prediction-log cache, two-sink upload, freshness and health."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.operators import predictions as P
from cohortix.params import AS_OF, RUN_AT
from cohortix.plans import sqlfrag as Q
from cohortix.plans.registry import query
from cohortix.sources import fixtures as fx

MONITOR_AT = "2024-02-01 03:00:00"


def _live(spark, sf_dir):
    return P.latest_per_key_ttl(fx.cached_records(spark, sf_dir), AS_OF)


def _pending(spark, sf_dir):
    return P.pending(_live(spark, sf_dir), fx.upload_marks(spark, sf_dir))


BASE = "WITH " + Q.SRC_CACHED.strip() + f""",
latest AS (SELECT record_key, arg_max(payload, (written_at, seq)) AS payload, max(written_at) AS written_at,
                  arg_max(seq, (written_at, seq)) AS seq, count(*) AS n_writes
           FROM src_cached GROUP BY record_key),
live AS (SELECT * FROM latest WHERE written_at > {Q.ts(AS_OF)} - INTERVAL 7 DAY AND written_at <= {Q.ts(AS_OF)}),
pend AS (SELECT * FROM live WHERE record_key NOT IN (SELECT record_key FROM src_marks)),
preds AS (SELECT record_key, written_at, payload, {Q.ts(RUN_AT)} AS _ingestion_timestamp
          FROM pend WHERE starts_with(record_key, 'pred:')),
txs AS (SELECT written_at AS _timestamp, payload AS json_body, {Q.ts(RUN_AT)} AS _ingestion_timestamp
        FROM pend WHERE starts_with(record_key, 'tx:'))"""


@query("latest_per_key_ttl", BASE + "\nSELECT * FROM live")
def latest_per_key_ttl(spark, sf_dir):
    return _live(spark, sf_dir)


@query("key_lookup", BASE + """,
keys AS (SELECT DISTINCT 'pred:' || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS record_key
         FROM events WHERE event_type = 'purchase')
SELECT k.record_key, l.payload, l.written_at, l.payload IS NOT NULL AS found
FROM keys k LEFT JOIN live l ON k.record_key = l.record_key""")
def key_lookup(spark, sf_dir):
    ev = fx.load(spark, sf_dir, "events")
    keys = ev.filter(F.col("event_type") == "purchase").select(
        F.concat(F.lit("pred:"), F.col("user_id").cast("string"), F.lit("_"), F.date_format("ts", "yyyyMMdd"))
        .alias("record_key")
    ).distinct()
    return P.key_lookup(_live(spark, sf_dir), keys)


@query("pending_after_upload", BASE + "\nSELECT * FROM pend")
def pending_after_upload(spark, sf_dir):
    return _pending(spark, sf_dir)


@query("route_predictions", BASE + "\nSELECT * FROM preds")
def route_predictions(spark, sf_dir):
    return P.route_predictions(_pending(spark, sf_dir), RUN_AT)


@query("route_transactions", BASE + "\nSELECT * FROM txs")
def route_transactions(spark, sf_dir):
    return P.route_transactions(_pending(spark, sf_dir), RUN_AT)


@query("cache_stats", BASE + """
SELECT split_part(record_key, ':', 1) AS prefix, count(*) AS live_keys,
       count_if(record_key NOT IN (SELECT record_key FROM src_marks)) AS queue_length
FROM live GROUP BY 1""")
def cache_stats(spark, sf_dir):
    return P.cache_stats(_live(spark, sf_dir), fx.upload_marks(spark, sf_dir))


@query("upload_summary", BASE + f"""
SELECT {Q.ts(RUN_AT)} AS start_time,
       count_if(split_part(record_key, ':', 1) = 'pred') AS predictions_uploaded,
       count_if(split_part(record_key, ':', 1) = 'tx') AS transactions_uploaded,
       TRUE AS predictions_success, TRUE AS transactions_success, 0 AS errors
FROM pend""")
def upload_summary(spark, sf_dir):
    return P.upload_summary(_pending(spark, sf_dir), RUN_AT)


def _freshness(spark, sf_dir):
    pend = _pending(spark, sf_dir)
    return P.upload_freshness(
        {"prediction_logs": P.route_predictions(pend, RUN_AT), "transactions_json": P.route_transactions(pend, RUN_AT)},
        MONITOR_AT,
    )


FRESH = BASE + f""",
fr AS (
  SELECT 'prediction_logs' AS table_name, count(*) AS uploads_in_window, min(_ingestion_timestamp) AS earliest_upload,
         max(_ingestion_timestamp) AS latest_upload
  FROM preds WHERE _ingestion_timestamp >= {Q.ts(MONITOR_AT)} - INTERVAL 24 HOUR
  UNION ALL
  SELECT 'transactions_json', count(*), min(_ingestion_timestamp), max(_ingestion_timestamp)
  FROM txs WHERE _ingestion_timestamp >= {Q.ts(MONITOR_AT)} - INTERVAL 24 HOUR),
fr2 AS (SELECT *, CASE WHEN uploads_in_window = 0 THEN 'no uploads in window'
                       WHEN latest_upload < {Q.ts(MONITOR_AT)} - INTERVAL 2 HOUR THEN 'uploads may be stale' END AS alert
        FROM fr),
fresh AS (SELECT *, CASE WHEN alert IS NULL THEN 'healthy' ELSE 'warning' END AS status FROM fr2)"""


@query("upload_freshness", FRESH + "\nSELECT * FROM fresh")
def upload_freshness(spark, sf_dir):
    return _freshness(spark, sf_dir)


@query("health_status", FRESH + """,
svc AS (SELECT 'uploads' AS service,
               CASE WHEN max(CASE WHEN status = 'warning' THEN 1 ELSE 0 END) = 1 THEN 'warning' ELSE 'healthy' END AS status
        FROM fresh
        UNION ALL
        SELECT 'queue', CASE WHEN (SELECT count(*) FROM pend) > 10000 THEN 'warning' ELSE 'healthy' END)
SELECT CASE max(CASE WHEN status IN ('error', 'down') THEN 2 WHEN status = 'warning' THEN 1 ELSE 0 END)
         WHEN 2 THEN 'critical' WHEN 1 THEN 'warning' ELSE 'healthy' END AS overall_status,
       count(*) AS n_services
FROM svc""")
def health_status(spark, sf_dir):
    queue = P.cache_stats(_live(spark, sf_dir), fx.upload_marks(spark, sf_dir))
    return P.health_status(P.service_statuses(_freshness(spark, sf_dir), queue))
