"""Catalog: streaming twins, each run with availableNow over data landed from
the supplied tables, dealt out by hash over many files and taken in several
micro-batches; the result is read back from the streaming sink."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from cohortix.params import RUN_AT
from cohortix.plans import sqlfrag as Q
from cohortix.plans.registry import query
from cohortix.sources import fixtures as fx
from cohortix.sources.ingest import scratch_path
from cohortix.sources.tables import SCHEMAS
from cohortix.streaming import twins as T

#: files that one micro-batch takes
BATCH_FILES = 3


def _land_lines(spark, sf_dir):
    landing = scratch_path(spark, "landing")
    fx.landed_records(spark, sf_dir).repartition("value").write.text(landing)
    return landing


def _land_log(spark, sf_dir):
    log = scratch_path(spark, "writelog")
    fx.cached_records(spark, sf_dir).repartition(F.hash("seq", "payload")).write.parquet(log)
    return log


@query("stream_ingest", "WITH " + Q.src_raw_txn(RUN_AT).strip() + "\nSELECT *, CAST(_timestamp AS DATE) AS d FROM src_raw")
def stream_ingest(spark, sf_dir):
    landing = _land_lines(spark, sf_dir)
    base = scratch_path(spark, "stream-ingest")
    out, ckpt = os.path.join(base, "out"), os.path.join(base, "_checkpoint")
    bad = spark.createDataFrame([('{"id": 1}',), ("not json",)], "value string")
    bad.write.mode("append").text(landing)
    rejects = os.path.join(base, "rejects")
    T.stream_ingest(spark, landing, out, ckpt, RUN_AT, rejects, BATCH_FILES)
    if spark.read.parquet(rejects).count() != 2:
        raise ValueError("each unusable line must be among the rejects")
    return spark.read.parquet(out).drop("_batch")


@query("stream_route", "WITH " + Q.SRC_CACHED.strip() + f"""
SELECT 'predictions' AS sink, record_key, written_at AS _timestamp, payload, {Q.ts(RUN_AT)} AS _ingestion_timestamp
FROM src_cached WHERE starts_with(record_key, 'pred:')
UNION ALL
SELECT 'transactions', NULL, written_at, payload, {Q.ts(RUN_AT)} FROM src_cached WHERE starts_with(record_key, 'tx:')""")
def stream_route(spark, sf_dir):
    log = _land_log(spark, sf_dir)
    base = scratch_path(spark, "stream-route")
    preds, txs = os.path.join(base, "preds"), os.path.join(base, "txs")
    T.stream_route(spark, log, preds, txs, os.path.join(base, "_checkpoint"), RUN_AT, BATCH_FILES)
    p = spark.read.parquet(preds).select(
        F.lit("predictions").alias("sink"), "record_key", F.col("written_at").alias("_timestamp"), "payload",
        "_ingestion_timestamp")
    t = spark.read.parquet(txs).select(
        F.lit("transactions").alias("sink"), F.lit(None).cast("string").alias("record_key"), "_timestamp",
        F.col("json_body").alias("payload"), "_ingestion_timestamp")
    return p.unionByName(t)


#: days between newest event and bound, and days of events in a landing
HORIZON, LANDING_DAYS, LATE_BOUND = 7, 8, 3

#: rows land in groups of days; those of signups two groups later, of errors one
LANDED_SQL = f"""arrivals AS (
  SELECT *, CAST(floor((CAST(ts AS DATE) - (SELECT CAST(min(ts) AS DATE) FROM events)) / {LANDING_DAYS}) AS BIGINT)
            + CASE event_type WHEN 'signup' THEN 2 WHEN 'error' THEN 1 ELSE 0 END AS landing FROM events),
clocks AS (SELECT landing, max(max(ts)) OVER (ORDER BY landing ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock,
                  max(max(ts)) OVER (ORDER BY landing ROWS UNBOUNDED PRECEDING) AS newest
           FROM arrivals GROUP BY landing)"""


def _landings(spark, sf_dir, rows, ts="ts", kind="event_type"):
    """Landings of ``rows``, in the order they arrive, as a list of DataFrames;
    their number follows the days of the table."""
    first = rows.agg(F.min(F.to_date(ts)).alias("d")).first()["d"]
    delay = F.when(F.col(kind) == "signup", 2).when(F.col(kind) == "error", 1).otherwise(0)
    landing = (F.floor(F.datediff(F.to_date(ts), F.lit(first)) / F.lit(LANDING_DAYS)) + delay).alias("landing")
    path = scratch_path(spark, "landings")
    rows.select("*", landing).write.partitionBy("landing").parquet(path)
    stored = spark.read.parquet(path)
    numbers = sorted(r["landing"] for r in stored.select("landing").distinct().collect())
    return [stored.filter(F.col("landing") == n).drop("landing") for n in numbers]


def _log_landings(spark, sf_dir):
    kind = F.get_json_object("payload", "$.kind")
    rows = fx.cached_records(spark, sf_dir).withColumn("kind", kind)
    return [df.drop("kind") for df in _landings(spark, sf_dir, rows, "written_at", "kind")]


@query("stream_dedupe", "WITH " + Q.SRC_CACHED.strip() + f""",
{LANDED_SQL},
judged AS (SELECT c.record_key, coalesce(a.ts < k.clock - INTERVAL {HORIZON} DAY, FALSE) AS late
           FROM arrivals a JOIN clocks k USING (landing) JOIN src_cached c ON c.seq = a.event_id)
SELECT record_key, count_if(NOT late) > 0 AS kept, count_if(late) AS late_rows FROM judged GROUP BY record_key""")
def stream_dedupe(spark, sf_dir):
    """Every key, whether it was kept (once), and its rows beyond the horizon.  The
    writes of a key lie within a day, so none comes back after its horizon."""
    base = scratch_path(spark, "stream-dedupe")
    log, out, ckpt = (os.path.join(base, x) for x in ("log", "out", "_checkpoint"))
    for landed in _log_landings(spark, sf_dir):
        landed.write.mode("append").parquet(log)
        T.stream_dedupe(spark, log, out, ckpt, HORIZON)
    kept = spark.read.schema(T.LOG_SCHEMA).parquet(out).groupBy("record_key").agg(F.count(F.lit(1)).alias("n"))
    late = spark.read.parquet(os.path.join(base, "late")).groupBy("record_key").agg(F.count(F.lit(1)).alias("late_rows"))
    both = kept.join(late, "record_key", "full")
    return both.select("record_key", F.coalesce(F.col("n") == 1, F.lit(False)).alias("kept"), F.coalesce("late_rows", F.lit(0)).cast("long").alias("late_rows"))


@query("stream_latest", "WITH " + Q.SRC_CACHED.strip() + """
SELECT record_key, arg_max(payload, (written_at, seq)) AS payload, max(written_at) AS written_at,
       arg_max(seq, (written_at, seq)) AS seq, count(*) AS n_writes
FROM src_cached GROUP BY record_key""")
def stream_latest(spark, sf_dir):
    log = _land_log(spark, sf_dir)
    base = scratch_path(spark, "stream-latest")
    out = os.path.join(base, "out")
    T.stream_latest(spark, log, out, os.path.join(base, "_checkpoint"), BATCH_FILES, compact_every=2)
    return T.read_latest(spark, out)


@query("stream_daily_counts", f"""
WITH {LANDED_SQL}
SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       count_if(NOT coalesce(ts < clock - INTERVAL {LATE_BOUND} DAY, FALSE)) AS record_count,
       count_if(coalesce(ts < clock - INTERVAL {LATE_BOUND} DAY, FALSE)) AS late_count,
       date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL {LATE_BOUND} DAY AS closed
FROM arrivals JOIN clocks USING (landing) GROUP BY 1, 2, 5""")
def stream_daily_counts(spark, sf_dir):
    base = scratch_path(spark, "stream-daily")
    landing, out, ckpt = (os.path.join(base, x) for x in ("landing", "out", "_checkpoint"))
    bound = f"{LATE_BOUND} DAYS"
    for landed in _landings(spark, sf_dir, fx.load(spark, sf_dir, "events")):
        landed.write.mode("append").parquet(landing)
        T.stream_daily_counts(spark, landing, out, ckpt, SCHEMAS["events"], bound)
    return T.read_window_counts(spark, out, bound)
