"""Catalog: whole ingestion and upload runs, each with a failure and its repair."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from cohortix.operators import predictions as P
from cohortix.operators import upload_run as U
from cohortix.plans import q_predictions as QP
from cohortix.plans import sqlfrag as Q
from cohortix.plans.registry import query
from cohortix.sources import fixtures as fx
from cohortix.sources import ingest as I
from cohortix.sources import load_run as L
from cohortix.sources.tables import load

FIRST_RUN, SECOND_RUN = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def _landed(events, broken_day=None, withheld_day=None):
    """Landed records; a cut copy of each signup record has no time, on
    ``broken_day`` the records of error events arrive without their amount, and on
    ``withheld_day`` those of view events do not arrive."""
    record = fx.txn_json(events)
    cut = F.when(F.col("event_type") == "signup", F.substring(record, 1, 40))
    if broken_day is not None:
        broken = (F.to_date("ts") == F.lit(broken_day)) & (F.col("event_type") == "error")
        record = F.when(broken, F.replace(record, F.lit('"amount":'), F.lit('"total":'))).otherwise(record)
    if withheld_day is not None:
        events = events.filter(~((F.to_date("ts") == F.lit(withheld_day)) & (F.col("event_type") == "view")))
    return events.select(F.explode(F.array_compact(F.array(record, cut))).alias("value"))


def _two_runs(spark, sf_dir):
    """Two runs over the days of the table.

    The first is asked for all days but the last; of the first day the view
    events have not landed yet, the second day cannot be written, the last but
    one has broken records.  The second run lands everything and is asked for
    all days: late records of finished days, days taken again, and the rest,
    which it leaves alone."""
    events = load(spark, sf_dir, "events")
    days = events.agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last")).first()
    first, last = days["first"], days["last"]
    day = timedelta(days=1)
    paths = L.LoadPaths.below(I.scratch_path(spark, "ingestion-run"))

    def unwritable(rows):
        checked = F.when(F.to_date("_timestamp") == F.lit(first + day), F.raise_error(F.lit("disk full"))).otherwise(F.col("json_body"))
        return rows.withColumn("json_body", checked)

    L.run_load(_landed(events, last - day, first), paths, I.load_request(str(first), str(max(first, last - day))), FIRST_RUN, unwritable)
    L.run_load(_landed(events), paths, I.load_request(str(first), str(last)), SECOND_RUN)
    return paths


TWO_RUNS = """
WITH span AS (SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM events),
ev AS (SELECT CAST(ts AS DATE) AS d, event_type, first, last FROM events, span),
per_day AS (SELECT d, first, last, count(*) AS n, count_if(event_type = 'error') AS errors,
                   count_if(event_type = 'view' AND d = first) AS withheld
            FROM ev GROUP BY ALL),
judged AS (SELECT *, CASE WHEN d > greatest(first, last - 1) THEN 'outside'
                          WHEN d = last - 1 AND errors > 0 THEN 'broken'
                          WHEN d = first + 1 THEN 'unwritable'
                          WHEN n = withheld THEN 'unseen' ELSE 'loaded' END AS fate
           FROM per_day)"""


@query("ingestion_run", TWO_RUNS + """
SELECT d AS ledger_date, CAST(CASE WHEN fate IN ('broken', 'unwritable') OR withheld > 0 AND fate = 'loaded' THEN 2 ELSE 1 END AS BIGINT) AS attempts,
       CASE WHEN fate IN ('broken', 'unwritable') THEN 'failed' ELSE 'completed' END AS first_status,
       CASE fate WHEN 'broken' THEN errors || ' records lack required fields' WHEN 'unwritable' THEN 'write failed' END AS first_error,
       'completed' AS status, n AS n_records, CASE WHEN fate = 'loaded' THEN withheld ELSE 0 END AS n_late, n AS loaded_rows
FROM judged""")
def ingestion_run(spark, sf_dir):
    """The ledger after both runs, beside what the table holds."""
    paths = _two_runs(spark, sf_dir)
    history = L.read_ledger(spark, paths.ledger).groupBy("ledger_date").agg(
        F.count(F.lit(1)).alias("attempts"), F.min_by("status", "updated_at").alias("first_status"),
        F.split(F.min_by("error", "updated_at"), ":")[0].alias("first_error"),
        F.max_by("status", "updated_at").alias("status"), F.max_by("n_records", "updated_at").alias("n_records"),
        F.max_by("n_late", "updated_at").alias("n_late"),
    )
    table = spark.read.parquet(paths.table).groupBy(F.col("d").alias("ledger_date")).agg(F.count(F.lit(1)).alias("loaded_rows"))
    return history.join(table, "ledger_date", "left")


@query("ingestion_outcomes", TWO_RUNS + f""",
said AS (
  SELECT {Q.ts(FIRST_RUN)} AS run_at, CASE fate WHEN 'loaded' THEN 'loaded' WHEN 'outside' THEN 'outside' ELSE 'held' END AS outcome, n - withheld AS n FROM judged
  UNION ALL SELECT {Q.ts(FIRST_RUN)}, 'no_time', 1 FROM ev WHERE event_type = 'signup'
  UNION ALL SELECT {Q.ts(SECOND_RUN)}, CASE WHEN fate = 'loaded' THEN 'repeated' ELSE 'loaded' END, CASE WHEN fate = 'loaded' THEN n - withheld ELSE n END FROM judged
  UNION ALL SELECT {Q.ts(SECOND_RUN)}, 'late', withheld FROM judged WHERE fate = 'loaded'
  UNION ALL SELECT {Q.ts(SECOND_RUN)}, 'no_time', 1 FROM ev WHERE event_type = 'signup')
SELECT run_at, outcome, CAST(sum(n) AS BIGINT) AS n_records,
       CASE WHEN outcome IN ('outside', 'no_time') THEN CAST(sum(n) AS BIGINT) ELSE 0 END AS in_reject_sink
FROM said GROUP BY 1, 2 HAVING sum(n) > 0""")
def ingestion_outcomes(spark, sf_dir):
    """What became of every landed record, and how many are in the reject sink."""
    paths = _two_runs(spark, sf_dir)
    reason = F.create_map(*[F.lit(x) for outcome, text in L.REASONS.items() for x in (text, outcome)])
    sunk = spark.read.parquet(paths.rejects).groupBy(F.col("run").cast("string").alias("run"), reason[F.col("reason")].alias("outcome")).agg(F.count(F.lit(1)).alias("in_reject_sink"))
    said = L.read_outcomes(spark, paths.outcomes).withColumn("run", F.date_format("run_at", "yyyyMMddHHmmss"))
    return said.join(sunk, ["run", "outcome"], "left").select("run_at", "outcome", "n_records", F.coalesce("in_reject_sink", F.lit(0)).cast("long").alias("in_reject_sink"))


def _upload_runs(spark, sf_dir):
    """A run whose transaction sink refuses error records, then one that takes
    what is left.  Returns the summaries, and the pending keys after each run."""
    home = I.scratch_path(spark, "upload-run")
    marks, runs = f"{home}/marks", f"{home}/runs"
    strict = F.get_json_object("payload", "$.kind") != "error"
    earlier = fx.upload_marks(spark, sf_dir)
    live = QP._live(spark, sf_dir)
    out = []
    for run_at, contract in ((FIRST_RUN, strict), (SECOND_RUN, None)):
        sinks = {
            "prediction_logs": U.Sink(P.PRED_PREFIX, P.route_predictions, f"{home}/prediction_logs"),
            "transactions_json": U.Sink(P.TX_PREFIX, P.route_transactions, f"{home}/transactions_json", contract),
        }
        pending = P.pending(P.pending(live, earlier), U.read_marks(spark, marks))
        U.run_upload(pending, sinks, marks, runs, run_at)
    left = P.pending(P.pending(live, earlier), U.read_marks(spark, marks)).count()
    return spark.read.schema(U.RUNS_SCHEMA).parquet(runs), left


RUNS = QP.BASE + f""",
sizes AS (SELECT 'prediction_logs' AS sink, count(*) AS n, FALSE AS refused FROM pend WHERE starts_with(record_key, 'pred:')
          UNION ALL
          SELECT 'transactions_json', count(*), count_if(json_extract_string(payload, '$.kind') = 'error') > 0
          FROM pend WHERE starts_with(record_key, 'tx:')),
runs AS (SELECT {Q.ts(FIRST_RUN)} AS run_at, sink, n AS pending_rows, CASE WHEN refused THEN 0 ELSE n END AS rows_uploaded,
                NOT refused AS success FROM sizes
         UNION ALL
         SELECT {Q.ts(SECOND_RUN)}, sink, CASE WHEN refused THEN n ELSE 0 END, CASE WHEN refused THEN n ELSE 0 END, TRUE FROM sizes)"""


@query("upload_run", RUNS + "\nSELECT *, CAST(0 AS BIGINT) AS left_pending FROM runs")
def upload_run(spark, sf_dir):
    summary, left = _upload_runs(spark, sf_dir)
    return summary.drop("error").withColumn("left_pending", F.lit(left).cast("bigint"))


@query("upload_run_health", RUNS + f"""
SELECT run_at, CASE WHEN count_if(NOT success) > 0 THEN 'critical' ELSE 'healthy' END AS overall_status,
       count(*) AS n_services
FROM runs GROUP BY run_at""")
def upload_run_health(spark, sf_dir):
    summary, _ = _upload_runs(spark, sf_dir)
    parts = [
        P.health_status(U.sink_services(summary.filter(F.col("run_at") == P.ts_lit(run_at)))).select(P.ts_lit(run_at).alias("run_at"), "*")
        for run_at in (FIRST_RUN, SECOND_RUN)
    ]
    return parts[0].unionByName(parts[1])
