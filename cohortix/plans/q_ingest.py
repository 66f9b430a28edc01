"""Catalog: landing-zone ingestion, partitioned layout, ledger."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.operators import transactions as B
from cohortix.params import RUN_AT
from cohortix.plans import sqlfrag as Q
from cohortix.plans.q_transactions import STG
from cohortix.plans.registry import query
from cohortix.sources import fixtures as fx
from cohortix.sources import ingest as I

BATCH_DAYS = 3
SCAN_START, SCAN_END = "2024-01-05", "2024-01-12"

LANDED = "WITH landed AS (SELECT " + Q.txn_json_sql() + " AS value, event_type FROM events)"


@query("sse_parse", LANDED + """,
lines AS (SELECT unnest(['event: transaction',
                         'data: ' || CASE WHEN event_type = 'error' THEN substr(value, 1, 40) ELSE value END]) AS value
          FROM landed)
SELECT substr(trim(value), 7) AS record, json_valid(substr(trim(value), 7)) AS valid
FROM lines WHERE starts_with(trim(value), 'data: ')""")
def sse_parse(spark, sf_dir):
    return I.sse_records(fx.sse_lines(spark, sf_dir))


@query("raw_envelope", LANDED + f"""
SELECT CAST(json_extract_string(value, '$._timestamp') AS TIMESTAMP) AS _timestamp, value AS json_body,
       {Q.ts(RUN_AT)} AS _ingestion_timestamp FROM landed""")
def raw_envelope(spark, sf_dir):
    return I.raw_envelope(fx.landed_records(spark, sf_dir), RUN_AT)


@query("required_fields", LANDED + """
SELECT count(*) AS total_records,
       count_if(NOT coalesce(list_contains(json_keys(value), 'transaction_id'), FALSE)) AS missing_transaction_id,
       count_if(NOT coalesce(list_contains(json_keys(value), 'customer_id'), FALSE)) AS missing_customer_id,
       count_if(NOT coalesce(list_contains(json_keys(value), '_timestamp'), FALSE)) AS missing_timestamp,
       count_if(NOT coalesce(list_contains(json_keys(value), 'amount'), FALSE)) AS missing_amount,
       count_if(NOT coalesce(list_contains(json_keys(value), 'transaction_id'), FALSE)) = 0
         AND count_if(NOT coalesce(list_contains(json_keys(value), 'customer_id'), FALSE)) = 0
         AND count_if(NOT coalesce(list_contains(json_keys(value), '_timestamp'), FALSE)) = 0
         AND count_if(NOT coalesce(list_contains(json_keys(value), 'amount'), FALSE)) = 0 AS passed
FROM landed""")
def required_fields(spark, sf_dir):
    return I.required_fields(fx.landed_records(spark, sf_dir))


RAW = "WITH " + Q.src_raw_txn(RUN_AT).strip()


@query("ndjson_roundtrip", RAW + "\nSELECT * FROM src_raw")
def ndjson_roundtrip(spark, sf_dir):
    path = I.scratch_path(spark, "ndjson")
    raw = fx.raw_transactions(spark, sf_dir, RUN_AT)
    I.append_ndjson(raw, path)
    return I.read_ndjson(spark, path, I.ENVELOPE_SCHEMA)


@query("ndjson_evolution", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(floor(value) AS DOUBLE) ELSE CAST(value AS DOUBLE) END AS amount,
       CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS tag,
       CASE WHEN event_id % 2 = 1 THEN event_type END AS channel,
       CASE WHEN event_id % 2 = 1 THEN user_id % 7 END AS nested_step
FROM events""")
def ndjson_evolution(spark, sf_dir):
    """Two appends read back with an inferred schema: the second widens ``amount``
    from whole numbers to fractions, turns ``tag`` from a number into text, and
    brings ``channel`` and a nested field."""
    path = I.scratch_path(spark, "evolving")
    ev = fx.load(spark, sf_dir, "events")
    first = ev.filter("event_id % 2 = 0").select("event_id", F.floor("value").alias("amount"), F.col("user_id").alias("tag"))
    second = ev.filter("event_id % 2 = 1").select(
        "event_id", F.col("value").alias("amount"), F.col("event_type").alias("tag"), F.col("event_type").alias("channel"),
        F.struct((F.col("user_id") % 7).alias("step")).alias("nested"))
    I.append_ndjson(first, path)
    I.append_ndjson(second, path)
    back = I.read_ndjson(spark, path)
    return back.select("event_id", "amount", "tag", "channel", F.col("nested.step").alias("nested_step"))


@query("table_replace", RAW + "\nSELECT * FROM src_raw")
def table_replace(spark, sf_dir):
    """A table with other rows and another column is replaced as a whole."""
    path = I.scratch_path(spark, "replace")
    raw = fx.raw_transactions(spark, sf_dir, RUN_AT)
    I.replace_table(raw.withColumn("old", F.lit(1)).withColumn("json_body", F.lit("{}")), path)
    I.replace_table(raw, path)
    return spark.read.parquet(path)


@query("body_parse", LANDED.replace("event_type FROM", "event_type, event_id, user_id FROM") + """,
judged AS (SELECT value, user_id % 3 AS form, event_type = 'error' AS broken, event_id FROM landed),
kept AS (SELECT event_id, value FROM judged WHERE NOT broken)
SELECT json_extract_string(value, '$._timestamp') AS event_time, json_extract_string(value, '$.customer_id') AS customer_id,
       (SELECT count(*) FROM judged WHERE NOT broken) AS records, (SELECT count(*) FROM judged WHERE broken) AS bad
FROM kept""")
def body_parse(spark, sf_dir):
    """Landed bodies in the three forms, one a user and day: event streams, arrays,
    single objects over several lines; records of error events are cut short."""
    ev = fx.load(spark, sf_dir, "events")
    record = fx.txn_json(ev)
    rows = ev.select((F.col("user_id") % 3).alias("form"), "user_id", F.to_date("ts").alias("d"), "event_id",
                     F.when(F.col("event_type") == "error", F.substring(record, 1, 40)).otherwise(record).alias("r"),
                     (F.col("event_type") == "error").alias("broken"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "r"))), lambda x: F.concat(F.lit("event: transaction\ndata: "), x["r"])), "\n\n")
    streams = rows.filter("form = 0").groupBy("user_id", "d").agg(listed.alias("value")).select("value")
    inside = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "r"))), lambda x: x["r"]), ",\n  ")
    # a record that is cut short would spoil its array: it arrives as a body of its own
    arrays = rows.filter("form = 1 AND NOT broken").groupBy("user_id", "d").agg(F.concat(F.lit("[\n  "), inside, F.lit("\n]")).alias("value")).select("value")
    single = rows.filter("form = 2 OR form = 1 AND broken").select(F.concat(F.lit("  "), F.replace("r", F.lit(',"customer_id"'), F.lit(',\n  "customer_id"')), F.lit("\n")).alias("value"))
    records, seen = I.parse_body(streams.unionByName(arrays).unionByName(single))
    path = I.scratch_path(spark, "bodies")
    records.write.parquet(path)
    out = spark.read.parquet(path).select(
        F.get_json_object("record", "$._timestamp").alias("event_time"), F.get_json_object("record", "$.customer_id").alias("customer_id"))
    return out.withColumns({k: F.lit(seen.get[k]).cast("long") for k in ("records", "bad")})


def _written_stg(spark, sf_dir):
    path = I.scratch_path(spark, "bnpl")
    staged = B.stg_transactions(fx.raw_transactions(spark, sf_dir, RUN_AT), None, RUN_AT)
    whole = I.write_day_partitioned(staged, path)
    return staged, path, whole


@query("load_verification", RAW + """
SELECT CAST(_timestamp AS DATE) AS load_date, count(*) AS expected_rows, count(*) AS loaded_rows, TRUE AS verified
FROM src_raw GROUP BY 1""")
def load_verification(spark, sf_dir):
    _, path, wrote = _written_stg(spark, sf_dir)
    loaded = I.in_days(spark.read.parquet(path), wrote.days)
    return I.load_verification(fx.raw_transactions(spark, sf_dir, RUN_AT), loaded, "_timestamp")


@query("day_merge", RAW + """,
per_day AS (SELECT CAST(_timestamp AS DATE) AS d, count(*) AS n, count_if(json_extract_string(json_body, '$.status') = 'failed') AS keyless
            FROM src_raw GROUP BY 1),
week AS (SELECT d FROM per_day ORDER BY d DESC LIMIT 7)
SELECT d, n AS rows_after_first, n AS rows_after_rerun, keyless AS keyless_rows,
       (SELECT CAST(sum(n) AS BIGINT) FROM per_day WHERE d IN (SELECT d FROM week)) AS rows_of_rerun,
       (SELECT count(*) FROM week) AS days_of_rerun
FROM per_day""")
def day_merge(spark, sf_dir):
    """Rows per day after a load and after a rerun of its last seven days; the
    records of failed transactions have no key in either."""
    path = I.scratch_path(spark, "merge")
    raw = fx.raw_transactions(spark, sf_dir, RUN_AT)
    staged = raw.withColumn("record_id", F.when(F.get_json_object("json_body", "$.status") != "failed", F.md5("json_body")))
    last = raw.agg(F.max(F.to_date("_timestamp")).alias("d")).first()["d"]

    def load(rows):
        return I.write_day_partitioned(rows, path, ts_column="_timestamp", cluster=(), key="record_id")

    def per_day(name):
        return spark.read.parquet(path).groupBy("d").agg(F.count(F.lit(1)).alias(name), F.count_if(F.col("record_id").isNull()).alias("keyless_rows"))

    if last is None:
        return spark.createDataFrame([], "d date, rows_after_first long, rows_after_rerun long, keyless_rows long, rows_of_rerun long, days_of_rerun long")
    load(staged)
    first = per_day("rows_after_first").drop("keyless_rows")
    kept = I.scratch_path(spark, "merge-first")
    first.write.parquet(kept)
    days = [r["d"] for r in first.select("d").orderBy(F.desc("d")).limit(7).collect()]
    again = load(staged.filter(F.to_date("_timestamp").isin(days)).withColumn("_ingestion_timestamp", F.col("_ingestion_timestamp") + F.expr("INTERVAL 1 DAY")))
    out = spark.read.parquet(kept).join(per_day("rows_after_rerun"), "d", "full")
    return out.withColumns({"rows_of_rerun": F.lit(again.rows).cast("long"), "days_of_rerun": F.lit(len(again.days)).cast("long")})


@query("partitioned_scan", STG + f"""
SELECT *, CAST(transaction_timestamp AS DATE) AS d FROM stg
WHERE CAST(transaction_timestamp AS DATE) BETWEEN DATE '{SCAN_START}' AND DATE '{SCAN_END}'""")
def partitioned_scan(spark, sf_dir):
    _, path, _ = _written_stg(spark, sf_dir)
    return I.read_partitioned(spark, path, SCAN_START, SCAN_END)


LEDGER = "WITH " + Q.SRC_LEDGER.strip() + """,
latest AS (SELECT ledger_date, arg_max(status, (updated_at, status)) AS status,
                  arg_max(n_records, (updated_at, status)) AS n_records, max(updated_at) AS updated_at
           FROM src_ledger GROUP BY ledger_date),
cal AS (SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS ledger_date
        FROM (SELECT CAST(min(ts) AS DATE) AS first, CAST(max(ts) AS DATE) AS last FROM events)),
remaining AS (SELECT ledger_date FROM cal WHERE ledger_date NOT IN
              (SELECT ledger_date FROM latest WHERE status = 'completed'))"""


def _days(spark, sf_dir):
    return I.calendar_of(fx.load(spark, sf_dir, "events"), "ts")


@query("ledger_latest", LEDGER + "\nSELECT * FROM latest")
def ledger_latest(spark, sf_dir):
    return I.ledger_latest(fx.ledger(spark, sf_dir))


@query("remaining_dates", LEDGER + "\nSELECT * FROM remaining")
def remaining_dates(spark, sf_dir):
    return I.remaining_dates(_days(spark, sf_dir), fx.ledger(spark, sf_dir))


@query("date_batches", LEDGER + f""",
isl AS (SELECT ledger_date, ledger_date - CAST(row_number() OVER (ORDER BY ledger_date) AS INTEGER) AS island
        FROM remaining),
kk AS (SELECT *, floor((row_number() OVER (PARTITION BY island ORDER BY ledger_date) - 1) / {BATCH_DAYS}) AS k FROM isl)
SELECT min(ledger_date) AS batch_start, max(ledger_date) AS batch_end, count(*) AS n_days,
       list_sort(list(ledger_date)) AS dates
FROM kk GROUP BY island, k""")
def date_batches(spark, sf_dir):
    return I.date_batches(I.remaining_dates(_days(spark, sf_dir), fx.ledger(spark, sf_dir)), BATCH_DAYS)


@query("ingestion_summary", LEDGER + """
SELECT count(*) AS days_tracked, count_if(status = 'completed') AS completed_days,
       count_if(status = 'failed') AS failed_days,
       CAST(sum(CASE WHEN status = 'completed' THEN n_records ELSE 0 END) AS BIGINT) AS total_records_ingested,
       CASE WHEN count_if(status = 'failed') = 0 THEN 'completed' ELSE 'partial' END AS status
FROM latest""")
def ingestion_summary(spark, sf_dir):
    return I.ingestion_summary(fx.ledger(spark, sf_dir))
