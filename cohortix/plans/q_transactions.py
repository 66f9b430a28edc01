"""Catalog: BNPL transaction modelling over the raw envelope table."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.functions.jsonx import discover_keys, flatten, regex_discovery, store_kinds, stored_schema
from cohortix.operators import transactions as B
from cohortix.params import BOOLEAN_FIELDS, DOUBLE_FIELDS, RUN_AT
from cohortix.plans import sqlfrag as Q
from cohortix.plans.registry import query
from cohortix.sources import fixtures as fx
from cohortix.sources.ingest import scratch_path

PATHS = sorted(k for k, _ in fx.TXN_FIELDS)


def _raw(spark, sf_dir):
    return fx.raw_transactions(spark, sf_dir, RUN_AT)


def _stg(spark, sf_dir):
    # Discovery runs over the data (plan-time aggregate, one row per key).
    return B.stg_transactions(_raw(spark, sf_dir), None, RUN_AT)


def _sql_scalar(key: str) -> str:
    v = f"json_extract_string(json_body, '$.{key}')"
    return f"(CASE WHEN ltrim({v}) LIKE '{{%' OR ltrim({v}) LIKE '[%' THEN NULL ELSE {v} END)"


def _sql_field(key: str) -> str:
    v = _sql_scalar(key)
    if key in DOUBLE_FIELDS:
        return f"TRY_CAST({v} AS DOUBLE) AS {key}"
    if key in BOOLEAN_FIELDS:
        return f"(CASE lower(trim({v})) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END) AS {key}"
    return f"{v} AS {key}"


UID_SQL = ("md5(" + _sql_scalar("transaction_id") + " || " + _sql_scalar("customer_id")
           + " || strftime(_timestamp, '%Y-%m-%d %H:%M:%S.%f'))")
FIELDS_SQL = ",\n  ".join(_sql_field(k) for k in PATHS)

RAW = "WITH " + Q.src_raw_txn(RUN_AT).strip()
STG = RAW + f""",
stg AS (
  SELECT {UID_SQL} AS unique_transaction_id,
  {FIELDS_SQL},
  _timestamp AS transaction_timestamp, _ingestion_timestamp, json_body, 'bnpl_api' AS data_source,
  {Q.ts(RUN_AT)} AS _loaded_at
  FROM src_raw)"""

# the row that opens a customer's record: the earliest of those with a tenure
TENURE = STG + """,
numbered AS (
  SELECT customer_id, transaction_timestamp, customer_tenure_days,
         row_number() OVER (PARTITION BY customer_id ORDER BY transaction_timestamp, unique_transaction_id) AS place
  FROM stg WHERE customer_tenure_days IS NOT NULL),
opening AS (
  SELECT customer_id, transaction_timestamp AS first_customer_transaction_date, customer_tenure_days AS first_customer_tenure
  FROM numbered WHERE place = 1),
tenure AS (
  SELECT stg.*, md5(customer_age_bracket || customer_credit_score_range || customer_id || customer_income_bracket || customer_state) AS unique_customer_id,
         opening.* EXCLUDE (customer_id),
         CAST(CAST(transaction_timestamp AS DATE) - CAST(first_customer_transaction_date AS DATE) AS INTEGER) AS days_from_first_transaction,
         first_customer_tenure + days_from_first_transaction AS adjusted_customer_tenure
  FROM stg JOIN opening USING (customer_id))"""


@query("raw_transactions", RAW + "\nSELECT * FROM src_raw")
def raw_transactions(spark, sf_dir):
    return _raw(spark, sf_dir)


@query("unique_txn_id", RAW + f"""
SELECT {UID_SQL} AS unique_transaction_id, {_sql_scalar('transaction_id')} AS transaction_id,
       {_sql_scalar('customer_id')} AS customer_id, _timestamp FROM src_raw""")
def unique_txn_id(spark, sf_dir):
    from cohortix.functions.jsonx import json_scalar

    return _raw(spark, sf_dir).select(
        B.unique_txn_id().alias("unique_transaction_id"),
        json_scalar("json_body", "transaction_id").alias("transaction_id"),
        json_scalar("json_body", "customer_id").alias("customer_id"),
        "_timestamp",
    )


DISCOVERY_SQL = RAW + """,
kk AS (SELECT k AS json_path,
              CASE json_type(json_body, '$.' || k)
                WHEN 'UBIGINT' THEN 'number' WHEN 'BIGINT' THEN 'number' WHEN 'DOUBLE' THEN 'number'
                WHEN 'HUGEINT' THEN 'number' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object'
                WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' ELSE 'string' END AS kind
       FROM src_raw, unnest(json_keys(json_body)) t(k)),
per AS (SELECT json_path, count(*) AS n_records,
               count(DISTINCT CASE WHEN kind <> 'null' THEN kind END) AS n_kinds,
               max(CASE WHEN kind <> 'null' THEN kind END) AS any_kind
        FROM kk WHERE regexp_full_match(json_path, '^[a-zA-Z_][a-zA-Z0-9_]*$') GROUP BY json_path),
disc AS (SELECT json_path, CASE WHEN n_kinds = 1 THEN any_kind ELSE 'string' END AS data_type, n_records FROM per)
SELECT json_path, data_type,
       CASE data_type WHEN 'number' THEN 'NUMERIC' WHEN 'boolean' THEN 'BOOLEAN' ELSE 'STRING' END AS warehouse_type,
       n_records
FROM disc"""


@query("json_schema_discovery", DISCOVERY_SQL)
def json_schema_discovery(spark, sf_dir):
    return discover_keys(_raw(spark, sf_dir))


@query("json_schema_stored", DISCOVERY_SQL)
def json_schema_stored(spark, sf_dir):
    """Schema merged from the stored counts of four loads, the last one run twice."""
    raw, home = _raw(spark, sf_dir), scratch_path(spark, "kinds")
    for load in (0, 1, 2, 3, 3):
        store_kinds(raw.where(F.pmod(F.dayofyear("_timestamp"), F.lit(4)) == load), home, f"days-{load}")
    return stored_schema(spark, home)


@query("json_flatten", RAW + f"\nSELECT {UID_SQL} AS unique_transaction_id,\n  {FIELDS_SQL}\nFROM src_raw")
def json_flatten(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return flatten(raw, PATHS, keep=[B.unique_txn_id().alias("unique_transaction_id")])


@query("stg_transactions", STG + "\nSELECT * FROM stg")
def stg_transactions(spark, sf_dir):
    return _stg(spark, sf_dir)


@query("unique_customer_id", STG + """
SELECT DISTINCT customer_id, md5(customer_age_bracket || customer_credit_score_range || customer_id
       || customer_income_bracket || customer_state) AS unique_customer_id FROM stg""")
def unique_customer_id(spark, sf_dir):
    return _stg(spark, sf_dir).select("customer_id", B.unique_customer_id().alias("unique_customer_id")).distinct()


@query("first_value_by_key", TENURE + "\nSELECT * FROM opening")
def first_value_by_key(spark, sf_dir):
    return B.first_transaction(_stg(spark, sf_dir))


@query("tenure_adjusted", TENURE + "\nSELECT * FROM tenure")
def tenure_adjusted(spark, sf_dir):
    return B.tenure_adjusted(B.store_staged(_stg(spark, sf_dir)))


@query("daily_counts", RAW + """
SELECT CAST(_timestamp AS DATE) AS ingestion_date, count(*) AS record_count FROM src_raw GROUP BY 1""")
def daily_counts(spark, sf_dir):
    return B.daily_counts(_raw(spark, sf_dir))


@query("completeness", STG + """
SELECT count(*) AS total_records, count(transaction_id) AS has_transaction_id,
       count(customer_id) AS has_customer_id, count(amount) AS has_amount FROM stg""")
def completeness(spark, sf_dir):
    return B.completeness(_stg(spark, sf_dir))


@query("json_value_counts", RAW + f"""
SELECT {_sql_scalar('risk_level')} AS risk_level, count(*) AS count FROM src_raw
WHERE {_sql_scalar('risk_level')} IS NOT NULL GROUP BY 1""")
def json_value_counts(spark, sf_dir):
    return B.json_value_counts(_raw(spark, sf_dir), "risk_level")


@query("json_field_presence", RAW + f"""
SELECT {UID_SQL} AS unique_transaction_id, json_extract_string(json_body, '$.will_default') AS will_default
FROM src_raw WHERE json_extract_string(json_body, '$.will_default') IS NOT NULL""")
def json_field_presence(spark, sf_dir):
    return B.json_field_presence(_raw(spark, sf_dir), "will_default")


@query("volume_profile", RAW + """,
d AS (SELECT CAST(_timestamp AS DATE) AS ingestion_date, count(*) AS record_count FROM src_raw GROUP BY 1),
a AS (SELECT avg(record_count) AS base_daily_volume, count(*) AS n_days,
             arg_min(ingestion_date, (record_count, ingestion_date)) AS lowest_day, min(record_count) AS lowest_count,
             arg_max(ingestion_date, (record_count, ingestion_date)) AS highest_day, max(record_count) AS highest_count,
             avg(record_count) FILTER (WHERE isodow(ingestion_date) <= 5) AS avg_weekday,
             avg(record_count) FILTER (WHERE isodow(ingestion_date) >= 6) AS avg_weekend,
             avg(record_count) FILTER (WHERE (month(ingestion_date), day(ingestion_date)) IN ((1, 1), (12, 25))) AS avg_holiday,
             avg(record_count) FILTER (WHERE ingestion_date IN (DATE '2024-02-14', DATE '2024-11-29')) AS avg_special
      FROM d)
SELECT *, lowest_count * 100.0 / base_daily_volume AS lowest_pct, highest_count * 100.0 / base_daily_volume AS highest_pct
FROM a""")
def volume_profile(spark, sf_dir):
    return B.volume_profile(_raw(spark, sf_dir))


@query("json_regex_discovery", RAW + """,
kk AS (SELECT json_body, k AS json_path
       FROM src_raw, unnest(regexp_extract_all(json_body, '"([a-zA-Z_][a-zA-Z0-9_]*)"\\s*:', 1)) t(k)
       WHERE k IS NOT NULL AND k <> '' AND regexp_full_match(k, '^[a-zA-Z_][a-zA-Z0-9_]*$')),
kv AS (SELECT json_path, nullif(regexp_extract(json_body, '"' || json_path || '":([^,}]+)', 1), '') AS v FROM kk),
kinds AS (SELECT json_path, CASE WHEN regexp_matches(v, '^-?\\d+(\\.\\d+)?$') THEN 'number'
                                 WHEN regexp_matches(v, '^(true|false)$') THEN 'boolean' ELSE 'string' END AS kind FROM kv),
per AS (SELECT json_path, sum(n) AS n_records, count(*) AS n_kinds, max(kind) AS any_kind
        FROM (SELECT json_path, kind, count(*) AS n FROM kinds GROUP BY ALL) GROUP BY json_path)
SELECT json_path, CASE WHEN n_kinds = 1 THEN any_kind ELSE 'string' END AS data_type,
       CASE WHEN n_kinds = 1 AND any_kind = 'number' THEN 'NUMERIC'
            WHEN n_kinds = 1 AND any_kind = 'boolean' THEN 'BOOLEAN' ELSE 'STRING' END AS warehouse_type,
       CAST(n_records AS BIGINT) AS n_records
FROM per""")
def json_regex_discovery(spark, sf_dir):
    return regex_discovery(_raw(spark, sf_dir))
