"""SQL text builders for the oracle side.

These mirror the fixture adapters and the core expressions as plain ANSI SQL
(DuckDB dialect where functions differ: md5 -> UHUGEINT buckets, list_filter).
They exist so that every catalog key can be checked against an independent
engine; the Spark side never executes them.
"""

from __future__ import annotations

from cohortix.functions.hashing import (
    count_below_sql,
    cumulative_thresholds,
    sql_lit,
)
from cohortix.operators.experiments import day_cuts, poisson_cuts
from cohortix.params import RUN_AT, ExperimentConfig
from cohortix.sources.fixtures import (
    AGE_BRACKETS,
    CREDIT_RANGES,
    EVENT_STATUS,
    INCOME_BRACKETS,
    TXN_FIELDS,
)


def bucket(expr: str) -> str:
    return f"CAST((('0x' || md5({expr}))::UHUGEINT % 1000000) AS BIGINT)"


def hash60(hex_expr: str) -> str:
    return f"CAST(('0x' || substr({hex_expr}, 1, 15))::UBIGINT AS BIGINT)"


def s(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def between(col: str, a: str, b: str, inclusive_days: bool = False) -> str:
    if inclusive_days:
        return f"({col} >= {ts(a)} AND {col} < CAST(DATE '{b}' + 1 AS TIMESTAMP))"
    return f"({col} BETWEEN {ts(a)} AND {ts(b)})"


def arm_case(b: str, variants, allocation) -> str:
    cuts = cumulative_thresholds(allocation)
    whens = " ".join(f"WHEN {b} <= {t} THEN {sql_lit(v)}" for v, t in zip(variants, cuts))
    return f"(CASE {whens} ELSE {sql_lit(variants[0])} END)"


# ---------------------------------------------------------------------------
# Fixture CTEs
# ---------------------------------------------------------------------------

STATUS_CASE = "CASE o_orderstatus WHEN 'F' THEN 'Complete' WHEN 'P' THEN 'Cancelled' WHEN 'O' THEN 'Processing' END"

SRC_ORDERS = f"""
src_li AS (
  SELECT l_orderkey, CAST(count(*) AS INTEGER) AS num_of_item,
         min(l_shipdate) AS shipped_at, max(l_shipdate) AS delivered_at
  FROM lineitem GROUP BY l_orderkey),
src_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, {STATUS_CASE} AS status,
         CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         src_li.num_of_item, o_orderdate AS created_at, src_li.shipped_at, src_li.delivered_at
  FROM orders LEFT JOIN src_li ON o_orderkey = src_li.l_orderkey)"""

SRC_USERS = """
src_first AS (SELECT o_custkey AS user_id, min(o_orderdate) AS first_order_at FROM orders GROUP BY o_custkey),
src_users AS (
  SELECT c_custkey AS user_id,
         lower(replace(c_name, '#', '_')) || '@example.com' AS email,
         c_name AS full_name,
         CAST(18 + c_custkey % 60 AS INTEGER) AS age,
         CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         n_name AS country,
         lower(c_mktsegment) AS acquisition_channel,
         CAST(src_first.first_order_at AS DATE) AS registration_date
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN src_first ON c_custkey = src_first.user_id)"""

SRC_ITEMS = f"""
src_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_number, o_custkey AS user_id,
         l_partkey AS product_id, p_type AS category, p_brand AS brand,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS sale_price,
         {STATUS_CASE} AS status, o_orderdate AS created_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN part ON l_partkey = p_partkey)"""


def _pick(idx: str, values) -> str:
    arr = ", ".join(sql_lit(v) for v in values)
    return f"[{arr}][{idx} + 1]"


def txn_json_sql() -> str:
    k = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
    status = "CASE " + " ".join(f"WHEN event_type = '{a}' THEN '{b}'" for a, b in EVENT_STATUS) + " END"
    vals = {
        "transaction_id": "'txn_' || lpad(CAST(event_id % 1000 AS VARCHAR), 8, '0')",
        "customer_id": "'cust_' || CAST(user_id AS VARCHAR)",
        "product_id": f"'prod_' || CAST({k} AS VARCHAR)",
        "_timestamp": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')",
        "amount": "CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)",
        "currency": "'USD'",
        "status": status,
        "risk_score": f"CAST(CAST(({k} % 100) / 100 AS DECIMAL(4,2)) AS VARCHAR)",
        "risk_level": f"CASE WHEN {k} % 100 < 20 THEN 'very_low' WHEN {k} % 100 < 40 THEN 'low' "
        f"WHEN {k} % 100 < 60 THEN 'medium' WHEN {k} % 100 < 80 THEN 'high' ELSE 'very_high' END",
        "will_default": f"CASE WHEN {k} % 7 = 0 THEN 'true' ELSE 'false' END",
        "device_is_trusted": "CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END",
        "customer_tenure_days": "CAST(user_id % 365 AS VARCHAR)",
        "customer_age_bracket": _pick("user_id % 5", AGE_BRACKETS),
        "customer_credit_score_range": _pick("user_id % 4", CREDIT_RANGES),
        "customer_income_bracket": _pick("user_id % 4", INCOME_BRACKETS),
        "customer_state": "'S' || CAST(user_id % 50 AS VARCHAR)",
        "payment_method_id": "'pm_' || CAST(user_id AS VARCHAR)",
        "installment_count": "'4'",
    }
    pieces = ["'{'"]
    for i, (key, kind) in enumerate(TXN_FIELDS):
        sep = "," if i else ""
        if kind == "s":
            pieces += [f"'{sep}\"{key}\":\"'", f"({vals[key]})", "'\"'"]
        else:
            pieces += [f"'{sep}\"{key}\":'", f"({vals[key]})"]
    pieces.append("'}'")
    return " || ".join(pieces)


def src_raw_txn(run_at: str = RUN_AT) -> str:
    return f"""
src_raw AS (
  SELECT ts AS _timestamp, {txn_json_sql()} AS json_body, {ts(run_at)} AS _ingestion_timestamp
  FROM events)"""


SRC_CACHED = """
src_cached AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'pred:' ELSE 'tx:' END || CAST(user_id AS VARCHAR) || '_' || strftime(ts, '%Y%m%d') AS record_key,
         ts AS written_at, event_id AS seq,
         '{"customer_id":"cust_' || CAST(user_id AS VARCHAR) || '","event_id":' || CAST(event_id AS VARCHAR)
           || ',"score":' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || ',"kind":"' || event_type || '"}' AS payload
  FROM events),
src_marks AS (
  SELECT record_key, TIMESTAMP '2024-01-30 00:00:00' AS uploaded_at
  FROM src_cached GROUP BY record_key HAVING max(written_at) < TIMESTAMP '2024-01-30 00:00:00')"""

SRC_LEDGER = """
src_perday AS (SELECT CAST(ts AS DATE) AS ledger_date, count(*) AS n FROM events GROUP BY 1),
src_ledger AS (
  SELECT ledger_date, CASE WHEN n % 2 = 0 THEN 'completed' ELSE 'failed' END AS status,
         CAST(CASE WHEN n % 2 = 0 THEN n ELSE 0 END AS BIGINT) AS n_records,
         CAST(ledger_date + 1 AS TIMESTAMP) + INTERVAL 1 HOUR AS updated_at
  FROM src_perday
  UNION ALL
  SELECT ledger_date, 'completed', CAST(n AS BIGINT), CAST(ledger_date + 2 AS TIMESTAMP) + INTERVAL 1 HOUR
  FROM src_perday WHERE n % 2 = 1 AND day(ledger_date) > 20)"""


# ---------------------------------------------------------------------------
# Experiment flow CTEs
# ---------------------------------------------------------------------------

def participants(cfg: ExperimentConfig, name: str = "participants") -> str:
    w = cfg.window
    return (f"{name} AS (SELECT DISTINCT user_id FROM src_orders "
            f"WHERE {between('created_at', w.experiment_start, w.experiment_end)})")


def assignments(cfg: ExperimentConfig, run_at: str = RUN_AT, src: str = "participants") -> str:
    w = cfg.window
    b = bucket(f"{s('user_id')} || '_' || '{cfg.name}'")
    arm = arm_case(b, [cfg.control_name, cfg.treatment_name], [cfg.control_allocation, cfg.treatment_allocation])
    return f"""
asg_arm AS (SELECT user_id, {arm} AS arm FROM {src}),
asg AS (
  SELECT substr(md5({s('user_id')} || '_{cfg.name}_{w.experiment_start}'), 1, 16) AS assignment_id,
         '{cfg.name}' AS experiment_name, {s('user_id')} AS object_identifier, 'user' AS granularity_level,
         CASE WHEN arm = '{cfg.control_name}' THEN 'control' ELSE 'treatment' END AS variant,
         arm AS variant_description, '{w.experiment_start}' AS assigned_date,
         '{w.experiment_start}' AS experiment_start_date, '{w.experiment_end}' AS experiment_end_date,
         'deterministic_hash' AS assignment_method, {ts(run_at)} AS "createdAt"
  FROM asg_arm)"""


def cohort(cfg: ExperimentConfig) -> str:
    return f"""
cohort AS (
  SELECT CAST(object_identifier AS BIGINT) AS user_id, experiment_name, variant_description FROM asg
  WHERE variant_description = '{cfg.treatment_name}'
  ORDER BY md5('{cfg.seed}_sample_' || CAST(CAST(object_identifier AS BIGINT) AS VARCHAR)), user_id
  LIMIT {cfg.cohort_cap})"""


def overlay(cfg: ExperimentConfig) -> str:
    seed = cfg.seed
    pc = poisson_cuts(cfg.additional_orders_per_user)
    dc = day_cuts(cfg.duration_days)
    n = count_below_sql(bucket(f"'{seed}_poisson_' || {s('user_id')}"), pc)
    okey = f"{s('user_id')} || '_' || {s('i')}"

    def draw(salt):
        return bucket(f"'{seed}_{salt}_' || okey")

    day = count_below_sql(draw("day"), dc)
    return f"""
ov_n AS (SELECT user_id, {n} AS n FROM cohort),
ov_x AS (SELECT user_id, unnest(generate_series(1, n)) AS i FROM ov_n WHERE n > 0),
ov_k AS (SELECT user_id, {okey} AS okey FROM ov_x),
ov_d AS (SELECT *, CAST(DATE '{cfg.window.experiment_start}' + {day} AS TIMESTAMP) AS order_ts FROM ov_k),
overlay AS (
  SELECT {hash60(f"md5('{seed}_order_{cfg.name}_' || okey)")} AS order_id, user_id,
         '{cfg.name}' AS experiment_name, '{cfg.treatment_name}' AS variant,
         'Complete' AS status,
         CASE WHEN {draw('gender')} % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CAST(1 + {draw('items')} % 3 AS INTEGER) AS num_of_item,
         order_ts AS created_at,
         order_ts + to_days(CAST(1 + {draw('ship')} % 3 AS INTEGER)) AS shipped_at,
         order_ts + to_days(CAST(3 + {draw('deliver')} % 5 AS INTEGER)) AS delivered_at
  FROM ov_d)"""


STG_COLS = ("order_id, user_id, experiment_name, variant, status, gender, num_of_item, "
            "created_at, shipped_at, delivered_at, data_source, _loaded_at")


def stg(run_at: str = RUN_AT) -> str:
    return f"""
stg_base AS (
  SELECT order_id, user_id, CAST(NULL AS VARCHAR) AS experiment_name, CAST(NULL AS VARCHAR) AS variant,
         status, gender, num_of_item, created_at, shipped_at, delivered_at,
         'thelook_baseline' AS data_source, {ts(run_at)} AS _loaded_at FROM src_orders),
stg_over AS (
  SELECT order_id, user_id, experiment_name, variant, status, gender, num_of_item,
         created_at, shipped_at, delivered_at, 'synthetic_overlay' AS data_source, {ts(run_at)} AS _loaded_at
  FROM overlay)"""


def union_cte(cfg: ExperimentConfig) -> str:
    w = cfg.window
    return f"""
unioned AS (
  SELECT {STG_COLS} FROM stg_base WHERE {between('created_at', w.baseline_start, w.experiment_end, w.inclusive_days)}
  UNION ALL SELECT {STG_COLS} FROM stg_over),
part AS (
  SELECT CAST(object_identifier AS BIGINT) AS user_id, variant AS control_treatment, variant_description
  FROM asg WHERE experiment_name = '{cfg.name}'),
int_union AS (
  SELECT u.*, p.control_treatment, p.variant_description,
         CASE WHEN p.control_treatment IS NOT NULL THEN 'experiment_participant' ELSE 'non_participant' END
           AS experiment_status
  FROM unioned u LEFT JOIN part p ON u.user_id = p.user_id)"""


def mart_cte(cfg: ExperimentConfig, run_at: str = RUN_AT) -> str:
    w = cfg.window
    return f"""
mart AS (
  SELECT order_id, user_id, data_source, experiment_name, variant, control_treatment, variant_description,
         experiment_status,
         CASE WHEN {between('created_at', w.experiment_start, w.experiment_end, w.inclusive_days)} THEN 'experiment_period'
              WHEN {between('created_at', w.baseline_start, w.baseline_end, w.inclusive_days)} THEN 'baseline_period'
              ELSE 'other' END AS time_period,
         status, gender, num_of_item, created_at, shipped_at, delivered_at,
         CASE WHEN status = 'Complete' THEN 1 ELSE 0 END AS is_completed,
         CASE WHEN status = 'Cancelled' THEN 1 ELSE 0 END AS is_cancelled,
         0 AS is_returned,
         CAST(date_diff('day', CAST(created_at AS DATE), CAST(shipped_at AS DATE)) AS INTEGER) AS days_to_ship,
         CAST(date_diff('day', CAST(created_at AS DATE), CAST(delivered_at AS DATE)) AS INTEGER) AS days_to_deliver,
         {ts(run_at)} AS analysis_run_at, _loaded_at
  FROM int_union
  WHERE {between('created_at', w.baseline_start, w.experiment_end, w.inclusive_days)})"""


def experiment_flow(cfg: ExperimentConfig, upto: str = "mart", run_at: str = RUN_AT) -> str:
    """WITH-list of the whole flagship flow up to a named stage."""
    parts = [SRC_ORDERS.strip(), participants(cfg), assignments(cfg, run_at).strip()]
    if upto in ("cohort", "overlay", "stg", "union", "mart"):
        parts.append(cohort(cfg).strip())
    if upto in ("overlay", "stg", "union", "mart"):
        parts.append(overlay(cfg).strip())
    if upto in ("stg", "union", "mart"):
        parts.append(stg(run_at).strip())
    if upto in ("union", "mart"):
        parts.append(union_cte(cfg).strip())
    if upto == "mart":
        parts.append(mart_cte(cfg, run_at).strip())
    return "WITH " + ",\n".join(parts)
