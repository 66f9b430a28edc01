"""Catalog: experiment order analytics (staging, union, mart, assignment)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cohortix.functions.dates import in_window, in_window_halfopen
from cohortix.operators import experiments as X
from cohortix.operators import orders as O
from cohortix.params import RUN_AT, ExperimentConfig
from cohortix.plans import sqlfrag as Q
from cohortix.plans.registry import query
from cohortix.sources import fixtures as fx
from cohortix.sources.ingest import scratch_path

CFG = ExperimentConfig()
W = CFG.window


def _flow(spark, sf_dir, upto="mart"):
    orders = fx.orders(spark, sf_dir)
    # participants need order headers only (no line-item aggregate)
    parts = X.experiment_participants(fx.orders(spark, sf_dir, with_items=False), W.experiment_start, W.experiment_end)
    asg = X.experiment_assignments(parts, CFG, RUN_AT)
    if upto == "assignments":
        return asg
    cohort = X.treatment_cohort(asg, CFG)
    if upto == "cohort":
        return cohort
    overlay = X.uplift_overlay(cohort, CFG, orders.schema)
    if upto == "overlay":
        return overlay
    base = O.stg_baseline_orders(orders, RUN_AT)
    over = O.stg_overlay_orders(overlay, RUN_AT)
    union = O.int_orders_union(base, over, asg, CFG)
    if upto == "union":
        return union
    return O.experiment_mart(union, CFG, RUN_AT)


FLOW_MART = Q.experiment_flow(CFG, "mart")


@query("experiment_mart", FLOW_MART + "\nSELECT * FROM mart")
def experiment_mart(spark, sf_dir):
    return _flow(spark, sf_dir, "mart")


@query("int_orders_union", Q.experiment_flow(CFG, "union") + "\nSELECT * FROM int_union")
def int_orders_union(spark, sf_dir):
    return _flow(spark, sf_dir, "union")


@query("experiment_assignments", Q.experiment_flow(CFG, "assignments") + "\nSELECT * FROM asg")
def experiment_assignments(spark, sf_dir):
    return _flow(spark, sf_dir, "assignments")


@query("treatment_cohort", Q.experiment_flow(CFG, "cohort") + "\nSELECT * FROM cohort")
def treatment_cohort(spark, sf_dir):
    return _flow(spark, sf_dir, "cohort")


@query("uplift_overlay", Q.experiment_flow(CFG, "overlay") + "\nSELECT * FROM overlay")
def uplift_overlay(spark, sf_dir):
    return _flow(spark, sf_dir, "overlay")


@query("stg_baseline_orders", "WITH " + Q.SRC_ORDERS.strip() + "," + Q.stg().strip().split("stg_over AS")[0].rstrip().rstrip(",")
       + "\nSELECT * FROM stg_base")
def stg_baseline_orders(spark, sf_dir):
    return O.stg_baseline_orders(fx.orders(spark, sf_dir), RUN_AT)


@query("stg_overlay_orders", Q.experiment_flow(CFG, "stg") + "\nSELECT * FROM stg_over")
def stg_overlay_orders(spark, sf_dir):
    orders = fx.orders(spark, sf_dir)
    return O.stg_overlay_orders(X.overlay_for(orders, CFG, RUN_AT), RUN_AT)


@query("orders_union_all", Q.experiment_flow(CFG, "stg")
       + f"\nSELECT {Q.STG_COLS} FROM stg_base UNION ALL SELECT {Q.STG_COLS} FROM stg_over")
def orders_union_all(spark, sf_dir):
    orders = fx.orders(spark, sf_dir)
    return O.orders_union_all(
        O.stg_baseline_orders(orders, RUN_AT), O.stg_overlay_orders(X.overlay_for(orders, CFG, RUN_AT), RUN_AT)
    )


@query("window_filter", "WITH " + Q.SRC_ORDERS.strip()
       + f"\nSELECT * FROM src_orders WHERE {Q.between('created_at', W.baseline_start, W.experiment_end)}")
def window_filter(spark, sf_dir):
    return fx.orders(spark, sf_dir).filter(in_window("created_at", W.baseline_start, W.experiment_end))


@query("window_filter_halfopen", "WITH " + Q.SRC_ORDERS.strip()
       + f"\nSELECT * FROM src_orders WHERE created_at >= {Q.ts(W.experiment_start)} AND created_at < {Q.ts(W.experiment_end)}")
def window_filter_halfopen(spark, sf_dir):
    return fx.orders(spark, sf_dir).filter(in_window_halfopen("created_at", W.experiment_start, W.experiment_end))


@query("order_flags", "WITH " + Q.SRC_ORDERS.strip() + """
SELECT order_id, CASE WHEN status = 'Complete' THEN 1 ELSE 0 END AS is_completed,
       CASE WHEN status = 'Cancelled' THEN 1 ELSE 0 END AS is_cancelled, 0 AS is_returned FROM src_orders""")
def order_flags(spark, sf_dir):
    return O.order_flags(fx.orders(spark, sf_dir, with_items=False))


@query("experiment_participants", "WITH " + Q.SRC_ORDERS.strip() + ",\n" + Q.participants(CFG)
       + "\nSELECT user_id FROM participants")
def experiment_participants(spark, sf_dir):
    return X.experiment_participants(fx.orders(spark, sf_dir, with_items=False), W.experiment_start, W.experiment_end)


_VA_BUCKET = Q.bucket(f"{Q.s('user_id')} || '_' || '{CFG.name}'")


@query("variant_assignment", "WITH " + Q.SRC_USERS.strip() + f"""
SELECT user_id, {_VA_BUCKET} AS bucket,
       {Q.arm_case(_VA_BUCKET, [CFG.control_name, CFG.treatment_name], [CFG.control_allocation, CFG.treatment_allocation])} AS variant
FROM src_users""")
def variant_assignment(spark, sf_dir):
    return X.variant_assignment(fx.users(spark, sf_dir), CFG)


# ---------------------------------------------------------------------------
# Extracts, samples, eligibility
# ---------------------------------------------------------------------------

@query("users_extract", "WITH " + Q.SRC_USERS.strip() + "\nSELECT * FROM src_users ORDER BY registration_date, user_id")
def users_extract(spark, sf_dir):
    return X.users_extract(fx.users(spark, sf_dir))


@query("completed_orders", "WITH " + Q.SRC_ORDERS.strip() + """
SELECT order_id, user_id, status, created_at AS order_date, shipped_at, delivered_at, num_of_item
FROM src_orders WHERE status = 'Complete' ORDER BY order_date, order_id""")
def completed_orders(spark, sf_dir):
    return X.completed_orders(fx.orders(spark, sf_dir))


SAMPLE_PCT = 10.0


@query("sample_users_orders", "WITH " + Q.SRC_ORDERS.strip() + ",\n" + Q.SRC_USERS.strip() + f""",
su AS (SELECT user_id FROM src_users
       QUALIFY row_number() OVER (ORDER BY md5('{CFG.seed}_sample_' || CAST(user_id AS VARCHAR)), user_id)
               <= (SELECT CAST(floor(count(*) * {SAMPLE_PCT} / 100) AS BIGINT) FROM src_users))
SELECT * FROM src_orders WHERE user_id IN (SELECT user_id FROM su)""")
def sample_users_orders(spark, sf_dir):
    return X.sample_users_orders(fx.users(spark, sf_dir), fx.orders(spark, sf_dir), SAMPLE_PCT, CFG.seed)


_COUNTRIES = ", ".join(f"'{c}'" for c in CFG.countries)


@query("eligible_users", "WITH " + Q.SRC_USERS.strip() + f"\nSELECT * FROM src_users WHERE country IN ({_COUNTRIES})")
def eligible_users(spark, sf_dir):
    return X.eligible_users(fx.users(spark, sf_dir), CFG.countries)


@query("cohort_cap", Q.experiment_flow(CFG, "cohort") + f"""
SELECT '{CFG.name}' AS experiment_name,
       (SELECT count(*) FROM asg WHERE variant_description = '{CFG.treatment_name}') AS available_users,
       CAST({CFG.cohort_cap} AS BIGINT) AS cohort_cap,
       (SELECT count(*) FROM cohort) AS cohort_users,
       CAST({CFG.target_rate!r} AS DOUBLE) AS target_rate,
       CAST({CFG.additional_orders_per_user!r} AS DOUBLE) AS additional_orders_per_user""")
def cohort_cap(spark, sf_dir):
    return X.cohort_cap_summary(_flow(spark, sf_dir, "assignments"), CFG)


#: an experiment that cannot be built: its window has no last day
BROKEN = replace(CFG, name="open_ended_test", window=replace(W, experiment_end="open"))


@query("overlay_summary", Q.experiment_flow(CFG, "overlay") + f"""
SELECT '{CFG.name}' AS experiment_name, 'synthetic_{CFG.name}_orders' AS table_name, count(*) AS rows_created,
       count(DISTINCT user_id) AS unique_users, 'success' AS status, NULL AS error_kind
FROM overlay
UNION ALL SELECT '{BROKEN.name}', 'synthetic_{BROKEN.name}_orders', 0, 0, 'failed', 'ValueError'""")
def overlay_summary(spark, sf_dir):
    """A run over two experiments, of which one cannot be built."""
    run = X.run_overlays(fx.orders(spark, sf_dir), (BROKEN, CFG), scratch_path(spark, "overlays"), RUN_AT)
    return run.withColumn("error_kind", F.split("error", ":")[0]).drop("error")


# ---------------------------------------------------------------------------
# Multi-experiment programme, shares and balance
# ---------------------------------------------------------------------------

def _programme_sql() -> str:
    from cohortix.functions.hashing import cumulative_thresholds
    from cohortix.params import LEGACY_EXPERIMENTS

    rows = []
    for name, arms, alloc, start, end, desc, metric in LEGACY_EXPERIMENTS:
        c = cumulative_thresholds(alloc)
        rows.append(f"('{name}', '{arms[0]}', '{arms[1]}', '{arms[2]}', {c[0]}, {c[1]}, {c[2]}, "
                    f"'{start}', '{end}', '{desc}', '{metric}')")
    b = Q.bucket("CAST(u.user_id AS VARCHAR) || '_' || e.experiment_name")
    return f"""
prog(experiment_name, a1, a2, a3, c1, c2, c3, s, e, d, m) AS (VALUES {', '.join(rows)}),
multi AS (
  SELECT u.user_id, e.experiment_name,
         CASE WHEN {b} <= e.c1 THEN e.a1 WHEN {b} <= e.c2 THEN e.a2 WHEN {b} <= e.c3 THEN e.a3 ELSE e.a1 END AS variant,
         e.s AS assigned_date, e.s AS experiment_start_date, e.e AS experiment_end_date,
         e.d AS experiment_description, e.m AS success_metric, 'deterministic_hash' AS assignment_method
  FROM src_users u JOIN prog e ON u.registration_date <= CAST(e.s AS DATE))"""


MULTI = "WITH " + Q.SRC_USERS.strip() + "," + _programme_sql()


def _multi(spark, sf_dir):
    return X.multi_experiment_assign(fx.users(spark, sf_dir))


@query("multi_experiment_assign", MULTI + "\nSELECT * FROM multi")
def multi_experiment_assign(spark, sf_dir):
    return _multi(spark, sf_dir)


SHARE_SQL = """
share AS (
  SELECT experiment_name, variant, count(*) AS user_count,
         count(*) / sum(count(*)) OVER (PARTITION BY experiment_name) AS allocation_pct
  FROM multi GROUP BY experiment_name, variant)"""


@query("variant_share", MULTI + "," + SHARE_SQL + "\nSELECT * FROM share")
def variant_share(spark, sf_dir):
    return X.variant_share(_multi(spark, sf_dir))


# Assignments of which two experiments lost half of an arm.
SKEWED = MULTI.replace("\nmulti AS (", "\neven AS (") + """,
multi AS (SELECT * FROM even WHERE NOT (variant IN ('blue_button', 'weekly') AND user_id % 2 = 0)),"""


@query("dq_variant_balance", SKEWED + SHARE_SQL + """
SELECT *, 1.0 / count(*) OVER (PARTITION BY experiment_name) AS expected_pct FROM share
QUALIFY abs(allocation_pct - expected_pct) > 0.05""")
def dq_variant_balance(spark, sf_dir):
    lost = F.col("variant").isin("blue_button", "weekly") & (F.col("user_id") % 2 == 0)
    return X.dq_variant_balance(_multi(spark, sf_dir).filter(~lost), None, 0.05)


@query("balance_ratio", MULTI + """
, c AS (SELECT experiment_name, variant, count(*) AS n FROM multi GROUP BY ALL)
SELECT experiment_name, min(n) AS min_arm, max(n) AS max_arm, min(n) / max(n) AS balance_ratio
FROM c GROUP BY experiment_name""")
def balance_ratio(spark, sf_dir):
    return X.balance_ratio(_multi(spark, sf_dir))


# ---------------------------------------------------------------------------
# Mart aggregates and experiment results
# ---------------------------------------------------------------------------

@query("group_stats", FLOW_MART + """
SELECT time_period, data_source, min(days_to_deliver) AS min_days_to_deliver,
       max(days_to_deliver) AS max_days_to_deliver,
       CAST(avg(days_to_deliver) AS DECIMAL(18,4)) AS avg_days_to_deliver
FROM mart GROUP BY time_period, data_source""")
def group_stats(spark, sf_dir):
    m = _flow(spark, sf_dir, "mart")
    return m.groupBy("time_period", "data_source").agg(
        F.min("days_to_deliver").alias("min_days_to_deliver"),
        F.max("days_to_deliver").alias("max_days_to_deliver"),
        F.avg("days_to_deliver").cast("decimal(18,4)").alias("avg_days_to_deliver"),
    )


@query("orders_per_user", FLOW_MART + """
SELECT data_source, count(*) AS n_orders, count(DISTINCT user_id) AS n_users,
       count(*) / count(DISTINCT user_id) AS orders_per_user
FROM mart GROUP BY data_source""")
def orders_per_user(spark, sf_dir):
    m = _flow(spark, sf_dir, "mart")
    return m.groupBy("data_source").agg(
        F.count(F.lit(1)).alias("n_orders"), F.countDistinct("user_id").alias("n_users"),
    ).withColumn("orders_per_user", F.col("n_orders") / F.col("n_users"))


@query("effect_size", FLOW_MART + """
, per AS (
  SELECT control_treatment,
         sum(CASE WHEN time_period = 'experiment_period' THEN 1 ELSE 0 END) AS exp_orders,
         count(DISTINCT user_id) AS users
  FROM mart WHERE experiment_status = 'experiment_participant' GROUP BY control_treatment),
rates AS (
  SELECT sum(CASE WHEN control_treatment = 'control' THEN exp_orders / users END) AS baseline_rate,
         sum(CASE WHEN control_treatment = 'treatment' THEN exp_orders / users END) AS target_rate
  FROM per)
SELECT baseline_rate, target_rate, (target_rate - baseline_rate) / baseline_rate AS effect FROM rates""")
def effect_size(spark, sf_dir):
    return X.effect_size(_flow(spark, sf_dir, "mart"))


@query("experiment_results", Q.experiment_flow(CFG, "assignments") + ",\n" + Q.SRC_ITEMS.strip() + """,
a2 AS (SELECT CAST(object_identifier AS BIGINT) AS user_id, experiment_name, variant,
              CAST(assigned_date AS TIMESTAMP) AS assigned_at FROM asg),
rev AS (SELECT order_id, sum(sale_price) AS order_revenue FROM src_items GROUP BY order_id),
od AS (SELECT o.order_id, o.user_id, o.created_at, r.order_revenue
       FROM src_orders o LEFT JOIN rev r ON o.order_id = r.order_id),
j AS (SELECT a2.*, od.created_at, od.order_revenue FROM a2 LEFT JOIN od ON a2.user_id = od.user_id
      WHERE od.created_at >= a2.assigned_at AND od.created_at < a2.assigned_at + INTERVAL 30 DAY),
per_user AS (SELECT experiment_name, variant, user_id, sum(order_revenue) AS revenue FROM j GROUP BY ALL),
exposed AS (SELECT experiment_name, variant, count(*) AS exposed_users FROM a2 GROUP BY ALL),
conv AS (SELECT experiment_name, variant, count(*) AS conversions_30d, sum(revenue) AS revenue_30d
         FROM per_user GROUP BY ALL),
res AS (SELECT e.experiment_name, e.variant, e.exposed_users,
               CAST(coalesce(c.conversions_30d, 0) AS BIGINT) AS conversions_30d,
               CAST(coalesce(c.revenue_30d, 0) AS DECIMAL(18,2)) AS revenue_30d
        FROM exposed e LEFT JOIN conv c ON e.experiment_name = c.experiment_name AND e.variant = c.variant),
r2 AS (SELECT *, conversions_30d / exposed_users AS conversion_rate_30d,
              CAST(revenue_30d AS DOUBLE) / exposed_users AS avg_revenue_per_user,
              max(CASE WHEN variant = 'control' THEN exposed_users END) OVER (PARTITION BY experiment_name) AS cn,
              max(CASE WHEN variant = 'control' THEN conversions_30d END) OVER (PARTITION BY experiment_name) AS cx
       FROM res),
r3 AS (SELECT *, (conversions_30d + cx) / (exposed_users + cn) AS pooled FROM r2),
r4 AS (SELECT *, sqrt(pooled * (1 - pooled) * (1.0 / exposed_users + 1.0 / cn)) AS se FROM r3),
r5 AS (SELECT *, CASE WHEN variant <> 'control' AND se > 0 THEN (conversion_rate_30d - cx / cn) / se END AS z_score FROM r4)
SELECT experiment_name, variant, exposed_users, conversions_30d, revenue_30d, conversion_rate_30d,
       avg_revenue_per_user, z_score,
       CASE WHEN z_score IS NULL THEN NULL WHEN abs(z_score) > 1.96 THEN 'significant' ELSE 'not_significant' END
         AS statistical_significance
FROM r5""")
def experiment_results(spark, sf_dir):
    asg = _flow(spark, sf_dir, "assignments")
    return X.experiment_results(asg, fx.orders(spark, sf_dir, with_items=False), fx.order_items(spark, sf_dir), CFG)
