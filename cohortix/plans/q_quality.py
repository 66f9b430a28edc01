"""Catalog: data-quality checks (violating rows) and their summary.

The given tables are clean, so the checks run over rows of which a fixed part
is made faulty by its key: every check has something to find."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.operators import quality as D
from cohortix.operators import transactions as B
from cohortix.params import ORDER_STATUSES, RISK_LEVELS, TIME_PERIODS, TXN_STATUSES
from cohortix.plans import q_experiments as QX
from cohortix.plans import q_transactions as QT
from cohortix.plans import sqlfrag as Q
from cohortix.plans.registry import query
from cohortix.sources import fixtures as fx
from cohortix.sources.tables import load

STG_REQUIRED = ("transaction_id", "customer_id", "product_id", "amount", "currency", "status", "risk_score",
                "risk_level", "will_default", "payment_method_id", "transaction_timestamp")


# Staged transactions, a fifth of them with each fault.
FAULTY_STG = QT.STG.replace("\nstg AS (", "\nclean_stg AS (") + """,
stg AS (SELECT * REPLACE (
  CASE WHEN customer_tenure_days % 5 = 1 THEN NULL ELSE payment_method_id END AS payment_method_id,
  CASE WHEN customer_tenure_days % 5 = 2 THEN -amount - 1 ELSE amount END AS amount,
  CASE WHEN customer_tenure_days % 5 = 3 THEN risk_score + 1.5 ELSE risk_score END AS risk_score,
  CASE WHEN customer_tenure_days % 5 = 4 THEN -customer_tenure_days ELSE customer_tenure_days END AS customer_tenure_days)
  FROM clean_stg)"""
FAULTY_TENURE = FAULTY_STG + QT.TENURE[len(QT.STG):]


def _faulty_stg(spark, sf_dir):
    kind = F.col("customer_tenure_days") % 5
    return QT._stg(spark, sf_dir).withColumns({
        "payment_method_id": F.when(kind == 1, None).otherwise(F.col("payment_method_id")),
        "amount": F.when(kind == 2, -F.col("amount") - 1).otherwise(F.col("amount")),
        "risk_score": F.when(kind == 3, F.col("risk_score") + 1.5).otherwise(F.col("risk_score")),
        "customer_tenure_days": F.when(kind == 4, -F.col("customer_tenure_days")).otherwise(F.col("customer_tenure_days")),
    })


# Mart rows with an unknown status or gender, overlay rows without a variant.
FAULTY_MART = QX.FLOW_MART.replace("\nmart AS (", "\nclean_mart AS (") + """,
mart AS (SELECT * REPLACE (
  CASE WHEN order_id % 7 = 0 THEN 'Lost' ELSE status END AS status,
  CASE WHEN order_id % 11 = 0 THEN 'X' ELSE gender END AS gender,
  CASE WHEN data_source = 'synthetic_overlay' AND order_id % 2 = 0 THEN NULL ELSE variant END AS variant)
  FROM clean_mart)"""


def _faulty_mart(spark, sf_dir):
    key = F.col("order_id")
    return QX._flow(spark, sf_dir, "mart").withColumns({
        "status": F.when(key % 7 == 0, "Lost").otherwise(F.col("status")),
        "gender": F.when(key % 11 == 0, "X").otherwise(F.col("gender")),
        "variant": F.when((F.col("data_source") == "synthetic_overlay") & (key % 2 == 0), None).otherwise(F.col("variant")),
    })


def _in(values) -> str:
    return ", ".join(Q.sql_lit(v) for v in values)


@query("dq_unique", QT.STG + "\nSELECT transaction_id, count(*) AS n_rows FROM stg GROUP BY transaction_id HAVING count(*) > 1")
def dq_unique(spark, sf_dir):
    return D.unique(QT._stg(spark, sf_dir), "transaction_id")


NOT_NULL_SQL = " UNION ALL ".join(
    f"SELECT unique_transaction_id, '{c}' AS failed_column FROM stg WHERE {c} IS NULL" for c in STG_REQUIRED
)


@query("dq_not_null", FAULTY_STG + "\n" + NOT_NULL_SQL)
def dq_not_null(spark, sf_dir):
    return D.not_null(_faulty_stg(spark, sf_dir), "unique_transaction_id", STG_REQUIRED)


@query("dq_accepted_values", FAULTY_MART + f"""
SELECT order_id, 'status' AS column_name, status AS value FROM mart WHERE status IS NOT NULL AND status NOT IN ({_in(ORDER_STATUSES)})
UNION ALL SELECT order_id, 'time_period', time_period FROM mart WHERE time_period IS NOT NULL AND time_period NOT IN ({_in(TIME_PERIODS)})
UNION ALL SELECT order_id, 'gender', gender FROM mart WHERE gender IS NOT NULL AND gender NOT IN ('M', 'F')""")
def dq_accepted_values(spark, sf_dir):
    m = _faulty_mart(spark, sf_dir)
    return D.rule_violations(m, "order_id", [
        D.accepted_values_rule("status", ORDER_STATUSES),
        D.accepted_values_rule("time_period", TIME_PERIODS),
        D.accepted_values_rule("gender", ("M", "F")),
    ])


@query("dq_range", FAULTY_STG + """
SELECT unique_transaction_id, 'amount' AS column_name, CAST(amount AS DOUBLE) AS value FROM stg WHERE amount IS NOT NULL AND amount < 0
UNION ALL SELECT unique_transaction_id, 'risk_score', CAST(risk_score AS DOUBLE) FROM stg
WHERE risk_score IS NOT NULL AND (risk_score < 0.0 OR risk_score > 1.0)""")
def dq_range(spark, sf_dir):
    s = _faulty_stg(spark, sf_dir)
    return D.rule_violations(s, "unique_transaction_id", [
        D.range_rule("amount", 0), D.range_rule("risk_score", 0.0, 1.0),
    ])


TENURE_BOUNDS = (("first_customer_tenure", 0, 10000), ("days_from_first_transaction", 0, 365),
                 ("adjusted_customer_tenure", 0, 10365))


@query("dq_between", FAULTY_TENURE + "\n" + " UNION ALL ".join(
    f"SELECT unique_transaction_id, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM tenure "
    f"WHERE {c} IS NOT NULL AND ({c} < {lo} OR {c} > {hi})" for c, lo, hi in TENURE_BOUNDS))
def dq_between(spark, sf_dir):
    t = B.tenure_adjusted(B.store_staged(_faulty_stg(spark, sf_dir)))
    return D.rule_violations(t, "unique_transaction_id", [D.range_rule(c, lo, hi) for c, lo, hi in TENURE_BOUNDS])


@query("dq_conditional", FAULTY_MART + """
SELECT order_id, 'experiment_name' AS failed_column FROM mart WHERE data_source = 'synthetic_overlay' AND experiment_name IS NULL
UNION ALL SELECT order_id, 'variant' FROM mart WHERE data_source = 'synthetic_overlay' AND variant IS NULL""")
def dq_conditional(spark, sf_dir):
    m = _faulty_mart(spark, sf_dir)
    return D.conditional(m, F.col("data_source") == "synthetic_overlay",
                         lambda df: D.not_null(df, "order_id", ("experiment_name", "variant")))


_SUMMARY_PARTS = [
    ("unique_transaction_id_unique", "error",
     "SELECT unique_transaction_id FROM stg GROUP BY unique_transaction_id HAVING count(*) > 1"),
    ("transaction_id_unique", "warn", "SELECT transaction_id FROM stg GROUP BY transaction_id HAVING count(*) > 1"),
    ("required_not_null", "warn", NOT_NULL_SQL),
    ("currency_accepted", "warn", "SELECT 1 FROM stg WHERE currency IS NOT NULL AND currency NOT IN ('USD')"),
    ("status_accepted", "warn", f"SELECT 1 FROM stg WHERE status IS NOT NULL AND status NOT IN ({_in(TXN_STATUSES)})"),
    ("risk_level_accepted", "warn",
     f"SELECT 1 FROM stg WHERE risk_level IS NOT NULL AND risk_level NOT IN ({_in(RISK_LEVELS)})"),
    ("risk_score_range", "warn", "SELECT 1 FROM stg WHERE risk_score IS NOT NULL AND (risk_score < 0.0 OR risk_score > 1.0)"),
    ("amount_range", "warn", "SELECT 1 FROM stg WHERE amount IS NOT NULL AND amount < 0"),
]


def _txn_summary(s):
    """Row-level rules in one aggregate, key uniqueness as group-bys."""
    def in_set(c, values):
        return F.col(c).isNotNull() & ~F.col(c).isin(list(values))

    def rng(c, lo=None, hi=None):
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (F.col(c) < lo)
        if hi is not None:
            bad = bad | (F.col(c) > hi)
        return F.col(c).isNotNull() & bad

    nulls = F.lit(0)
    for c in STG_REQUIRED:
        nulls = nulls + F.col(c).isNull().cast("int")
    rows = D.count_rule_failures(s, [
        ("currency_accepted", in_set("currency", ("USD",))),
        ("status_accepted", in_set("status", TXN_STATUSES)),
        ("risk_level_accepted", in_set("risk_level", RISK_LEVELS)),
        ("risk_score_range", rng("risk_score", 0.0, 1.0)),
        ("amount_range", rng("amount", 0)),
    ], weighted=[("required_not_null", nulls)])
    uniq = [
        D.unique(s, "unique_transaction_id").agg(F.count(F.lit(1)).alias("n_failures"))
        .select(F.lit("unique_transaction_id_unique").alias("check_name"), "n_failures"),
        D.unique(s, "transaction_id").agg(F.count(F.lit(1)).alias("n_failures"))
        .select(F.lit("transaction_id_unique").alias("check_name"), "n_failures"),
    ]
    out = rows
    for u in uniq:
        out = out.unionByName(u)
    sev = F.when(F.col("check_name") == "unique_transaction_id_unique", "error").otherwise("warn")
    return out.select("check_name", "n_failures", sev.alias("severity")).withColumn(
        "status", F.when(F.col("n_failures") == 0, "pass").otherwise("fail"))


@query("dq_summary", QT.STG + ",\nsumm AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, (SELECT count(*) FROM ({q}) x) AS n_failures, '{sev}' AS severity"
    for n, sev, q in _SUMMARY_PARTS) + """)
SELECT *, CASE WHEN n_failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM summ""")
def dq_summary(spark, sf_dir):
    return _txn_summary(QT._stg(spark, sf_dir))


ORDERS = "WITH " + Q.SRC_ORDERS.strip()


@query("dq_row_rule", ORDERS + """,
moved AS (SELECT * REPLACE (CASE WHEN order_id % 13 = 0 THEN shipped_at - INTERVAL 1 DAY ELSE delivered_at END AS delivered_at)
          FROM src_orders)
SELECT order_id, 'delivered_after_shipped' AS rule FROM moved WHERE NOT coalesce(delivered_at >= shipped_at, FALSE)""")
def dq_row_rule(spark, sf_dir):
    early = F.timestamp_add("DAY", F.lit(-1), F.col("shipped_at"))
    moved = fx.orders(spark, sf_dir).withColumn(
        "delivered_at", F.when(F.col("order_id") % 13 == 0, early).otherwise(F.col("delivered_at")))
    return D.row_rule(moved, "order_id", F.col("delivered_at") >= F.col("shipped_at"), "delivered_after_shipped")


@query("dq_cross_table_dates", ORDERS + ",\n" + Q.SRC_USERS.strip() + """,
moved AS (SELECT order_id, user_id,
                 CAST(CASE WHEN order_id % 13 = 0 THEN created_at - INTERVAL 4000 DAY ELSE created_at END AS DATE) AS created_date
          FROM src_orders)
SELECT m.order_id, m.user_id, m.created_date, u.registration_date
FROM moved m JOIN src_users u ON m.user_id = u.user_id WHERE m.created_date < u.registration_date""")
def dq_cross_table_dates(spark, sf_dir):
    early = F.timestamp_add("DAY", F.lit(-4000), F.col("created_at"))
    moved = fx.orders(spark, sf_dir, with_items=False).select("order_id", "user_id", F.to_date(
        F.when(F.col("order_id") % 13 == 0, early).otherwise(F.col("created_at"))).alias("created_date"))
    u = fx.users(spark, sf_dir).select("user_id", "registration_date")
    return moved.join(u, "user_id").filter(F.col("created_date") < F.col("registration_date")).select(
        "order_id", "user_id", "created_date", "registration_date"
    )


@query("dq_key_preservation", ORDERS + """,
completed AS (SELECT order_id FROM src_orders WHERE status = 'Complete'),
kept AS (SELECT order_id FROM completed WHERE order_id % 13 <> 0
         UNION ALL SELECT -order_id FROM completed WHERE order_id % 17 = 0)
SELECT order_id, 'missing_in_output' AS issue FROM completed WHERE order_id NOT IN (SELECT order_id FROM kept)
UNION ALL SELECT order_id, 'not_in_source' FROM kept WHERE order_id NOT IN (SELECT order_id FROM completed)""")
def dq_key_preservation(spark, sf_dir):
    key = F.col("order_id")
    completed = fx.orders(spark, sf_dir, with_items=False).filter(F.col("status") == "Complete").select(key)
    kept = completed.filter(key % 13 != 0).unionByName(completed.filter(key % 17 == 0).select((-key).alias("order_id")))
    return D.key_preservation(completed, kept, "order_id")


REVENUE_TOLERANCE = "1.00"


@query("dq_revenue_consistency", f"""
WITH lines AS (
  SELECT l_orderkey, sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(18,2))) AS line_total
  FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS order_total, CAST(line_total AS DECIMAL(18,2)) AS line_total,
       CAST(abs(CAST(o_totalprice AS DECIMAL(18,2)) - line_total) AS DECIMAL(18,2)) AS abs_diff
FROM orders JOIN lines ON o_orderkey = l_orderkey
WHERE abs(CAST(o_totalprice AS DECIMAL(18,2)) - line_total) > {REVENUE_TOLERANCE}""")
def dq_revenue_consistency(spark, sf_dir):
    from decimal import Decimal

    li = load(spark, sf_dir, "lineitem")
    lines = li.groupBy("l_orderkey").agg(
        F.sum(fx.net_price(F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")))
        .alias("line_total")
    )
    o = load(spark, sf_dir, "orders")
    j = o.join(lines, o.o_orderkey == lines.l_orderkey)
    total = F.col("o_totalprice").cast("decimal(18,2)")
    diff = F.abs(total - F.col("line_total"))
    return j.filter(diff > F.lit(Decimal(REVENUE_TOLERANCE))).select(
        F.col("o_orderkey").alias("order_id"), total.alias("order_total"),
        F.col("line_total").cast("decimal(18,2)").alias("line_total"), diff.cast("decimal(18,2)").alias("abs_diff"),
    )
