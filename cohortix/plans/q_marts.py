"""Catalog: customer, feature and fact marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortix.operators import experiments as X
from cohortix.operators import marts as M
from cohortix.operators import sketches as S
from cohortix.plans import q_enrich as QE
from cohortix.plans import q_experiments as QX
from cohortix.plans import sqlfrag as Q
from cohortix.plans.registry import query
from cohortix.sources import fixtures as fx
from cohortix.sources.tables import load

MART_AS_OF = "2001-08-02"
CUTOFF = "2000-01-01"
TOP_SINCE = "2000-01-01"
TOP_K = 1000


def _items(spark, sf_dir):
    return fx.order_items(spark, sf_dir)


def _metrics(spark, sf_dir):
    return M.customer_metrics(_items(spark, sf_dir), MART_AS_OF)


def _c360(spark, sf_dir):
    return M.customer_360(fx.users(spark, sf_dir), _metrics(spark, sf_dir))


BASE = "WITH " + Q.SRC_ITEMS.strip() + ",\n" + Q.SRC_USERS.strip() + f""",
metrics AS (
  SELECT user_id, count(DISTINCT order_id) AS lifetime_orders, CAST(sum(sale_price) AS DECIMAL(18,2)) AS lifetime_value,
         CAST(CAST(sum(sale_price) AS DECIMAL(18,2)) AS DOUBLE) / count(DISTINCT order_id) AS avg_order_value,
         CAST(min(created_at) AS DATE) AS first_order_date, CAST(max(created_at) AS DATE) AS last_order_date,
         CAST(date_diff('day', CAST(max(created_at) AS DATE), DATE '{MART_AS_OF}') AS INTEGER) AS days_since_last_order,
         count(DISTINCT category) AS categories_purchased, count(DISTINCT brand) AS brands_purchased,
         count(*) / count(DISTINCT order_id) AS avg_items_per_order
  FROM src_items WHERE status = 'Complete' GROUP BY user_id),
c360 AS (
  SELECT u.user_id, u.full_name,
         CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
              WHEN age < 55 THEN '45-54' ELSE '55+' END AS age_segment,
         u.country, u.acquisition_channel, u.registration_date,
         coalesce(m.lifetime_orders, 0) AS lifetime_orders,
         coalesce(m.lifetime_value, CAST(0 AS DECIMAL(18,2))) AS lifetime_value,
         m.avg_order_value, m.days_since_last_order,
         coalesce(m.categories_purchased, 0) AS categories_purchased,
         coalesce(m.brands_purchased, 0) AS brands_purchased, m.avg_items_per_order
  FROM src_users u LEFT JOIN metrics m ON u.user_id = m.user_id),
segs AS (
  SELECT *, CASE WHEN lifetime_orders >= 10 THEN 'VIP Customer' WHEN lifetime_orders >= 5 THEN 'Regular Customer'
                 WHEN lifetime_orders >= 2 THEN 'Occasional Buyer' WHEN lifetime_orders = 1 THEN 'One-Time Buyer'
                 ELSE 'Prospect' END AS customer_segment,
            CASE WHEN days_since_last_order IS NULL THEN 'Never Purchased' WHEN days_since_last_order <= 90 THEN 'Active'
                 WHEN days_since_last_order <= 180 THEN 'At Risk' WHEN days_since_last_order <= 365 THEN 'Dormant'
                 ELSE 'Lost' END AS lifecycle_stage
  FROM c360)"""


@query("customer_metrics", BASE + "\nSELECT * FROM metrics")
def customer_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@query("customer_360", BASE + "\nSELECT * FROM c360")
def customer_360(spark, sf_dir):
    return _c360(spark, sf_dir)


@query("customer_segments", BASE + "\nSELECT * FROM segs")
def customer_segments(spark, sf_dir):
    return M.customer_segments(_c360(spark, sf_dir))


@query("segment_summary", BASE + """
SELECT customer_segment, count(*) AS customers, CAST(sum(lifetime_value) AS DOUBLE) / count(*) AS avg_ltv,
       CAST(sum(lifetime_value) AS DECIMAL(18,2)) AS total_ltv
FROM segs GROUP BY customer_segment""")
def segment_summary(spark, sf_dir):
    return M.segment_summary(M.customer_segments(_c360(spark, sf_dir)))


@query("top_revenue_users", "WITH " + Q.SRC_ITEMS.strip() + f"""
SELECT user_id, count(*) AS total_orders, CAST(sum(sale_price) AS DECIMAL(18,2)) AS total_revenue
FROM src_items WHERE created_at >= TIMESTAMP '{TOP_SINCE}' AND status = 'Complete'
GROUP BY user_id ORDER BY total_revenue DESC, user_id LIMIT {TOP_K}""")
def top_revenue_users(spark, sf_dir):
    return M.top_revenue_users(_items(spark, sf_dir), TOP_SINCE, TOP_K)


LTV = QE.TICKETS + ",\n" + Q.SRC_ITEMS.strip() + "," + QX._programme_sql() + f""",
hist AS (SELECT * FROM src_items WHERE status = 'Complete' AND created_at < TIMESTAMP '{CUTOFF}'),
base AS (SELECT user_id, max(created_at) AS _last, min(created_at) AS _first, count(DISTINCT order_id) AS frequency,
                sum(sale_price) AS _value, count(DISTINCT category) AS categories_purchased FROM hist GROUP BY user_id),
perq AS (SELECT user_id, CAST(quarter(created_at) AS INTEGER) AS q, count(*) AS n FROM src_orders
         WHERE status = 'Complete' AND created_at < TIMESTAMP '{CUTOFF}' GROUP BY ALL),
season AS (SELECT user_id, arg_max(q, (n, -q)) AS seasonal_purchase_pattern FROM perq GROUP BY user_id),
exps AS (SELECT user_id, count(*) AS experiments_participated FROM multi GROUP BY user_id),
tks AS (SELECT user_id, count(*) AS _tickets FROM tickets GROUP BY user_id),
target AS (SELECT user_id, sum(sale_price) AS _target FROM src_items WHERE status = 'Complete'
           AND created_at >= TIMESTAMP '{CUTOFF}' AND created_at < TIMESTAMP '{CUTOFF}' + INTERVAL 90 DAY GROUP BY user_id),
ltv AS (
  SELECT b.user_id, CAST(date_diff('day', CAST(_last AS DATE), DATE '{CUTOFF}') AS INTEGER) AS recency, frequency,
         CAST(_value AS DOUBLE) / frequency AS monetary, categories_purchased,
         CASE WHEN frequency > 1 THEN date_diff('day', CAST(_first AS DATE), CAST(_last AS DATE)) / (frequency - 1) END
           AS avg_days_between_orders,
         seasonal_purchase_pattern, coalesce(experiments_participated, 0) AS experiments_participated,
         coalesce(_tickets, 0) / frequency AS support_ticket_ratio,
         CAST(coalesce(_target, 0) AS DECIMAL(18,2)) AS target_90d_revenue
  FROM base b LEFT JOIN season s ON b.user_id = s.user_id LEFT JOIN exps e ON b.user_id = e.user_id
  LEFT JOIN tks t ON b.user_id = t.user_id LEFT JOIN target g ON b.user_id = g.user_id)"""


def _ltv(spark, sf_dir):
    users = fx.users(spark, sf_dir)
    return M.ltv_features(
        _items(spark, sf_dir), fx.orders(spark, sf_dir, with_items=False), X.multi_experiment_assign(users),
        QE._tickets(spark, sf_dir), CUTOFF,
    )


@query("ltv_features", LTV + "\nSELECT * FROM ltv")
def ltv_features(spark, sf_dir):
    return _ltv(spark, sf_dir)


@query("churn_features", LTV + f""",
after AS (SELECT user_id, count(*) AS n FROM src_orders WHERE status = 'Complete' AND created_at >= TIMESTAMP '{CUTOFF}'
          AND created_at < TIMESTAMP '{CUTOFF}' + INTERVAL 180 DAY GROUP BY user_id)
SELECT l.* EXCLUDE (target_90d_revenue), coalesce(a.n, 0) = 0 AS churned
FROM ltv l LEFT JOIN after a ON l.user_id = a.user_id""")
def churn_features(spark, sf_dir):
    return M.churn_features(_ltv(spark, sf_dir), fx.orders(spark, sf_dir, with_items=False), CUTOFF)


@query("fact_orders", "WITH " + Q.SRC_ORDERS.strip() + ",\n" + Q.SRC_ITEMS.strip() + """,
per AS (SELECT order_id, CAST(sum(sale_price) AS DECIMAL(18,2)) AS order_revenue, count(DISTINCT product_id) AS n_products
        FROM src_items GROUP BY order_id)
SELECT o.order_id, o.user_id, o.status, o.created_at, o.shipped_at, o.delivered_at, o.num_of_item,
       coalesce(p.order_revenue, CAST(0 AS DECIMAL(18,2))) AS order_revenue, coalesce(p.n_products, 0) AS n_products
FROM src_orders o LEFT JOIN per p ON o.order_id = p.order_id""")
def fact_orders(spark, sf_dir):
    return M.fact_orders(fx.orders(spark, sf_dir), _items(spark, sf_dir))


@query("dim_products", """
WITH sales AS (
  SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS units_sold,
         CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS revenue,
         count(DISTINCT l_orderkey) AS n_orders
  FROM lineitem GROUP BY l_partkey)
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS brand, p_type AS category, p_size AS size,
       CAST(p_retailprice AS DECIMAL(18,2)) AS retail_price, coalesce(units_sold, 0) AS units_sold,
       coalesce(revenue, CAST(0 AS DECIMAL(18,2))) AS revenue, coalesce(n_orders, 0) AS n_orders
FROM part LEFT JOIN sales ON p_partkey = l_partkey""")
def dim_products(spark, sf_dir):
    return M.dim_products(load(spark, sf_dir, "part"), load(spark, sf_dir, "lineitem"))


@query("fact_events", """
SELECT event_id, user_id, ts AS event_ts, CAST(ts AS DATE) AS event_date, event_type,
       CAST(value AS DECIMAL(12,2)) AS value, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       event_type = 'purchase' AS is_conversion
FROM events""")
def fact_events(spark, sf_dir):
    return M.fact_events(load(spark, sf_dir, "events"))


@query("active_user_sketch", """
SELECT event_type, count(DISTINCT CAST(ts AS DATE)) AS n_days, count(*) AS n_events, count(DISTINCT user_id) AS users,
       TRUE AS within_error
FROM events GROUP BY event_type""")
def active_user_sketch(spark, sf_dir):
    """Users of each event type merged from sketches of its days, held against
    the exact count."""
    events = load(spark, sf_dir, "events")
    days = S.distinct_sketches(events.withColumn("day", F.to_date("ts")), ["event_type", "day"], "user_id")
    merged = S.merge_sketches(days, ["event_type"]).select("event_type", "n_rows", S.estimate().alias("estimate"))
    users = events.groupBy("event_type", "user_id").agg(F.lit(1).alias("one"))
    exact = users.groupBy(F.col("event_type").alias("of")).agg(F.count("user_id").alias("users"))
    n_days = days.groupBy(F.col("event_type").alias("on")).agg(F.count("day").alias("n_days"))
    both = merged.join(exact, F.col("event_type").eqNullSafe(F.col("of"))).join(n_days, F.col("event_type").eqNullSafe(F.col("on")))
    near = F.abs(F.col("estimate") - F.col("users")) <= F.greatest(F.lit(1.0), S.relative_error() * F.col("users"))
    return both.select("event_type", "n_days", F.col("n_rows").alias("n_events"), "users", near.alias("within_error"))


@query("order_enrichment", QE.LOGISTICS + """
SELECT o.*, l.warehouse_id, l.warehouse_location, l.warehouse_region, l.shipping_carrier, l.package_type,
       l.shipping_cost, l.processing_days, l.transit_days, l.total_delivery_days, l.tracking_number,
       l.insurance_cost, l.is_expedited, l.delivery_instructions
FROM src_orders o LEFT JOIN logistics l ON o.order_id = l.order_id""")
def order_enrichment(spark, sf_dir):
    return M.order_enrichment(fx.orders(spark, sf_dir), QE._logistics(spark, sf_dir))


@query("experiment_exposure", Q.experiment_flow(QX.CFG, "assignments") + f""",
inwin AS (SELECT user_id, min(created_at) AS first_exposure_at, count(*) AS orders_in_window FROM src_orders
          WHERE {Q.between('created_at', QX.W.experiment_start, QX.W.experiment_end)} GROUP BY user_id)
SELECT a.assignment_id, CAST(a.object_identifier AS BIGINT) AS user_id, a.experiment_name, a.variant,
       a.variant_description, i.first_exposure_at, coalesce(i.orders_in_window, 0) AS orders_in_window
FROM asg a LEFT JOIN inwin i ON CAST(a.object_identifier AS BIGINT) = i.user_id""")
def experiment_exposure(spark, sf_dir):
    return M.experiment_exposure(QX._flow(spark, sf_dir, "assignments"), fx.orders(spark, sf_dir, with_items=False),
                                 QX.W.experiment_start, QX.W.experiment_end)
