"""Documented marts: customer metrics / 360 / segments, LTV and churn features,
order and event facts, product dimension, order enrichment, experiment
exposure.  All are keyed aggregates joined on their key; no per-user window
is needed (the average gap between orders telescopes to
(last - first) / (n - 1)), so a user holding a large share of rows never has
to fit in one task: partial aggregation combines it map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.functions.dates import in_window, ts_lit


def user_totals(items: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Per user: orders, value, items, first and last time, and how many values
    each column of ``kinds`` (column -> name) takes.

    Orders are counted as rows of the (user, order) grain; several distinct counts
    in one aggregate would multiply the rows by their number.  The columns of
    ``kinds`` are attributes of the product dimension: a user's set holds at most
    its values and is combined map-side, also for a user with a third of all rows."""
    per_order = items.groupBy("user_id", "order_id").agg(
        F.sum("sale_price").alias("value"), F.count(F.lit(1)).alias("items"),
        F.min("created_at").alias("first_at"), F.max("created_at").alias("last_at"),
    )
    totals = per_order.groupBy("user_id").agg(
        F.count("order_id").alias("n_orders"), F.sum("value").cast("decimal(18,2)").alias("value"),
        F.sum("items").alias("n_items"), F.min("first_at").alias("first_at"), F.max("last_at").alias("last_at"),
    )
    sets = items.groupBy(F.col("user_id").alias("_user")).agg(
        *[F.size(F.collect_set(c)).cast("bigint").alias(name) for c, name in kinds.items()]
    )
    return totals.join(sets, totals["user_id"].eqNullSafe(sets["_user"])).drop("_user")


def customer_metrics(items: DataFrame, as_of: str) -> DataFrame:
    """Per user over completed order items (the shared intermediate)."""
    it = items.filter(F.col("status") == "Complete")
    agg = user_totals(it, {"category": "categories_purchased", "brand": "brands_purchased"}).withColumnsRenamed({
        "n_orders": "lifetime_orders", "value": "lifetime_value", "n_items": "lifetime_items",
        "first_at": "first_order_at", "last_at": "last_order_at",
    })
    return agg.select(
        "user_id", "lifetime_orders", "lifetime_value",
        (F.col("lifetime_value").cast("double") / F.col("lifetime_orders")).alias("avg_order_value"),
        F.to_date("first_order_at").alias("first_order_date"),
        F.to_date("last_order_at").alias("last_order_date"),
        F.datediff(F.to_date(F.lit(as_of)), F.to_date("last_order_at")).alias("days_since_last_order"),
        "categories_purchased", "brands_purchased",
        (F.col("lifetime_items") / F.col("lifetime_orders")).alias("avg_items_per_order"),
    )


def age_segment(age: F.Column) -> F.Column:
    return (F.when(age < 25, "18-24").when(age < 35, "25-34").when(age < 45, "35-44")
            .when(age < 55, "45-54").otherwise("55+"))


def customer_360(users: DataFrame, metrics: DataFrame) -> DataFrame:
    j = users.join(metrics, "user_id", "left")
    return j.select(
        "user_id", "full_name", age_segment(F.col("age")).alias("age_segment"), "country",
        "acquisition_channel", "registration_date",
        F.coalesce("lifetime_orders", F.lit(0)).alias("lifetime_orders"),
        F.coalesce("lifetime_value", F.lit(0).cast("decimal(18,2)")).alias("lifetime_value"),
        "avg_order_value", "days_since_last_order",
        F.coalesce("categories_purchased", F.lit(0)).alias("categories_purchased"),
        F.coalesce("brands_purchased", F.lit(0)).alias("brands_purchased"),
        "avg_items_per_order",
    )


def customer_segment(orders: F.Column) -> F.Column:
    return (F.when(orders >= 10, "VIP Customer").when(orders >= 5, "Regular Customer")
            .when(orders >= 2, "Occasional Buyer").when(orders == 1, "One-Time Buyer").otherwise("Prospect"))


def lifecycle_stage(days: F.Column) -> F.Column:
    return (F.when(days.isNull(), "Never Purchased").when(days <= 90, "Active").when(days <= 180, "At Risk")
            .when(days <= 365, "Dormant").otherwise("Lost"))


def customer_segments(c360: DataFrame) -> DataFrame:
    return c360.withColumn("customer_segment", customer_segment(F.col("lifetime_orders"))).withColumn(
        "lifecycle_stage", lifecycle_stage(F.col("days_since_last_order"))
    )


def segment_summary(segments: DataFrame) -> DataFrame:
    return segments.groupBy("customer_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        (F.sum("lifetime_value").cast("double") / F.count(F.lit(1))).alias("avg_ltv"),
        F.sum("lifetime_value").cast("decimal(18,2)").alias("total_ltv"),
    )


def top_revenue_users(items: DataFrame, since: str, k: int = 1000) -> DataFrame:
    """Revenue per user with the date + status filter, top k (k is the
    report size; the plan is a bounded TakeOrderedAndProject)."""
    f = items.filter((F.col("created_at") >= ts_lit(since)) & (F.col("status") == "Complete"))
    agg = f.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("sale_price").cast("decimal(18,2)").alias("total_revenue"),
    )
    return agg.orderBy(F.col("total_revenue").desc(), F.col("user_id")).limit(k)


def ltv_features(items: DataFrame, orders: DataFrame, assignments: DataFrame, tickets: DataFrame,
                 cutoff: str, horizon_days: int = 90) -> DataFrame:
    """Point-in-time features before ``cutoff`` and the revenue target in
    [cutoff, cutoff + horizon)."""
    c = ts_lit(cutoff)
    done = items.filter(F.col("status") == "Complete")
    hist = done.filter(F.col("created_at") < c)
    base = user_totals(hist, {"category": "categories_purchased"}).withColumnsRenamed({
        "n_orders": "frequency", "value": "_value", "first_at": "_first", "last_at": "_last",
    })
    o = orders.filter((F.col("status") == "Complete") & (F.col("created_at") < c))
    per_q = o.groupBy("user_id", F.quarter("created_at").alias("q")).agg(F.count(F.lit(1)).alias("n"))
    season = per_q.groupBy("user_id").agg(
        F.max_by("q", F.struct(F.col("n"), -F.col("q"))).alias("seasonal_purchase_pattern")
    )
    exps = assignments.groupBy("user_id").agg(F.count(F.lit(1)).alias("experiments_participated"))
    tks = tickets.groupBy("user_id").agg(F.count(F.lit(1)).alias("_tickets"))
    end = F.timestamp_add("DAY", F.lit(horizon_days), c)
    target = done.filter((F.col("created_at") >= c) & (F.col("created_at") < end)).groupBy("user_id").agg(
        F.sum("sale_price").alias("_target")
    )
    j = (base.join(season, "user_id", "left").join(exps, "user_id", "left").join(tks, "user_id", "left")
         .join(target, "user_id", "left"))
    gap_days = F.datediff(F.to_date("_last"), F.to_date("_first"))
    return j.select(
        "user_id",
        F.datediff(F.to_date(c), F.to_date("_last")).alias("recency"),
        "frequency",
        (F.col("_value").cast("double") / F.col("frequency")).alias("monetary"),
        "categories_purchased",
        F.when(F.col("frequency") > 1, gap_days / (F.col("frequency") - 1)).alias("avg_days_between_orders"),
        "seasonal_purchase_pattern",
        F.coalesce("experiments_participated", F.lit(0)).alias("experiments_participated"),
        (F.coalesce("_tickets", F.lit(0)) / F.col("frequency")).alias("support_ticket_ratio"),
        F.coalesce("_target", F.lit(0)).cast("decimal(18,2)").alias("target_90d_revenue"),
    )


def churn_features(ltv: DataFrame, orders: DataFrame, cutoff: str, churn_days: int = 180) -> DataFrame:
    """LTV features at the cutoff + churned label: no completed order in
    [cutoff, cutoff + churn_days)."""
    c = ts_lit(cutoff)
    after = orders.filter(
        (F.col("status") == "Complete") & (F.col("created_at") >= c)
        & (F.col("created_at") < F.timestamp_add("DAY", F.lit(churn_days), c))
    ).groupBy("user_id").agg(F.count(F.lit(1)).alias("_n_after"))
    return ltv.drop("target_90d_revenue").join(after, "user_id", "left").withColumn(
        "churned", F.coalesce(F.col("_n_after"), F.lit(0)) == 0
    ).drop("_n_after")


def fact_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    per = items.groupBy("order_id").agg(
        F.sum("sale_price").cast("decimal(18,2)").alias("order_revenue"),
        F.countDistinct("product_id").alias("n_products"),
    )
    return orders.join(per, "order_id", "left").select(
        "order_id", "user_id", "status", "created_at", "shipped_at", "delivered_at", "num_of_item",
        F.coalesce("order_revenue", F.lit(0).cast("decimal(18,2)")).alias("order_revenue"),
        F.coalesce("n_products", F.lit(0)).alias("n_products"),
    )


def dim_products(part: DataFrame, lineitem: DataFrame) -> DataFrame:
    from cohortix.sources.fixtures import net_price

    sales = lineitem.groupBy("l_partkey").agg(
        F.sum("l_quantity").cast("bigint").alias("units_sold"),
        F.sum(net_price(F.col("l_extendedprice"), F.col("l_discount"))).cast("decimal(18,2)").alias("revenue"),
        F.countDistinct("l_orderkey").alias("n_orders"),
    )
    return part.join(sales, part.p_partkey == sales.l_partkey, "left").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"), F.col("p_type").alias("category"), F.col("p_size").alias("size"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("retail_price"),
        F.coalesce("units_sold", F.lit(0).cast("bigint")).alias("units_sold"),
        F.coalesce("revenue", F.lit(0).cast("decimal(18,2)")).alias("revenue"),
        F.coalesce("n_orders", F.lit(0).cast("bigint")).alias("n_orders"),
    )


def fact_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "user_id", F.col("ts").alias("event_ts"), F.to_date("ts").alias("event_date"), "event_type",
        F.col("value").cast("decimal(12,2)").alias("value"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        (F.col("event_type") == "purchase").alias("is_conversion"),
    )


def order_enrichment(orders: DataFrame, logistics: DataFrame) -> DataFrame:
    lg = logistics.drop("user_id")
    return orders.join(lg, "order_id", "left")


def experiment_exposure(assignments: DataFrame, orders: DataFrame, start: str, end: str) -> DataFrame:
    """Assignments joined to their first order inside the experiment window."""
    inwin = orders.filter(in_window("created_at", start, end)).groupBy("user_id").agg(
        F.min("created_at").alias("first_exposure_at"), F.count(F.lit(1)).alias("orders_in_window")
    )
    a = assignments.select(
        "assignment_id", F.col("object_identifier").cast("bigint").alias("user_id"), "experiment_name", "variant",
        "variant_description",
    )
    return a.join(inwin, "user_id", "left").select(
        "assignment_id", "user_id", "experiment_name", "variant", "variant_description", "first_exposure_at",
        F.coalesce("orders_in_window", F.lit(0)).alias("orders_in_window"),
    )
