"""Deterministic enrichments: order logistics and support tickets.

Every draw is ``bucket(seed_salt_key)`` so a row's values depend only on its
key: re-running a task after executor loss reproduces the same rows, and the
same values can be computed in SQL.  Distributions, value tables and formulas
are the source system's (see ``cohortix.params``); small value tables are
joined as broadcast dimensions (fixed size, a handful of rows).
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.functions.hashing import bucket, choice, randint, uniform_decimal
from cohortix.params import (
    AGENTS,
    CARRIER_MULTIPLIER,
    CARRIERS,
    CHANNELS,
    DELIVERY_INSTRUCTIONS,
    ISSUE_CATEGORIES,
    PACKAGE_BASE_COST,
    PRIORITIES,
    PRIORITY_BY_CATEGORY,
    RESOLUTION_BASE_HOURS,
    RESOLUTION_PRIORITY_MULT,
    RESPONSE_BASE_MINUTES,
    RESPONSE_PRIORITY_MULT,
    SATISFACTION_BY_STATUS,
    TICKET_DESCRIPTIONS,
    TICKET_STATUSES,
    TICKETS_PER_USER,
    TRACKING_PATTERN,
    WAREHOUSES,
)

LETTERS = string.ascii_letters


def draw(key: F.Column, salt: str, seed: int = 42) -> F.Column:
    return bucket(F.lit(f"{seed}_{salt}_"), key)


# ---------------------------------------------------------------------------
# Dimension tables
# ---------------------------------------------------------------------------

def warehouse_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(WAREHOUSES), "warehouse_id string, warehouse_location string, warehouse_region string")


def package_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(p, c) for p, c in PACKAGE_BASE_COST], "package_type string, base_cost string") \
        .select("package_type", F.col("base_cost").cast("decimal(6,2)").alias("base_cost"))


def carrier_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, m) for c, m in CARRIER_MULTIPLIER], "shipping_carrier string, multiplier string") \
        .select("shipping_carrier", F.col("multiplier").cast("decimal(4,2)").alias("carrier_multiplier"))


# ---------------------------------------------------------------------------
# Logistics per order
# ---------------------------------------------------------------------------

def package_type(n_items: F.Column, b: F.Column) -> F.Column:
    return (
        F.when(n_items == 1, choice(b, ["envelope", "small_box"]))
        .when(n_items <= 3, choice(b, ["small_box", "medium_box"]))
        .when(n_items <= 6, choice(b, ["medium_box", "large_box"]))
        .otherwise(F.lit("oversized"))
    )


def tracking_number(h: F.Column, pattern: str = TRACKING_PATTERN) -> F.Column:
    """'#' -> digit, '?' -> ASCII letter, taken from the md5 hex ``h`` of the
    key (pass a column so the hash is computed once per row)."""
    parts, li = [], 0
    for i, ch in enumerate(pattern):
        if ch == "#":
            parts.append((F.conv(F.substring(h, i + 1, 1), 16, 10).cast("int") % 10).cast("string"))
        elif ch == "?":
            idx = F.conv(F.substring(h, 17 + 2 * li, 2), 16, 10).cast("int") % len(LETTERS)
            parts.append(F.substring(F.lit(LETTERS), idx + 1, 1))
            li += 1
        else:
            parts.append(F.lit(ch))
    return F.concat(*parts)


LOGISTICS_SALTS = ("warehouse", "carrier", "package", "cost_jitter", "processing", "transit", "insurance",
                   "expedite", "instructions")


def with_draws(df: DataFrame, key: F.Column, salts, seed: int = 42) -> DataFrame:
    """One projection computing every draw of a row once (``_b_<salt>``);
    later expressions read the columns instead of re-hashing."""
    return df.select("*", *[draw(key, s, seed).alias(f"_b_{s}") for s in salts])


def order_logistics(spark: SparkSession, orders: DataFrame, seed: int = 42) -> DataFrame:
    """One logistics row per order."""
    k = F.col("order_id")
    d = with_draws(orders.select("order_id", "user_id", "num_of_item"), k, LOGISTICS_SALTS, seed).withColumn(
        "_th", F.md5(F.concat(F.lit(f"{seed}_tracking_"), k.cast("string")))
    )

    def b(s):
        return F.col(f"_b_{s}")

    base = d.select(
        "order_id", "user_id",
        choice(b("warehouse"), [w[0] for w in WAREHOUSES]).alias("warehouse_id"),
        choice(b("carrier"), list(CARRIERS)).alias("shipping_carrier"),
        package_type(F.col("num_of_item"), b("package")).alias("package_type"),
        uniform_decimal(b("cost_jitter"), "-2", "2").alias("_jitter"),
        randint(b("processing"), 1, 3).alias("processing_days"),
        randint(b("transit"), 1, 7).alias("transit_days"),
        tracking_number(F.col("_th")).alias("tracking_number"),
        F.bround(uniform_decimal(b("insurance"), "0", "5"), 2).cast("decimal(10,2)").alias("insurance_cost"),
        (b("expedite") < 150_000).alias("is_expedited"),
        choice(b("instructions"), list(DELIVERY_INSTRUCTIONS)).alias("delivery_instructions"),
    )
    j = (
        base.join(F.broadcast(warehouse_dim(spark)), "warehouse_id")
        .join(F.broadcast(package_dim(spark)), "package_type")
        .join(F.broadcast(carrier_dim(spark)), "shipping_carrier")
    )
    cost = F.bround(F.col("base_cost") * F.col("carrier_multiplier") + F.col("_jitter"), 2)
    return j.select(
        "order_id", "user_id", "warehouse_id", "warehouse_location", "warehouse_region", "shipping_carrier",
        "package_type",
        F.greatest(F.lit(0).cast("decimal(10,2)"), cost).cast("decimal(10,2)").alias("shipping_cost"),
        "processing_days", "transit_days",
        (F.col("processing_days") + F.col("transit_days")).alias("total_delivery_days"),
        "tracking_number", "insurance_cost", "is_expedited", "delivery_instructions",
    )


def shipping_cost(spark: SparkSession, orders: DataFrame, seed: int = 42) -> DataFrame:
    lg = order_logistics(spark, orders, seed)
    return lg.join(F.broadcast(package_dim(spark)), "package_type").join(
        F.broadcast(carrier_dim(spark)), "shipping_carrier"
    ).select("order_id", "package_type", "shipping_carrier", "base_cost", "carrier_multiplier", "shipping_cost")


# ---------------------------------------------------------------------------
# Support tickets
# ---------------------------------------------------------------------------

def contact_cohort(users: DataFrame, fraction: float = 0.25, seed: int = 42) -> DataFrame:
    """The users who contact support: hash bucket below the fraction."""
    return users.filter(draw(F.col("user_id"), "contact", seed) < int(fraction * 1_000_000))


def ticket_fanout(users: DataFrame, seed: int = 42) -> DataFrame:
    """1-4 tickets per contacting user (weights 0.5 / 0.3 / 0.15 / 0.05)."""
    n = choice(draw(F.col("user_id"), "n_tickets", seed), [v for v, _ in TICKETS_PER_USER],
               [w for _, w in TICKETS_PER_USER])
    c = contact_cohort(users, seed=seed).select("user_id", "registration_date", n.alias("n_tickets"))
    return c.select("user_id", "registration_date", "n_tickets",
                    F.explode(F.sequence(F.lit(1), F.col("n_tickets"))).alias("ticket_num"))


def _conditional_choice(cond_col: F.Column, b: F.Column, table: dict, default) -> F.Column:
    expr = None
    for key, opts in table.items():
        vals, ws = [v for v, _ in opts], [w for _, w in opts]
        c = choice(b, vals, ws)
        expr = F.when(cond_col == key, c) if expr is None else expr.when(cond_col == key, c)
    d = choice(b, [v for v, _ in default], [w for _, w in default])
    return d if expr is None else expr.otherwise(d)


def _dim(spark, rows, schema):
    return F.broadcast(spark.createDataFrame(rows, schema))


TICKET_SALTS = ("created", "category", "status", "agent", "channel", "escalated", "follow_up", "description",
                "resolution", "response", "satisfaction", "priority")


def support_tickets(spark: SparkSession, users: DataFrame, orders: DataFrame, as_of: str, seed: int = 42) -> DataFrame:
    fan = ticket_fanout(users, seed)
    tk = F.concat_ws("_", F.col("user_id").cast("string"), F.col("ticket_num").cast("string"))
    fan = with_draws(fan.withColumn("_tk", tk), F.col("_tk"), TICKET_SALTS, seed)

    def b(s):
        return F.col(f"_b_{s}")

    span = F.datediff(F.to_date(F.lit(as_of)), F.col("registration_date"))
    t = fan.select(
        "user_id", "ticket_num",
        F.concat(F.lit("TICK_"), F.upper(F.substring(F.md5(F.concat(F.lit(f"{seed}_ticket_"), F.col("_tk"))), 1, 12)))
        .alias("ticket_id"),
        F.date_add("registration_date", (b("created") % (F.greatest(span, F.lit(0)) + 1)).cast("int"))
        .alias("created_date"),
        choice(b("category"), [c for c, _ in ISSUE_CATEGORIES], [w for _, w in ISSUE_CATEGORIES]).alias("issue_category"),
        choice(b("status"), [s for s, _ in TICKET_STATUSES], [w for _, w in TICKET_STATUSES]).alias("status"),
        choice(b("agent"), list(AGENTS)).alias("assigned_agent"),
        choice(b("channel"), [c for c, _ in CHANNELS], [w for _, w in CHANNELS]).alias("contact_channel"),
        (b("escalated") < 150_000).alias("is_escalated"),
        (b("follow_up") < 250_000).alias("follow_up_required"),
        (b("description") % 4).cast("int").alias("_desc_idx"),
        uniform_decimal(b("resolution"), "0.7", "1.3").alias("_u_res"),
        uniform_decimal(b("response"), "0.5", "1.5").alias("_u_resp"),
        b("satisfaction").alias("_b_sat"),
        b("priority").alias("_b_pri"),
    )
    t = t.withColumn("priority", _conditional_choice(F.col("issue_category"), F.col("_b_pri"), PRIORITY_BY_CATEGORY,
                                                     PRIORITIES))
    t = t.withColumn("satisfaction_score", _conditional_choice(F.col("status"), F.col("_b_sat"),
                                                               SATISFACTION_BY_STATUS, ((3, 1.0),)).cast("int"))
    desc = _dim(spark, [(c, i, d) for c, ds in TICKET_DESCRIPTIONS.items() for i, d in enumerate(ds)],
                "issue_category string, _desc_idx int, ticket_description string")
    res = _dim(spark, [(c, h) for c, h in RESOLUTION_BASE_HOURS], "issue_category string, _res_base int")
    rmul = _dim(spark, list(RESOLUTION_PRIORITY_MULT), "priority string, _res_mult string")
    resp = _dim(spark, [(c, m) for c, m in RESPONSE_BASE_MINUTES], "contact_channel string, _resp_base int")
    pmul = _dim(spark, list(RESPONSE_PRIORITY_MULT), "priority string, _resp_mult string")
    n_orders = orders.groupBy("user_id").agg(F.count(F.lit(1)).alias("user_order_count"))
    j = (
        t.join(desc, ["issue_category", "_desc_idx"]).join(res, "issue_category").join(rmul, "priority")
        .join(resp, "contact_channel").join(pmul, "priority").join(n_orders, "user_id", "left")
    )
    open_like = F.col("status").isin("open", "in_progress")
    hours = F.bround(
        F.col("_res_base").cast("decimal(10,0)") * F.col("_res_mult").cast("decimal(3,1)") * F.col("_u_res"), 1
    ).cast("decimal(10,1)")
    hours = F.when(open_like, F.lit(None).cast("decimal(10,1)")).otherwise(hours)
    minutes = F.bround(
        F.col("_resp_base").cast("decimal(10,0)") * F.col("_resp_mult").cast("decimal(3,1)") * F.col("_u_resp"), 0
    )
    return j.select(
        "ticket_id", "user_id", "ticket_num", "created_date", "issue_category", "priority", "status",
        "assigned_agent", "contact_channel", "ticket_description",
        hours.alias("resolution_time_hours"),
        "satisfaction_score", "is_escalated", "follow_up_required",
        F.when(hours.isNull(), F.lit(None).cast("date"))
        .otherwise(F.date_add("created_date", F.floor(hours / 24).cast("int"))).alias("resolved_date"),
        F.greatest(F.lit(1), minutes.cast("int")).alias("first_response_time_minutes"),
        F.coalesce("user_order_count", F.lit(0)).alias("user_order_count"),
    )


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Counts and normalised shares of a column (window over the aggregate)."""
    from pyspark.sql import Window

    c = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
