"""Adapters from the supplied star-schema tables to the entities the
operators consume (users, orders, order items, raw transaction envelopes,
cached prediction-log records, ingestion ledger).

Each adapter is a lazy DataFrame; nothing is materialised.  The mapping rules
are documented in FIXTURES.md (section 3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.params import RUN_AT
from cohortix.sources.tables import load

STATUS_MAP = (("F", "Complete"), ("P", "Cancelled"), ("O", "Processing"))


def _status(col) -> F.Column:
    expr = None
    for code, name in STATUS_MAP:
        expr = F.when(col == code, name) if expr is None else expr.when(col == code, name)
    return expr


def _gender(user_id) -> F.Column:
    return F.when(user_id % 2 == 0, "M").otherwise("F")


def first_order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        load(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg(F.min("o_orderdate").alias("first_order_at"))
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """users: customer + nation + first order date as registration."""
    c = load(spark, sf_dir, "customer")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    first = first_order_dates(spark, sf_dir)
    return (
        c.join(n, c.c_nationkey == n.n_nationkey, "left")
        .join(first, c.c_custkey == first.user_id, "left")
        .select(
            F.col("c_custkey").alias("user_id"),
            F.concat(F.lower(F.regexp_replace("c_name", "#", "_")), F.lit("@example.com")).alias("email"),
            F.col("c_name").alias("full_name"),
            (F.lit(18) + F.col("c_custkey") % 60).cast("int").alias("age"),
            _gender(F.col("c_custkey")).alias("gender"),
            F.col("n_name").alias("country"),
            F.lower("c_mktsegment").alias("acquisition_channel"),
            F.to_date("first_order_at").alias("registration_date"),
        )
    )


def orders(spark: SparkSession, sf_dir: str, with_items: bool = True) -> DataFrame:
    """thelook-shaped orders.  Line items are pre-aggregated per order before
    the join (map-side partial aggregate, one row per order on the right)."""
    o = load(spark, sf_dir, "orders")
    base = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        _status(F.col("o_orderstatus")).alias("status"),
        _gender(F.col("o_custkey")).alias("gender"),
        F.col("o_orderdate").alias("created_at"),
    )
    if not with_items:
        return base
    li = (
        load(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count(F.lit(1)).cast("int").alias("num_of_item"),
            F.min("l_shipdate").alias("shipped_at"),
            F.max("l_shipdate").alias("delivered_at"),
        )
    )
    return base.join(li, base.order_id == li.l_orderkey, "left").select(
        "order_id", "user_id", "status", "gender", "num_of_item", "created_at", "shipped_at", "delivered_at"
    )


def net_price(extended, discount, tax=None) -> F.Column:
    """Line money in exact decimal arithmetic (inputs carry two decimals),
    rounded half-up to cents once at the end."""
    v = extended.cast("decimal(18,2)") * (F.lit(1) - discount.cast("decimal(4,2)"))
    if tax is not None:
        v = v * (F.lit(1) + tax.cast("decimal(4,2)"))
    return v.cast("decimal(18,2)")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order items: lineitem + order header + part attributes."""
    li = load(spark, sf_dir, "lineitem")
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    return (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(p, li.l_partkey == p.p_partkey, "left")
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            net_price(F.col("l_extendedprice"), F.col("l_discount")).alias("sale_price"),
            _status(F.col("o_orderstatus")).alias("status"),
            F.col("o_orderdate").alias("created_at"),
        )
    )


# ---------------------------------------------------------------------------
# Raw BNPL transactions.  JSON text is assembled field by field so that its
# exact bytes are defined (the SQL oracle builds the same text).
# ---------------------------------------------------------------------------

# (key, kind) in emitted order; kind: s = string, n = number, b = boolean.
TXN_FIELDS = (
    ("transaction_id", "s"), ("customer_id", "s"), ("product_id", "s"), ("_timestamp", "s"),
    ("amount", "n"), ("currency", "s"), ("status", "s"), ("risk_score", "n"), ("risk_level", "s"),
    ("will_default", "b"), ("device_is_trusted", "b"), ("customer_tenure_days", "n"),
    ("customer_age_bracket", "s"), ("customer_credit_score_range", "s"),
    ("customer_income_bracket", "s"), ("customer_state", "s"), ("payment_method_id", "s"),
    ("installment_count", "n"),
)

EVENT_STATUS = (("purchase", "completed"), ("view", "pending"), ("click", "pending"),
                ("error", "failed"), ("signup", "cancelled"))
AGE_BRACKETS = ("18-24", "25-34", "35-44", "45-54", "55+")
CREDIT_RANGES = ("poor", "fair", "good", "excellent")
INCOME_BRACKETS = ("under_25k", "25k_50k", "50k_100k", "over_100k")


def _pick(idx, values) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _txn_values(ev: DataFrame) -> dict:
    k = F.get_json_object("props", "$.k").cast("bigint")
    status = None
    for et, st in EVENT_STATUS:
        status = F.when(F.col("event_type") == et, st) if status is None else status.when(F.col("event_type") == et, st)
    return {
        "transaction_id": F.concat(F.lit("txn_"), F.lpad((F.col("event_id") % 1000).cast("string"), 8, "0")),
        "customer_id": F.concat(F.lit("cust_"), F.col("user_id").cast("string")),
        "product_id": F.concat(F.lit("prod_"), k.cast("string")),
        "_timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "amount": F.col("value").cast("decimal(12,2)").cast("string"),
        "currency": F.lit("USD"),
        "status": status,
        "risk_score": ((k % 100).cast("decimal(6,0)") / F.lit(100)).cast("decimal(4,2)").cast("string"),
        "risk_level": F.when(k % 100 < 20, "very_low").when(k % 100 < 40, "low").when(k % 100 < 60, "medium")
        .when(k % 100 < 80, "high").otherwise("very_high"),
        "will_default": F.when(k % 7 == 0, "true").otherwise("false"),
        "device_is_trusted": F.when(F.col("user_id") % 2 == 0, "true").otherwise("false"),
        "customer_tenure_days": (F.col("user_id") % 365).cast("string"),
        "customer_age_bracket": _pick(F.col("user_id") % 5, AGE_BRACKETS),
        "customer_credit_score_range": _pick(F.col("user_id") % 4, CREDIT_RANGES),
        "customer_income_bracket": _pick(F.col("user_id") % 4, INCOME_BRACKETS),
        "customer_state": F.concat(F.lit("S"), (F.col("user_id") % 50).cast("string")),
        "payment_method_id": F.concat(F.lit("pm_"), F.col("user_id").cast("string")),
        "installment_count": F.lit("4"),
    }


def txn_json(ev: DataFrame) -> F.Column:
    vals = _txn_values(ev)
    pieces = [F.lit("{")]
    for i, (key, kind) in enumerate(TXN_FIELDS):
        sep = "," if i else ""
        if kind == "s":
            pieces += [F.lit(f'{sep}"{key}":"'), vals[key], F.lit('"')]
        else:
            pieces += [F.lit(f'{sep}"{key}":'), vals[key]]
    pieces.append(F.lit("}"))
    return F.concat(*pieces)


def raw_transactions(spark: SparkSession, sf_dir: str, run_at: str = RUN_AT) -> DataFrame:
    """Raw envelope table (_timestamp, json_body, _ingestion_timestamp)."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.col("ts").alias("_timestamp"),
        txn_json(ev).alias("json_body"),
        F.to_timestamp_ntz(F.lit(run_at)).alias("_ingestion_timestamp"),
    )


def landed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the transaction API hands over: one JSON document per record, as
    text lines (the input of the envelope builder)."""
    ev = load(spark, sf_dir, "events")
    return ev.select(txn_json(ev).alias("value"))


# ---------------------------------------------------------------------------
# Cached prediction-log records: one keyed write per event.  Keys are per
# (customer, day) so that repeated writes of one key occur naturally.
# ---------------------------------------------------------------------------

def cached_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = load(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd")
    is_pred = F.col("event_id") % 2 == 0
    key = F.when(is_pred, F.concat(F.lit("pred:"), F.col("user_id").cast("string"), F.lit("_"), day)).otherwise(
        F.concat(F.lit("tx:"), F.col("user_id").cast("string"), F.lit("_"), day)
    )
    payload = F.concat(
        F.lit('{"customer_id":"cust_'), F.col("user_id").cast("string"),
        F.lit('","event_id":'), F.col("event_id").cast("string"),
        F.lit(',"score":'), F.col("value").cast("decimal(12,2)").cast("string"),
        F.lit(',"kind":"'), F.col("event_type"), F.lit('"}'),
    )
    return ev.select(
        key.alias("record_key"),
        F.col("ts").alias("written_at"),
        F.col("event_id").alias("seq"),
        payload.alias("payload"),
    )


def upload_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys already uploaded: every key whose last write happened before the
    upload cut-off (the day before the as-of instant)."""
    rec = cached_records(spark, sf_dir)
    return (
        rec.groupBy("record_key")
        .agg(F.max("written_at").alias("last_write"))
        .filter(F.col("last_write") < F.to_timestamp_ntz(F.lit("2024-01-30 00:00:00")))
        .select("record_key", F.to_timestamp_ntz(F.lit("2024-01-30 00:00:00")).alias("uploaded_at"))
    )


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ingestion ledger derived from events: per day one 'completed' row with
    the day's count for days whose count is even, otherwise a 'failed' row,
    plus a later 'completed' retry row for failed days after the 20th."""
    ev = load(spark, sf_dir, "events")
    per_day = ev.groupBy(F.to_date("ts").alias("ledger_date")).agg(F.count(F.lit(1)).alias("n"))
    first = per_day.select(
        "ledger_date",
        F.when(F.col("n") % 2 == 0, "completed").otherwise("failed").alias("status"),
        F.when(F.col("n") % 2 == 0, F.col("n")).otherwise(F.lit(0)).cast("bigint").alias("n_records"),
        F.to_timestamp_ntz(F.concat(F.date_format(F.date_add("ledger_date", 1), "yyyy-MM-dd"), F.lit(" 01:00:00")))
        .alias("updated_at"),
    )
    retry = per_day.filter((F.col("n") % 2 == 1) & (F.dayofmonth("ledger_date") > 20)).select(
        "ledger_date",
        F.lit("completed").alias("status"),
        F.col("n").cast("bigint").alias("n_records"),
        F.to_timestamp_ntz(F.concat(F.date_format(F.date_add("ledger_date", 2), "yyyy-MM-dd"), F.lit(" 01:00:00")))
        .alias("updated_at"),
    )
    return first.unionByName(retry)


def sse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event-stream text as landed: per record an ``event:`` line and a
    ``data:`` line; records of error events arrive cut short (malformed)."""
    ev = load(spark, sf_dir, "events")
    j = txn_json(ev)
    data = F.when(F.col("event_type") == "error", F.substring(j, 1, 40)).otherwise(j)
    return ev.select(F.explode(F.array(F.lit("event: transaction"), F.concat(F.lit("data: "), data))).alias("value"))
