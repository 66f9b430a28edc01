"""BNPL transactions: key repair, staged flatten, customer key, growing tenure,
and the ingestion data-quality queries over the raw table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.functions.dates import calendar_days, ts_lit
from cohortix.functions.jsonx import PARSED, discovered_paths, json_scalar, parse_once, scalar_text, typed_fields
from cohortix.sources.ingest import scratch_path

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def ts_text(c: F.Column) -> F.Column:
    """CAST(timestamp AS STRING) pinned to microseconds."""
    return F.date_format(c, TS_TEXT)


def unique_txn_id(json_column: str = "json_body", ts_column: str = "_timestamp") -> F.Column:
    """md5(transaction_id || customer_id || timestamp text): ids reset daily,
    the composite is unique.  NULL when any part is NULL (as in the source)."""
    return F.md5(F.concat(
        json_scalar(json_column, "transaction_id"), json_scalar(json_column, "customer_id"),
        ts_text(F.col(ts_column)),
    ))


def stg_transactions(raw: DataFrame, paths: list[str] | None = None, run_at: str | None = None) -> DataFrame:
    """Staged transactions: repaired key, typed fields (discovered when
    ``paths`` is None), lineage, raw body kept.  The JSON body is parsed once
    per row; the repaired key reads its parts from the same parse."""
    if paths is None:
        paths = discovered_paths(raw)
    parsed = parse_once(raw, paths)

    def part(k):
        if k in paths:
            v = F.col(PARSED)[k]
            return F.when(F.ltrim(v).startswith("{") | F.ltrim(v).startswith("["), F.lit(None)).otherwise(v)
        return json_scalar("json_body", k)

    uid = F.md5(F.concat(part("transaction_id"), part("customer_id"), ts_text(F.col("_timestamp"))))
    return parsed.select(
        uid.alias("unique_transaction_id"),
        *typed_fields(paths),
        F.col("_timestamp").alias("transaction_timestamp"),
        "_ingestion_timestamp",
        "json_body",
        F.lit("bnpl_api").alias("data_source"),
        (ts_lit(run_at) if run_at else F.localtimestamp()).alias("_loaded_at"),
    )


CUSTOMER_KEY_PARTS = ("customer_age_bracket", "customer_credit_score_range", "customer_id",
                      "customer_income_bracket", "customer_state")


def unique_customer_id() -> F.Column:
    return F.md5(F.concat(*[F.col(c) for c in CUSTOMER_KEY_PARTS]))


def transaction_order() -> F.Column:
    """Number that sorts transactions by time and then by the first 64 bits of
    their key.  Unlike a struct with text in it, it fits the buffer of a hash
    aggregate."""
    micros = F.unix_micros(F.col("transaction_timestamp").cast("timestamp")).cast("decimal(18,0)")
    high = F.conv(F.substring("unique_transaction_id", 1, 16), 16, 10).cast("decimal(20,0)")
    return (micros * F.lit("1" + 20 * "0").cast("decimal(21,0)") + F.coalesce(high, F.lit(0).cast("decimal(20,0)"))).cast("decimal(38,0)")


def first_transaction(staged: DataFrame) -> DataFrame:
    """Per customer: first timestamp and the tenure at it, over rows with a
    tenure (ties broken by the repaired key).  Conditional aggregates instead
    of a pre-filter: the predicate would otherwise be pushed beneath the JSON
    parse and evaluated on the raw text.  Partial and final hash aggregate, so a
    hot customer is combined map-side."""
    has = F.col("customer_tenure_days").isNotNull()
    agg = staged.groupBy("customer_id").agg(
        F.min(F.when(has, F.col("transaction_timestamp"))).alias("first_customer_transaction_date"),
        F.min_by("customer_tenure_days", F.when(has, transaction_order())).alias("first_customer_tenure"),
    )
    return agg.filter(F.col("first_customer_transaction_date").isNotNull())


def store_staged(staged: DataFrame) -> DataFrame:
    """The staged transactions as a table in the shared folder: their JSON is
    parsed once, at this write, however often they are read.  The table is not
    bucketed by customer: a bucket is read by one task, and a customer may hold
    a third of the rows."""
    path = scratch_path(staged.sparkSession, "staged")
    staged.write.parquet(path)
    return staged.sparkSession.read.schema(staged.schema).parquet(path)


def tenure_adjusted(staged: DataFrame) -> DataFrame:
    """Growing tenure = first tenure + calendar days since first transaction.

    ``staged`` is read twice, so hand in a stored table (:func:`store_staged`).
    Aggregate + inner join (customers with only null tenure drop out, as in
    the source).  The aggregate side has one row per customer, so AQE may
    broadcast it when small and otherwise splits skewed customers on the
    large side."""
    opening = first_transaction(staged)
    days = calendar_days(F.col("transaction_timestamp"), F.col("first_customer_transaction_date"))
    return staged.withColumn("unique_customer_id", unique_customer_id()).join(opening, "customer_id", "inner").select(
        *staged.columns, "unique_customer_id",
        "first_customer_transaction_date", "first_customer_tenure",
        days.alias("days_from_first_transaction"),
        (F.col("first_customer_tenure") + days).alias("adjusted_customer_tenure"),
    )


def daily_counts(raw: DataFrame, ts_column: str = "_timestamp") -> DataFrame:
    return raw.groupBy(F.to_date(ts_column).alias("ingestion_date")).agg(F.count(F.lit(1)).alias("record_count"))


def completeness(flat: DataFrame, columns=("transaction_id", "customer_id", "amount")) -> DataFrame:
    return flat.agg(
        F.count(F.lit(1)).alias("total_records"),
        *[F.count(c).alias(f"has_{c}") for c in columns],
    )


def json_value_counts(raw: DataFrame, key: str, json_column: str = "json_body") -> DataFrame:
    """Values are extracted once, in a projection that stays one as they are used
    several times.  Rows are counted by the text found; texts that are no scalar
    count nothing and are dropped by that count, as a filter on the text would be
    pushed below the projection and extract it again."""
    found = raw.select(F.get_json_object(json_column, f"$.{key}").alias("found"))
    counts = found.groupBy("found").agg(F.count(scalar_text(F.col("found"))).alias("count"))
    return counts.filter("count > 0").select(F.col("found").alias(key), "count")


def json_field_presence(raw: DataFrame, key: str, json_column: str = "json_body") -> DataFrame:
    """The field travels in a one-element array that is empty without it, so that
    text is extracted once for the test and the result."""
    found = F.array_compact(F.array(F.get_json_object(F.col(json_column), f"$.{key}")))
    return raw.select(unique_txn_id().alias("unique_transaction_id"), F.explode(found).alias(key))


# Fixed calendar days named by the volume test of the source system.
HOLIDAYS = ("01-01", "12-25")
SPECIAL_DAYS = (date(2024, 2, 14), date(2024, 11, 29))


def volume_profile(raw: DataFrame, base_daily_volume: float | None = None, ts_column: str = "_timestamp") -> DataFrame:
    """Daily volume as a share of base (mean daily volume when not given),
    lowest / highest day and weekday / weekend / holiday / special averages.
    Works on the per-day aggregate (one row per calendar day)."""
    d = daily_counts(raw, ts_column)
    # a day may be of several kinds; a weekday is one that is no weekend day
    weekend = F.dayofweek("ingestion_date").isin(1, 7)
    holiday = F.date_format("ingestion_date", "MM-dd").isin(*HOLIDAYS)
    special = F.col("ingestion_date").isin(*[F.lit(x) for x in SPECIAL_DAYS])
    of = lambda kind: F.avg(F.when(kind, F.col("record_count")))
    base = F.lit(float(base_daily_volume)) if base_daily_volume else F.avg("record_count")
    return d.agg(
        base.alias("base_daily_volume"),
        F.count(F.lit(1)).alias("n_days"),
        F.min_by("ingestion_date", F.struct("record_count", "ingestion_date")).alias("lowest_day"),
        F.min("record_count").alias("lowest_count"),
        F.max_by("ingestion_date", F.struct("record_count", F.col("ingestion_date"))).alias("highest_day"),
        F.max("record_count").alias("highest_count"),
        of(~weekend).alias("avg_weekday"),
        of(weekend).alias("avg_weekend"),
        of(holiday).alias("avg_holiday"),
        of(special).alias("avg_special"),
    ).select(
        "*",
        (F.col("lowest_count") * 100.0 / F.col("base_daily_volume")).alias("lowest_pct"),
        (F.col("highest_count") * 100.0 / F.col("base_daily_volume")).alias("highest_pct"),
    )

