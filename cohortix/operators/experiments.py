"""Experimentation: deterministic assignment, cohorts, uplift overlay, results.

All row loops of the source system become column expressions over the
participant DataFrame; the only driver work is turning a configuration into
integer thresholds (a handful of numbers, independent of data size).
"""

from __future__ import annotations

import math
from itertools import cycle, islice

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortix.functions.dates import in_window, in_window_halfopen, ts_lit
from cohortix.functions.hashing import (
    BUCKETS,
    bucket,
    count_below,
    cumulative_thresholds,
    hash60,
    inclusive_threshold,
    md5_hex,
    md5_prefix_id,
    randint,
)
from cohortix.operators.topn import hash_top_n
from cohortix.params import LEGACY_EXPERIMENTS, ExperimentConfig, ExperimentWindow


# ---------------------------------------------------------------------------
# Variant of a key under an allocation
# ---------------------------------------------------------------------------

def assignment_bucket(user_id: F.Column, experiment_name: str | F.Column) -> F.Column:
    exp = F.lit(experiment_name) if isinstance(experiment_name, str) else experiment_name
    return bucket(user_id, F.lit("_"), exp)


def assign_variant(user_id: F.Column, experiment_name: str, variants, allocation) -> F.Column:
    """bucket(user_experiment)/10**6 <= running allocation -> arm; first arm
    when no running sum reaches it."""
    b = assignment_bucket(user_id, experiment_name)
    cuts = cumulative_thresholds(allocation)
    expr = None
    for v, t in zip(variants, cuts):
        expr = F.when(b <= t, F.lit(v)) if expr is None else expr.when(b <= t, F.lit(v))
    return expr.otherwise(F.lit(variants[0]))


def variant_assignment(users: DataFrame, cfg: ExperimentConfig) -> DataFrame:
    """X2 over a user table: (user_id, bucket, variant)."""
    return users.select(
        "user_id",
        assignment_bucket(F.col("user_id"), cfg.name).alias("bucket"),
        assign_variant(
            F.col("user_id"), cfg.name, [cfg.control_name, cfg.treatment_name],
            [cfg.control_allocation, cfg.treatment_allocation],
        ).alias("variant"),
    )


# ---------------------------------------------------------------------------
# Participants and eligibility
# ---------------------------------------------------------------------------

def experiment_participants(orders: DataFrame, start: str, end: str, half_open: bool = False) -> DataFrame:
    """Distinct users with an order in the experiment window."""
    cond = in_window_halfopen("created_at", start, end) if half_open else in_window("created_at", start, end)
    return orders.filter(cond).select("user_id").distinct()


def eligible_users(users: DataFrame, countries) -> DataFrame:
    """Country eligibility (a literal IN list: no join, pushed to the scan)."""
    return users.filter(F.col("country").isin(list(countries)))


# ---------------------------------------------------------------------------
# Participant-only assignments with the audit schema
# ---------------------------------------------------------------------------

def experiment_assignments(participants: DataFrame, cfg: ExperimentConfig, run_at: str | None = None) -> DataFrame:
    start, end = cfg.window.experiment_start, cfg.window.experiment_end
    arm = assign_variant(
        F.col("user_id"), cfg.name, [cfg.control_name, cfg.treatment_name],
        [cfg.control_allocation, cfg.treatment_allocation],
    )
    created = ts_lit(run_at) if run_at else F.current_timestamp()
    return participants.select(
        md5_prefix_id(F.col("user_id"), F.lit(cfg.name), F.lit(start)).alias("assignment_id"),
        F.lit(cfg.name).alias("experiment_name"),
        F.col("user_id").cast("string").alias("object_identifier"),
        F.lit("user").alias("granularity_level"),
        F.when(arm == cfg.control_name, "control").otherwise("treatment").alias("variant"),
        arm.alias("variant_description"),
        F.lit(start).alias("assigned_date"),
        F.lit(start).alias("experiment_start_date"),
        F.lit(end).alias("experiment_end_date"),
        F.lit("deterministic_hash").alias("assignment_method"),
        created.alias("createdAt"),
    )


# ---------------------------------------------------------------------------
# The four-experiment programme over registered users
# ---------------------------------------------------------------------------

def _programme_array(experiments) -> F.Column:
    structs = []
    for name, arms, alloc, start, end, desc, metric in experiments:
        structs.append(
            F.struct(
                F.lit(name).alias("experiment_name"),
                F.array(*[F.lit(a) for a in arms]).alias("arms"),
                F.array(*[F.lit(t) for t in cumulative_thresholds(alloc)]).alias("cuts"),
                F.lit(start).alias("start"),
                F.lit(end).alias("end"),
                F.lit(desc).alias("description"),
                F.lit(metric).alias("success_metric"),
            )
        )
    return F.array(*structs)


def multi_experiment_assign(users: DataFrame, experiments=LEGACY_EXPERIMENTS) -> DataFrame:
    """Users x experiments where registration_date <= experiment start.

    The programme is a fixed literal array, so the theta product is a per-row
    ``filter`` + ``explode`` (a generator, no join and no shuffle)."""
    prog = _programme_array(experiments)
    reg = F.col("registration_date")
    exploded = users.select(
        "user_id",
        F.explode(F.filter(prog, lambda e: reg <= F.to_date(e["start"]))).alias("e"),
    )
    b = assignment_bucket(F.col("user_id"), F.col("e.experiment_name"))
    max_arms = max(len(x[1]) for x in experiments)
    variant = None
    for i in range(max_arms):
        cut = F.try_element_at(F.col("e.cuts"), F.lit(i + 1))
        arm = F.try_element_at(F.col("e.arms"), F.lit(i + 1))
        variant = F.when(b <= cut, arm) if variant is None else variant.when(b <= cut, arm)
    variant = variant.otherwise(F.element_at("e.arms", 1))
    return exploded.select(
        "user_id",
        F.col("e.experiment_name").alias("experiment_name"),
        variant.alias("variant"),
        F.col("e.start").alias("assigned_date"),
        F.col("e.start").alias("experiment_start_date"),
        F.col("e.end").alias("experiment_end_date"),
        F.col("e.description").alias("experiment_description"),
        F.col("e.success_metric").alias("success_metric"),
        F.lit("deterministic_hash").alias("assignment_method"),
    )


# ---------------------------------------------------------------------------
# Treatment cohort with the design cap
# ---------------------------------------------------------------------------

def sample_order_hex(key: F.Column, seed: int) -> F.Column:
    return md5_hex(F.lit(f"{seed}_sample_"), key)


def treatment_cohort(assignments: DataFrame, cfg: ExperimentConfig) -> DataFrame:
    """Users in the treatment arm (matched on the descriptive arm name), capped
    at daily_eligible_users * duration // 2 by hash order."""
    treated = assignments.filter(F.col("variant_description") == cfg.treatment_name).select(
        F.col("object_identifier").cast("bigint").alias("user_id"), "experiment_name", "variant_description"
    )
    return hash_top_n(treated, cfg.cohort_cap, sample_order_hex(F.col("user_id"), cfg.seed), ["user_id"])


# ---------------------------------------------------------------------------
# Uplift overlay orders
# ---------------------------------------------------------------------------

def poisson_cuts(lam: float) -> list[int]:
    """Integer inverse-CDF table of Poisson(lam) for any mean: probabilities in
    log space, summed exactly, up to the first count beyond the mean that no
    draw can exceed."""
    cuts, parts, k = [], [], 0
    while not cuts or cuts[-1] < BUCKETS - 1:
        p = math.exp(k * math.log(lam) - lam - math.lgamma(k + 1)) if lam > 0 else float(k == 0)
        parts.append(p)
        rest = k > lam and p < 1e-18  # what is left of the tail lies below the draw's resolution
        cuts.append(BUCKETS - 1 if rest else inclusive_threshold(min(math.fsum(parts), 1.0)))
        k += 1
    return cuts


#: fixed values: weight of each day of the seven-day cycle that starts with the experiment
CYCLE = (1.1, 1.0, 1.0, 1.0, 1.0, 1.2, 1.2)


def day_cuts(duration_days: int) -> list[int]:
    """Cut points of the order day, by the cycle's weights."""
    weights = list(islice(cycle(CYCLE), duration_days))
    total = sum(weights)
    return cumulative_thresholds([w / total for w in weights])


OVERLAY_COLUMNS = ("order_id", "user_id", "experiment_name", "variant", "status", "gender",
                   "num_of_item", "created_at", "shipped_at", "delivered_at")


def sample_values(source, columns) -> dict:
    """Schema capture: one sample row's values for the given columns (a
    single-row read, only when some column has no fill rule)."""
    if not columns:
        return {}
    row = source.select(*columns).limit(1).collect()
    return row[0].asDict() if row else {}


_TIMES = (T.TimestampType, T.TimestampNTZType)
_INTEGERS = (T.IntegerType, T.LongType, T.ShortType)
#: columns that the overlay sets itself
_OWN = {"order_id", "user_id"}
#: how a source column is filled: kinds of column, parts of its name, value
#: from (order time, draw); the first row that fits counts
FILL = (
    (_TIMES, ("created", "order"), lambda at, draw: at),
    (_TIMES, ("shipped",), lambda at, draw: F.timestamp_add("DAY", randint(draw("ship"), 1, 3), at)),
    (_TIMES, ("delivered",), lambda at, draw: F.timestamp_add("DAY", randint(draw("deliver"), 3, 7), at)),
    (_TIMES, ("",), lambda at, draw: F.lit(None)),
    (T.StringType, ("status",), lambda at, draw: F.lit("Complete")),
    (T.StringType, ("gender",), lambda at, draw: F.when(draw("gender") % 2 == 0, "M").otherwise("F")),
    (_INTEGERS, ("num_of_item", "quantity"), lambda at, draw: randint(draw("items"), 1, 3)),
)


def _filler(field: T.StructField):
    return next((make for kinds, parts, make in FILL if isinstance(field.dataType, kinds) and any(p in field.name.lower() for p in parts)), None)


def unruled_columns(source_schema: T.StructType) -> list[str]:
    """Source columns without a row in FILL (they take a sample value)."""
    return [f.name for f in source_schema.fields if f.name not in _OWN and _filler(f) is None]


def uplift_overlay(cohort: DataFrame, cfg: ExperimentConfig, source_schema: T.StructType,
                   samples: dict | None = None) -> DataFrame:
    """Synthetic treatment orders: per user a Poisson(lam) count, each order
    on a day drawn from the day weights (n categorical draws = one multinomial)."""
    lam = cfg.additional_orders_per_user
    pcuts = poisson_cuts(lam)
    dcuts = day_cuts(cfg.duration_days)
    seed = cfg.seed
    uid = F.col("user_id")
    # Each draw is projected into its own column before the inverse-CDF
    # lookup, so the lookup tree references a column, not the hash.
    per_user = cohort.select("user_id", bucket(F.lit(f"{seed}_poisson_"), uid).alias("_bp")).select(
        "user_id", count_below(F.col("_bp"), pcuts).alias("_n")
    ).filter(F.col("_n") > 0)
    exploded = per_user.select("user_id", F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i"))
    okey = F.concat_ws("_", uid.cast("string"), F.col("_i").cast("string"))

    def draw(salt):
        return bucket(F.lit(f"{seed}_{salt}_"), okey)

    exploded = exploded.withColumn("_bd", draw("day")).withColumn("_day", count_below(F.col("_bd"), dcuts))
    # Order dates come from a calendar of the experiment's days (one row per
    # day, a broadcast equi-join): filters on created_at then stop at the
    # join instead of being rewritten into the hash lookup.
    spark = cohort.sparkSession
    cal = spark.range(cfg.duration_days).select(
        F.col("id").cast("int").alias("_day"),
        F.to_timestamp_ntz(F.date_add(F.to_date(F.lit(cfg.window.experiment_start)), F.col("id").cast("int")))
        .alias("_order_ts"),
    )
    exploded = exploded.join(F.broadcast(cal), "_day")
    order_ts = F.col("_order_ts")
    order_id = hash60(md5_hex(F.lit(f"{seed}_order_{cfg.name}_"), okey)).alias("order_id")
    samples = samples or {}
    fills = []
    for f in source_schema.fields:
        if f.name not in _OWN:
            make = _filler(f)
            value = make(order_ts, draw) if make else F.lit(samples.get(f.name))
            fills.append(value.cast(f.dataType).alias(f.name))
    out = exploded.select(
        order_id, uid.alias("user_id"), *fills,
        F.lit(cfg.name).alias("experiment_name"), F.lit(cfg.treatment_name).alias("variant"),
    )
    ordered = [c for c in OVERLAY_COLUMNS if c in out.columns]
    return out.select(*ordered, *[c for c in out.columns if c not in ordered])


def overlay_for(orders: DataFrame, cfg: ExperimentConfig, run_at: str | None = None) -> DataFrame:
    """A4 -> X2b -> X5 -> X6 as one lazy plan."""
    headers = orders.select("user_id", "created_at")
    parts = experiment_participants(headers, cfg.window.experiment_start, cfg.window.experiment_end)
    asg = experiment_assignments(parts, cfg, run_at)
    cohort = treatment_cohort(asg, cfg)
    return uplift_overlay(cohort, cfg, orders.schema, sample_values(orders, unruled_columns(orders.schema)))


OVERLAY_RUN_SCHEMA = "experiment_name string, table_name string, rows_created long, unique_users long, status string, error string"


def run_overlays(orders: DataFrame, configs, home: str, run_at: str | None = None) -> DataFrame:
    """Production run over several experiments (S25): each overlay is built and
    written by itself, rows are counted by the write, and one that fails is
    recorded and does not stop the others.  One row per experiment; the loop is
    over configurations, the work of each is one Spark job."""
    spark = orders.sparkSession
    done = []
    for cfg in configs:
        table = f"synthetic_{cfg.name}_orders"
        path, seen = f"{home}/{table}", Observation(f"overlay {cfg.name}")
        try:
            overlay_for(orders, cfg, run_at).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
            users = spark.read.parquet(path).select("user_id").distinct().count()
            done.append((cfg.name, table, seen.get["rows"], users, "success", None))
        except (PySparkException, Py4JError, ValueError, ArithmeticError) as error:
            done.append((cfg.name, table, 0, 0, "failed", f"{type(error).__name__}: {error}".splitlines()[0][:300]))
    return spark.createDataFrame(done, OVERLAY_RUN_SCHEMA)


# ---------------------------------------------------------------------------
# Balance, shares, effect, results
# ---------------------------------------------------------------------------

def variant_share(assignments: DataFrame) -> DataFrame:
    """COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY experiment): an aggregate
    first (map-side combine), then a window over the tiny aggregate."""
    counts = assignments.groupBy("experiment_name", "variant").agg(F.count(F.lit(1)).alias("user_count"))
    w = Window.partitionBy("experiment_name")
    return counts.withColumn("allocation_pct", F.col("user_count") / F.sum("user_count").over(w))


def balance_ratio(assignments: DataFrame) -> DataFrame:
    counts = assignments.groupBy("experiment_name", "variant").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("experiment_name").agg(
        F.min("n").alias("min_arm"), F.max("n").alias("max_arm"),
        (F.min("n") / F.max("n")).alias("balance_ratio"),
    )


def dq_variant_balance(assignments: DataFrame, expected: float | None = None, tolerance: float = 0.05) -> DataFrame:
    """Arms whose share deviates from the expected share by more than the
    tolerance (expected defaults to 1 / number of arms)."""
    shares = variant_share(assignments)
    if expected is None:
        arms = Window.partitionBy("experiment_name")
        exp = F.lit(1.0) / F.count(F.lit(1)).over(arms)
    else:
        exp = F.lit(expected)
    return shares.withColumn("expected_pct", exp).filter(
        F.abs(F.col("allocation_pct") - F.col("expected_pct")) > F.lit(tolerance)
    )


def effect_size(mart: DataFrame) -> DataFrame:
    """Orders per participant by period and arm, and the relative effect of the
    treatment arm over control in the experiment period."""
    exp = mart.filter(F.col("experiment_status") == "experiment_participant")
    per = exp.groupBy("control_treatment").agg(
        F.sum(F.when(F.col("time_period") == "experiment_period", 1).otherwise(0)).alias("exp_orders"),
        F.countDistinct("user_id").alias("users"),
    )
    rates = per.select(
        F.sum(F.when(F.col("control_treatment") == "control", F.col("exp_orders") / F.col("users"))).alias("baseline_rate"),
        F.sum(F.when(F.col("control_treatment") == "treatment", F.col("exp_orders") / F.col("users"))).alias("target_rate"),
    )
    return rates.withColumn("effect", (F.col("target_rate") - F.col("baseline_rate")) / F.col("baseline_rate"))


def experiment_results(assignments: DataFrame, orders: DataFrame, items: DataFrame, cfg: ExperimentConfig,
                       horizon_days: int = 30) -> DataFrame:
    """Per arm: exposed users, converters within horizon after assignment,
    conversion rate, revenue per exposed user, z against control.  Items are read
    for the orders within the horizon only."""
    asg = assignments.select(
        F.col("object_identifier").cast("bigint").alias("user_id"), "experiment_name", "variant",
        F.to_timestamp_ntz(F.col("assigned_date")).alias("assigned_at"),
    )
    j = asg.join(orders.select("order_id", "user_id", "created_at"), "user_id").filter(
        (F.col("created_at") >= F.col("assigned_at"))
        & (F.col("created_at") < F.timestamp_add("DAY", F.lit(horizon_days), F.col("assigned_at")))
    ).select("experiment_name", "variant", "user_id", "order_id")
    per_user = j.join(items.select("order_id", "sale_price"), "order_id", "left").groupBy(
        "experiment_name", "variant", "user_id").agg(F.sum("sale_price").alias("revenue"))
    exposed = asg.groupBy("experiment_name", "variant").agg(F.count(F.lit(1)).alias("exposed_users"))
    conv = per_user.groupBy("experiment_name", "variant").agg(
        F.count(F.lit(1)).alias("conversions_30d"),
        F.sum("revenue").alias("revenue_30d"),
    )
    res = exposed.join(conv, ["experiment_name", "variant"], "left").select(
        "experiment_name", "variant", "exposed_users",
        F.coalesce("conversions_30d", F.lit(0)).cast("bigint").alias("conversions_30d"),
        F.coalesce("revenue_30d", F.lit(0)).cast("decimal(18,2)").alias("revenue_30d"),
    )
    res = res.withColumn("conversion_rate_30d", F.col("conversions_30d") / F.col("exposed_users")).withColumn(
        "avg_revenue_per_user", F.col("revenue_30d").cast("double") / F.col("exposed_users")
    )
    w = Window.partitionBy("experiment_name")
    ctl_n = F.max(F.when(F.col("variant") == "control", F.col("exposed_users"))).over(w)
    ctl_x = F.max(F.when(F.col("variant") == "control", F.col("conversions_30d"))).over(w)
    res = res.withColumn("_cn", ctl_n).withColumn("_cx", ctl_x)
    pooled = (F.col("conversions_30d") + F.col("_cx")) / (F.col("exposed_users") + F.col("_cn"))
    res = res.withColumn("_pooled", pooled)
    se = F.sqrt(F.col("_pooled") * (1 - F.col("_pooled"))
                * (F.lit(1.0) / F.col("exposed_users") + F.lit(1.0) / F.col("_cn")))
    res = res.withColumn("_se", se)
    z = F.when((F.col("variant") != "control") & (F.col("_se") > 0),
               (F.col("conversion_rate_30d") - F.col("_cx") / F.col("_cn")) / F.col("_se"))
    return res.withColumn("z_score", z).drop("_cn", "_cx", "_pooled", "_se").withColumn(
        "statistical_significance",
        F.when(F.col("z_score").isNull(), F.lit(None).cast("string"))
        .when(F.abs(F.col("z_score")) > 1.96, "significant").otherwise("not_significant"),
    )


# ---------------------------------------------------------------------------
# Extracts and the fixed-size user sample
# ---------------------------------------------------------------------------

def users_extract(users: DataFrame) -> DataFrame:
    return users.orderBy("registration_date", "user_id")


def completed_orders(orders: DataFrame) -> DataFrame:
    return (
        orders.filter(F.col("status") == "Complete")
        .select("order_id", "user_id", "status", F.col("created_at").alias("order_date"),
                "shipped_at", "delivered_at", "num_of_item")
        .orderBy("order_date", "order_id")
    )


def sample_users(users: DataFrame, sample_pct: float, seed: int = 42) -> DataFrame:
    """Exactly int(N * pct / 100) users in hash order (one scalar count)."""
    n = int(users.count() * sample_pct / 100)
    return hash_top_n(users, n, sample_order_hex(F.col("user_id"), seed), ["user_id"])


def sample_users_orders(users: DataFrame, orders: DataFrame, sample_pct: float, seed: int = 42) -> DataFrame:
    """Orders restricted to the sampled users (semi join)."""
    su = sample_users(users.select("user_id"), sample_pct, seed)
    return orders.join(su, "user_id", "left_semi")


def cohort_cap_summary(assignments: DataFrame, cfg: ExperimentConfig) -> DataFrame:
    """Available treatment users, design cap, users kept (one keyed join of
    the treatment arm to its capped cohort, then a single aggregate)."""
    treated = assignments.filter(F.col("variant_description") == cfg.treatment_name).select(
        F.col("object_identifier").cast("bigint").alias("user_id")
    )
    kept = treatment_cohort(assignments, cfg).select("user_id", F.lit(1).alias("_kept"))
    return treated.join(kept, "user_id", "left").agg(
        F.count(F.lit(1)).alias("available_users"),
        F.count("_kept").alias("cohort_users"),
    ).select(
        F.lit(cfg.name).alias("experiment_name"),
        "available_users",
        F.lit(cfg.cohort_cap).cast("bigint").alias("cohort_cap"),
        "cohort_users",
        F.lit(cfg.target_rate).alias("target_rate"),
        F.lit(cfg.additional_orders_per_user).alias("additional_orders_per_user"),
    )
