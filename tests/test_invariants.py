"""Distribution and structure invariants of the reference's unit tests."""

from pyspark.sql import functions as F

from cohortix.operators import enrich as E
from cohortix.operators import experiments as X
from cohortix.operators.topn import hash_top_n
from cohortix.functions.hashing import md5_hex
from cohortix.params import ExperimentConfig
from cohortix.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


def test_three_arm_shares_within_bounds(spark):
    users = spark.range(0, 5000).select(F.col("id").alias("user_id"),
                                        F.lit("2020-01-01").cast("date").alias("registration_date"))
    a = X.multi_experiment_assign(users)
    shares = a.groupBy("experiment_name", "variant").count().collect()
    for r in shares:
        assert 0.25 <= r["count"] / 5000 <= 0.40
    bal = X.balance_ratio(a).collect()
    assert all(r.balance_ratio >= 0.8 for r in bal)


def test_registration_filter(spark):
    users = spark.createDataFrame([(1, "2023-02-15"), (2, "2022-01-01")], "user_id long, registration_date string") \
        .withColumn("registration_date", F.col("registration_date").cast("date"))
    got = {(r.user_id, r.experiment_name) for r in X.multi_experiment_assign(users).collect()}
    assert (1, "checkout_button_color") not in got and (1, "product_recommendations") in got
    assert sum(1 for u, _ in got if u == 2) == 4


def test_hash_top_n_equals_brute_force(spark):
    df = spark.range(0, 20000).select((F.col("id") % 9000).alias("k"), F.col("id"))
    h = md5_hex(F.lit("s_"), F.col("k"))
    for n in (0, 1, 137, 8999, 20000, 25000):
        got = sorted((r.k, r.id) for r in hash_top_n(df, n, h, ["k", "id"]).collect())
        want = sorted((r.k, r.id) for r in df.withColumn("_h", h).orderBy("_h", "k", "id").limit(n).collect())
        assert got == want, n


def test_overlay_only_treatment_and_in_window(spark):
    cfg = ExperimentConfig()
    orders = fx.orders(spark, SF)
    ov = X.overlay_for(orders, cfg, "2024-02-01 00:00:00")
    assert ov.filter(F.col("variant") != cfg.treatment_name).count() == 0
    s, e = cfg.window.experiment_start, cfg.window.experiment_end
    assert ov.filter((F.col("created_at") < F.lit(s).cast("timestamp_ntz")) |
                     (F.col("created_at") > F.lit(e).cast("timestamp_ntz"))).count() == 0
    assert ov.filter(F.col("shipped_at") <= F.col("created_at")).count() == 0
    assert ov.groupBy("order_id").count().filter("count > 1").count() == 0


def test_logistics_invariants(spark):
    orders = X.completed_orders(fx.orders(spark, SF)).withColumnRenamed("order_date", "created_at")
    lg = E.order_logistics(spark, orders)
    assert lg.count() == orders.count()
    assert lg.filter(F.col("total_delivery_days") != F.col("processing_days") + F.col("transit_days")).count() == 0
    assert lg.filter((F.col("shipping_cost") < 0) | (F.col("shipping_cost") > 42)).count() == 0
    assert lg.filter(F.col("tracking_number").rlike("^[0-9]{2}[A-Za-z]{2}[0-9]{8}$") == False).count() == 0  # noqa: E712
    one = lg.filter(F.col("package_type") == "oversized").join(orders, "order_id").filter(F.col("num_of_item") <= 6)
    assert one.count() == 0


def test_ticket_rules(spark):
    t = E.support_tickets(spark, fx.users(spark, SF), fx.orders(spark, SF, with_items=False), "2024-01-31 00:00:00")
    assert t.filter(F.col("status").isin("open", "in_progress") & F.col("resolution_time_hours").isNotNull()).count() == 0
    assert t.filter(F.col("status").isin("resolved", "closed") & F.col("resolution_time_hours").isNull()).count() == 0
    assert t.filter(F.col("first_response_time_minutes") < 1).count() == 0
    assert t.filter(~F.col("satisfaction_score").between(1, 5)).count() == 0
    high = t.filter(F.col("issue_category").isin("shipping_delay", "product_defect"))
    assert high.filter(F.col("priority") == "low").count() == 0
    per_user = t.groupBy("user_id").count().agg(F.max("count")).first()[0]
    assert per_user <= 4
