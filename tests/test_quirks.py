"""Edge cases of SURVEY section 2.13 on tiny in-memory frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortix.functions.jsonx import discover_keys, flatten_columns, json_scalar
from cohortix.operators import orders as O
from cohortix.operators import transactions as B
from cohortix.params import ExperimentConfig, ExperimentWindow
from cohortix.sources import ingest as I


def test_json_scalar_nulls_objects_and_arrays(spark):
    df = spark.createDataFrame([('{"a": {"b": 1}, "c": [1], "d": 1.50, "e": "x"}',)], "j string")
    r = df.select(*[json_scalar("j", k).alias(k) for k in "acde"]).first()
    assert r.a is None and r.c is None and r.d == "1.5" and r.e == "x"


def test_discovery_merges_conflicting_types_to_string(spark):
    df = spark.createDataFrame(
        [('{"n": 1, "m": "x", "b": true, "o": {"z": 1}}',), ('{"n": "one", "m": "y", "b": false, "k": null}',)],
        "json_body string",
    )
    got = {r.json_path: (r.data_type, r.warehouse_type) for r in discover_keys(df).collect()}
    assert got["n"] == ("string", "STRING")
    assert got["m"] == ("string", "STRING")
    assert got["b"] == ("boolean", "BOOLEAN")
    assert got["o"][0] == "object"
    assert got["k"] == ("string", "STRING")  # only ever null


def test_flatten_casts_by_name(spark):
    df = spark.createDataFrame([('{"amount": "12.5", "will_default": "TRUE", "device_is_trusted": "yes", "x": 3}',)],
                               "json_body string")
    r = df.select(*flatten_columns(["amount", "will_default", "device_is_trusted", "x"])).first()
    assert r.amount == 12.5 and r.will_default is True and r.device_is_trusted is None and r.x == "3"


def test_envelope_timestamp_forms(spark):
    recs = spark.createDataFrame(
        [('{"_timestamp": "2024-01-01T10:00:00Z"}',), ('{"_timestamp": "2024-01-01T10:00:00+02:00"}',),
         ('{"_timestamp": "2024-01-01T10:00:00"}',), ('{"_timestamp": "not a time"}',), ('{"x": 1}',)],
        "value string",
    )
    good = I.raw_envelope(recs, "2024-02-01 00:00:00", mode="quarantine").orderBy("json_body").collect()
    assert sorted(r._timestamp for r in good) == [dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 10),
                                                 dt.datetime(2024, 1, 1, 10)]
    assert I.envelope_rejects(recs).count() == 2
    with pytest.raises(Exception):
        I.raw_envelope(recs, "2024-02-01 00:00:00", mode="fail").collect()


def test_sse_lines_and_body_fallbacks(spark):
    lines = spark.createDataFrame([("event: x",), ("data: {\"a\": 1}",), ("  data: {bad",), ("",)], "value string")
    recs = I.sse_records(lines).collect()
    assert [(r.record, r.valid) for r in recs] == [('{"a": 1}', True), ("{bad", False)]
    bodies = spark.createDataFrame(
        [("data: {\"a\": 1}\ndata: oops\nevent: y\ndata: {\"a\": 2}",), ('[{"a": 3}, {"a": 4}]',), ('{"a": 5}',)],
        "value string",
    )
    got = sorted(r.record.replace(" ", "") for r in I.parse_body(bodies).collect())
    assert got == ['{"a":1}', '{"a":2}', '{"a":3}', '{"a":4}', '{"a":5}']


def test_required_fields_checks_all_rows(spark):
    recs = spark.createDataFrame([('{"transaction_id": 1, "customer_id": 2, "_timestamp": "t", "amount": 1}',),
                                  ('{"transaction_id": 1}',)], "value string")
    r = I.required_fields(recs).first()
    assert r.total_records == 2 and r.missing_amount == 1 and r.passed is False


def test_tenure_null_first_and_vanishing_customers(spark):
    rows = [
        ("u1", "c1", dt.datetime(2024, 1, 1), None, "a", "b", "i", "s"),
        ("u2", "c1", dt.datetime(2024, 1, 3), 100.0, "a", "b", "i", "s"),
        ("u3", "c1", dt.datetime(2024, 1, 5), 100.0, "a", "b", "i", "s"),
        ("u4", "c2", dt.datetime(2024, 1, 5), None, "a", "b", "i", "s"),
    ]
    df = spark.createDataFrame(rows, "unique_transaction_id string, customer_id string, transaction_timestamp timestamp_ntz, "
                               "customer_tenure_days double, customer_age_bracket string, customer_credit_score_range string, "
                               "customer_income_bracket string, customer_state string")
    out = {r.unique_transaction_id: r for r in B.tenure_adjusted(df).collect()}
    assert set(out) == {"u1", "u2", "u3"}  # c2 has only null tenure: dropped
    assert out["u1"].days_from_first_transaction == -2  # before the first non-null row
    assert out["u3"].adjusted_customer_tenure == 102.0


def test_window_end_is_midnight_unless_inclusive(spark):
    w = ExperimentWindow("2024-01-01", "2024-01-31", "2024-02-01", "2024-02-29")
    df = spark.createDataFrame([(dt.datetime(2024, 2, 29, 10, 0),), (dt.datetime(2024, 2, 29, 0, 0),)],
                               "created_at timestamp_ntz")
    got = [r.p for r in df.select(O.time_period(F.col("created_at"), w).alias("p")).collect()]
    assert got == ["other", "experiment_period"]
    wi = ExperimentWindow("2024-01-01", "2024-01-31", "2024-02-01", "2024-02-29", inclusive_days=True)
    got = [r.p for r in df.select(O.time_period(F.col("created_at"), wi).alias("p")).collect()]
    assert got == ["experiment_period", "experiment_period"]


def test_date_batches_break_at_gaps(spark):
    ledger = spark.createDataFrame(
        [(dt.date(2024, 1, 3), "completed", 5, dt.datetime(2024, 1, 4)),
         (dt.date(2024, 1, 4), "failed", 0, dt.datetime(2024, 1, 5)),
         (dt.date(2024, 1, 4), "completed", 7, dt.datetime(2024, 1, 6))],
        "ledger_date date, status string, n_records long, updated_at timestamp_ntz",
    )
    rem = I.remaining_dates(I.calendar(spark, "2024-01-01", "2024-01-08"), ledger)
    got = sorted((r.batch_start, r.batch_end, r.n_days) for r in I.date_batches(rem, 3).collect())
    assert got == [(dt.date(2024, 1, 1), dt.date(2024, 1, 2), 2), (dt.date(2024, 1, 5), dt.date(2024, 1, 7), 3),
                   (dt.date(2024, 1, 8), dt.date(2024, 1, 8), 1)]
    summ = I.ingestion_summary(ledger).first()
    assert summ.completed_days == 2 and summ.failed_days == 0 and summ.total_records_ingested == 12


def test_load_request_names_all_faults():
    latest = dt.date(2025, 12, 31)
    got = I.load_request("2024-01-01", "2024-01-31", 5_000, latest=latest)
    assert (got.first, got.last, got.daily_rows) == (dt.date(2024, 1, 1), dt.date(2024, 1, 31), 5_000)
    for a, b, n, faults in [("2024-13-01", "2024-01-02", None, 1), ("2024-01-05", "2024-01-01", None, 1),
                            ("2019-01-01", "2019-02-01", None, 2), ("2024-01-01", "x", 50_001, 2), ("2024-01-01", "2024-01-02", 0, 1)]:
        with pytest.raises(ValueError) as e:
            I.load_request(a, b, n, latest=latest)
        assert len(str(e.value).split("; ")) == faults


def test_late_rows_join_their_day(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = lambda ids, v: spark.createDataFrame([(f"t{i}", dt.datetime(2024, 1, 1 + i % 2), v) for i in ids], "unique_transaction_id string, transaction_timestamp timestamp_ntz, status string")
    I.write_day_partitioned(rows(range(100), "a"), path)
    for _ in range(2):  # a rerun changes nothing
        I.write_day_partitioned(rows([0, 200], "b"), path)
        got = {r["unique_transaction_id"]: r["status"] for r in spark.read.parquet(path).collect()}
        assert len(got) == spark.read.parquet(path).count() == 101
        assert got["t0"] == got["t200"] == "b" and got["t2"] == got["t1"] == "a"


def test_nested_keys_are_typed(spark):
    from cohortix.functions.jsonx import regex_discovery

    df = spark.createDataFrame([('{"a":{"b":1},"c":2}',)], "json_body string")
    got = {r["json_path"]: r["data_type"] for r in regex_discovery(df).collect()}
    assert got == {"a": "string", "b": "number", "c": "number"}


def test_holiday_on_a_weekend_counts_as_both(spark):
    from cohortix.operators.transactions import volume_profile

    days = [dt.datetime(2022, 1, 1)] * 4 + [dt.datetime(2022, 1, 2)] * 2 + [dt.datetime(2022, 1, 3)]
    got = volume_profile(spark.createDataFrame([(d,) for d in days], "_timestamp timestamp_ntz")).first()
    assert (got["avg_weekend"], got["avg_holiday"], got["avg_weekday"]) == (3.0, 4.0, 1.0)


def test_grown_directory_table_is_seen(spark, tmp_path):
    from cohortix.sources import fixtures as fx

    for t in ("customer", "nation", "orders", "lineitem", "part", "events"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").limit(200).write.parquet(str(tmp_path / f"{t}.parquet"))
    before = fx.landed_records(spark, str(tmp_path)).count()
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(50).write.mode("append").parquet(str(tmp_path / "events.parquet"))
    assert fx.landed_records(spark, str(tmp_path)).count() == before + 50


def test_partitioned_scan_requires_filter(spark, tmp_path):
    with pytest.raises(ValueError):
        I.read_partitioned(spark, str(tmp_path), None, "2024-01-02")


def test_empty_and_single_user_assignment(spark):
    from cohortix.operators.experiments import experiment_assignments

    cfg = ExperimentConfig()
    empty = spark.createDataFrame([], "user_id long")
    assert experiment_assignments(empty, cfg).count() == 0
    one = spark.createDataFrame([(42,)], "user_id long")
    r = experiment_assignments(one, cfg).first()
    assert r.object_identifier == "42" and r.variant in ("control", "treatment")


def test_required_columns_and_layers(spark, tmp_path):
    from cohortix.operators.quality import required_columns
    from cohortix.plans.layers import materialize, schema_name

    df = spark.createDataFrame([(1, "a")], "order_id long, status string")
    assert required_columns(df, ["order_id", "status", "created_at"]) == ["created_at"]
    assert schema_name(None, "tgt") == "tgt" and schema_name(" marts ", "tgt") == "analytics_marts"
    v = materialize(spark, df, "stg_demo", "staging")
    assert v.count() == 1
    t = materialize(spark, df, "mart_demo", "marts", location=str(tmp_path / "mart_demo"))
    assert t.count() == 1


def test_day_count_modes(spark):
    from cohortix.functions.dates import calendar_days, elapsed_days

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 2, 1, 0))], "a timestamp_ntz, b timestamp_ntz")
    r = df.select(calendar_days(F.col("b"), F.col("a")).alias("c"), elapsed_days(F.col("b"), F.col("a")).alias("e")).first()
    assert (r.c, r.e) == (1, 0)


def test_store_failures_and_default_write_time(spark, tmp_path):
    from cohortix.operators import predictions as P
    from cohortix.operators import quality as D

    df = spark.createDataFrame([(1, "Complete"), (2, "Lost"), (2, "Lost")], "order_id long, status string")
    checks = [D.Check("status_accepted", D.accepted_values(df, "order_id", "status", ("Complete",))),
              D.Check("order_unique", D.unique(df, "order_id"), "error")]
    summ = {r.check_name: (r.n_failures, r.status) for r in D.store_failures(checks, str(tmp_path)).collect()}
    assert summ == {"status_accepted": (2, "fail"), "order_unique": (1, "fail")}
    assert spark.read.parquet(str(tmp_path / "status_accepted")).count() == 2
    with pytest.raises(AssertionError):
        D.enforce(D.store_failures(checks, str(tmp_path)))

    log = spark.createDataFrame([("tx:1", None, 1, "a"), ("tx:1", dt.datetime(2024, 1, 30), 2, "b")],
                                "record_key string, written_at timestamp_ntz, seq long, payload string")
    live = P.latest_per_key_ttl(log, "2024-01-31 00:00:00", run_at="2024-01-30 12:00:00").first()
    assert live.payload == "a" and live.n_writes == 2


def test_overlay_sample_value_fill(spark):
    from pyspark.sql import types as T

    from cohortix.operators.experiments import sample_values, unruled_columns, uplift_overlay

    src = spark.createDataFrame([(1, 7, "Complete", "M", 2, dt.datetime(2024, 1, 1), "web")],
                                "order_id long, user_id long, status string, gender string, num_of_item int, "
                                "created_at timestamp_ntz, channel string")
    assert unruled_columns(src.schema) == ["channel"]
    cfg = ExperimentConfig(daily_eligible_users=1000, effect_size=5.0)
    cohort = spark.range(0, 50).select(F.col("id").alias("user_id"))
    ov = uplift_overlay(cohort, cfg, src.schema, sample_values(src, unruled_columns(src.schema)))
    assert ov.count() > 0
    assert "channel" not in ov.columns or ov.filter(F.col("channel") != "web").count() == 0


def test_stored_schema_merges_loads_and_reruns(spark, tmp_path):
    from cohortix.functions.jsonx import store_kinds, stored_schema

    first = ['{"a": 1, "b": null, "o": {"x": 1}}', '{"a": 2, "b": null}', "not json", None]
    late = ['{"a": "two", "b": true, "l": [1], "9bad": 1}', "{}"]
    frame = lambda rows: spark.createDataFrame([(r,) for r in rows], "json_body string")
    home = str(tmp_path / "kinds")
    schema = lambda: {r["json_path"]: (r["data_type"], r["n_records"]) for r in stored_schema(spark, home).collect()}
    store_kinds(frame([]), home, "0")
    assert schema() == {}
    store_kinds(frame(first), home, "1")
    assert schema() == {"a": ("number", 2), "b": ("string", 2), "o": ("object", 1)}
    for _ in range(2):  # a rerun replaces its own counts
        store_kinds(frame(late), home, "2")
    both = {r["json_path"]: (r["data_type"], r["n_records"]) for r in discover_keys(frame(first + late)).collect()}
    assert schema() == both == {"a": ("string", 3), "b": ("boolean", 3), "o": ("object", 1), "l": ("array", 1)}
