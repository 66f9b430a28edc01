"""Streaming twins survive restarts: the checkpoint replaces the ledger."""

import datetime as dt
import os

from cohortix.params import RUN_AT
from cohortix.sources import fixtures as fx
from cohortix.sources.ingest import scratch_path
from cohortix.streaming import twins as T

SF = "/root/testdata/sf0.001"


def test_ingest_restart_does_not_duplicate(spark):
    landing = scratch_path(spark, "t-landing")
    fx.landed_records(spark, SF).repartition(3).write.text(landing)
    base = scratch_path(spark, "t-ingest")
    out, ckpt, rej = (os.path.join(base, x) for x in ("out", "_ck", "rejects"))
    T.stream_ingest(spark, landing, out, ckpt, RUN_AT, rej, 1)
    n1 = spark.read.parquet(out).count()
    T.stream_ingest(spark, landing, out, ckpt, RUN_AT, rej)  # restart: nothing new
    assert spark.read.parquet(out).count() == n1 == fx.landed_records(spark, SF).count()


def test_route_restart_is_idempotent(spark):
    log = scratch_path(spark, "t-log")
    fx.cached_records(spark, SF).repartition(2).write.parquet(log)
    base = scratch_path(spark, "t-route")
    preds, txs, ckpt = os.path.join(base, "p"), os.path.join(base, "t"), os.path.join(base, "_ck")
    T.stream_route(spark, log, preds, txs, ckpt, RUN_AT)
    n1 = spark.read.parquet(preds).count() + spark.read.parquet(txs).count()
    T.stream_route(spark, log, preds, txs, ckpt, RUN_AT)
    n2 = spark.read.parquet(preds).count() + spark.read.parquet(txs).count()
    assert n1 == n2 == fx.cached_records(spark, SF).count()


def test_results_do_not_depend_on_micro_batches(spark):
    log = scratch_path(spark, "t-unsorted")
    rows = fx.cached_records(spark, SF)
    rows.repartition(4, "seq").write.parquet(log)
    events = scratch_path(spark, "t-events")
    fx.load(spark, SF, "events").repartition(4, "event_id").write.parquet(events)
    base = scratch_path(spark, "t-batches")
    at = lambda *x: os.path.join(base, *x)
    T.stream_dedupe(spark, log, at("d", "out"), at("dc"), 400, max_files=1)
    assert spark.read.parquet(at("d", "out")).count() == rows.select("record_key").distinct().count()
    T.stream_latest(spark, log, at("l"), at("lc"), 1)
    got = T.read_latest(spark, at("l"))
    assert got.agg({"n_writes": "sum"}).first()[0] == rows.count()
    want = {r["record_key"]: r["w"] for r in rows.groupBy("record_key").agg({"written_at": "max"}).toDF("record_key", "w").collect()}
    assert {r["record_key"]: r["written_at"] for r in got.collect()} == want
    schema = "event_id bigint, ts timestamp_ntz"
    T.stream_daily_counts(spark, events, at("c", "out"), at("cc"), schema, "400 DAYS", max_files=1)
    assert T.read_window_counts(spark, at("c", "out"), "400 DAYS").agg({"record_count": "sum"}).first()[0] == fx.load(spark, SF, "events").count()


def log_rows(spark, rows):
    return spark.createDataFrame([(k, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), i, "") for i, (k, d) in enumerate(rows)], T.LOG_SCHEMA).coalesce(1)


def test_dedupe_forgets_keys_behind_the_horizon_and_counts_late_rows(spark):
    base = scratch_path(spark, "t-horizon")
    log, out, ckpt = (os.path.join(base, x) for x in ("log", "out", "ck"))
    keys = 30
    for day in range(0, 80, 4):  # new keys every time, one row far too late, one repeat within the horizon
        rows = [(f"k{day}-{i}", day) for i in range(keys)] + [(f"k{day}-0", day + 1)]
        rows += [("late", day - 30), (f"k{day - 4}-1", day)] if day >= 40 else []
        log_rows(spark, rows).write.mode("append").parquet(log)
        queries = T.stream_dedupe(spark, log, out, ckpt, 7)
    held = queries[1].lastProgress["stateOperators"][0]["numRowsTotal"]
    dropped = queries[1].lastProgress["stateOperators"][0]["numRowsDroppedByWatermark"]
    kept = spark.read.schema(T.LOG_SCHEMA).parquet(out)
    assert kept.count() == kept.select("record_key").distinct().count() == 20 * keys
    assert held <= 7 * keys and dropped == 0
    assert spark.read.parquet(os.path.join(base, "late")).where("record_key = 'late'").count() == 10
    log_rows(spark, [("k0-0", 90)]).write.mode("append").parquet(log)  # long after its horizon: a new row
    T.stream_dedupe(spark, log, out, ckpt, 7)
    assert spark.read.schema(T.LOG_SCHEMA).parquet(out).where("record_key = 'k0-0'").count() == 2


def test_a_replayed_batch_is_split_the_same_way(spark):
    base = scratch_path(spark, "t-replay")
    marks = os.path.join(base, "marks")
    first, second = log_rows(spark, [("a", 10)]), log_rows(spark, [("b", 1), ("c", 20)])
    split = lambda df, n: {r["record_key"]: r["late"] for r in T.split_late(df, n, marks, "written_at", "7 DAYS").collect()}
    assert split(first, 0) == {"a": False}
    for _ in range(2):
        assert split(second, 1) == {"b": True, "c": False}
    assert split(log_rows(spark, [("d", 14), ("e", 12), (None, 13)]), 2) == {"d": False, "e": True, None: False}


def test_last_writes_stay_in_few_files(spark):
    base = scratch_path(spark, "t-compact")
    log, out, ckpt = (os.path.join(base, x) for x in ("log", "out", "ck"))
    for i in range(50):
        log_rows(spark, [(f"k{i % 7}", i), ("hot", i)]).write.mode("append").parquet(log)
    T.stream_latest(spark, log, out, ckpt, max_files=1, compact_every=8)
    got = {r["record_key"]: (r["written_at"].timetuple().tm_yday, r["n_writes"]) for r in T.read_latest(spark, out).collect()}
    assert got == {"hot": (50, 50), **{f"k{j}": (max(i for i in range(50) if i % 7 == j) + 1, len(range(j, 50, 7))) for j in range(7)}}
    assert len(T._latest_paths(spark, out)) <= 8
    left = [d for d in os.listdir(out) if "=" in d]
    assert len(left) <= 2 * 8 + 2  # folders that an open reader may still read included
    # a reader that listed its folders before a compaction can still read them
    paths = T._latest_paths(spark, out)
    T.compact_latest(spark, out)
    assert T._combined(spark, paths).count() == 8 == T.read_latest(spark, out).count()
    T.compact_latest(spark, out)  # nothing new: nothing to do
    assert len(T._latest_paths(spark, out)) == 1


def test_base_leaves_out_expired_keys_and_unfinished_bases_are_not_read(spark):
    base = scratch_path(spark, "t-expire")
    log, out, ckpt = (os.path.join(base, x) for x in ("log", "out", "ck"))
    log_rows(spark, [("old", 0), ("new", 30)]).write.parquet(log)
    T.stream_latest(spark, log, out, ckpt)
    os.makedirs(os.path.join(out, "_base=99"))
    T.compact_latest(spark, out, dt.datetime(2024, 1, 20))
    assert [r["record_key"] for r in T.read_latest(spark, out).collect()] == ["new"]


def test_windows_close_behind_the_bound(spark):
    base = scratch_path(spark, "t-close")
    events, out, ckpt = (os.path.join(base, x) for x in ("events", "out", "ck"))
    land = lambda days: spark.createDataFrame([(dt.datetime(2024, 1, 1) + dt.timedelta(days=d),) for d in days], "ts timestamp_ntz").write.mode("append").parquet(events)
    for days in ([0, 0, 1], [5, 1, 0], [2, 1, 4]):
        land(days)
        T.stream_daily_counts(spark, events, out, ckpt, "ts timestamp_ntz", "3 DAYS")
    got = {(r["window_start"].day - 1): (r["record_count"], r["late_count"], r["closed"]) for r in T.read_window_counts(spark, out, "3 DAYS").collect()}
    assert got == {0: (3, 0, True), 1: (2, 1, True), 2: (1, 0, False), 4: (1, 0, False), 5: (1, 0, False)}
