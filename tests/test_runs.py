"""Ingestion and upload runs: failed days and sinks are recorded, then resumed."""

import datetime as dt
import re

from pyspark.sql import functions as F

from cohortix.operators import predictions as P
from cohortix.operators import upload_run as U
from cohortix.sources import ingest as I
from cohortix.sources import load_run as L

WHOLE = '{{"transaction_id": "{0}", "customer_id": "c", "_timestamp": "2024-01-0{1}T10:00:00", "amount": 1}}'
FIRST, SECOND, THIRD = "2024-02-01 00:00:00", "2024-02-02 00:00:00", "2024-02-03 00:00:00"


def lines_of(spark, lines):
    return spark.createDataFrame([(v,) for v in lines], "value string")


def test_every_landed_record_has_one_counted_outcome(spark, tmp_path):
    paths = L.LoadPaths.below(str(tmp_path))
    request = I.load_request("2024-01-01", "2024-01-03")
    broken = WHOLE.format("b", 2).replace("amount", "total")
    lines = [WHOLE.format("a", 1), WHOLE.format("a", 1), broken, WHOLE.format("x", 2), '{"transaction_id"', None, WHOLE.format("z", 9)]
    got = L.run_load(lines_of(spark, lines), paths, request, FIRST).collect()
    assert {(r.ledger_date.day, r.status, r.n_records) for r in got} == {(1, "completed", 2), (2, "failed", 0)}
    assert spark.read.parquet(paths.table).count() == 2  # repeated records are kept
    assert sorted(r.reason for r in spark.read.parquet(paths.rejects).collect()) == ["day not asked for", "no event time", "no event time"]
    lines[2] = WHOLE.format("b", 2)
    late, late_broken = WHOLE.format("late", 1), WHOLE.format("bad", 1).replace("amount", "total")
    got = L.run_load(lines_of(spark, [*lines, late, late_broken]), paths, request, SECOND).collect()
    assert sorted((r.ledger_date.day, r.status, r.n_records, r.n_late) for r in got) == [(1, "completed", 3, 1), (2, "completed", 2, 0)]
    assert spark.read.parquet(paths.table).count() == 5
    counted = {(r.run_at.day, r.outcome): r.n_records for r in L.read_outcomes(spark, paths.outcomes).collect()}
    assert counted == {
        (1, "loaded"): 2, (1, "held"): 2, (1, "no_time"): 2, (1, "outside"): 1,
        (2, "loaded"): 2, (2, "late"): 1, (2, "repeated"): 2, (2, "broken"): 1, (2, "no_time"): 2, (2, "outside"): 1,
    }
    assert L.run_load(lines_of(spark, []), paths, request, THIRD).count() == 0
    assert L.run_load(lines_of(spark, [late, WHOLE.format("a", 1)]), paths, request, "2024-02-04 00:00:00").count() == 0
    assert spark.read.parquet(paths.table).count() == 5


def test_a_day_that_cannot_be_written_does_not_stop_the_others(spark, tmp_path):
    paths = L.LoadPaths.below(str(tmp_path))
    request = I.load_request("2024-01-01", "2024-01-05")
    lines = [WHOLE.format(f"r{d}{i}", d) for d in range(1, 6) for i in range(3)]

    def typed(rows):
        small = F.get_json_object("json_body", "$.transaction_id").substr(2, 1)
        return rows.withColumn("digit", F.when(small == "3", F.lit("x")).otherwise(small).cast("int"))

    got = {r.ledger_date.day: r for r in L.run_load(lines_of(spark, lines), paths, request, FIRST, typed).collect()}
    assert {d: r.status for d, r in got.items()} == {1: "completed", 2: "completed", 3: "failed", 4: "completed", 5: "completed"}
    assert got[3].error.startswith("write failed: ") and got[3].n_records == 0
    assert spark.read.parquet(paths.table).count() == 12
    assert {r.outcome: r.n_records for r in L.read_outcomes(spark, paths.outcomes).collect()} == {"loaded": 12, "held": 3}
    again = L.run_load(lines_of(spark, lines), paths, request, SECOND).collect()
    assert [(r.ledger_date.day, r.n_records) for r in again] == [(3, 3)]


def scanned_files(df):
    """Files that the scan of ``df`` (without a shuffle) opened, and its partition filters."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    return leaf.metrics().apply("numFiles").value(), leaf.toString()


def test_a_load_reads_its_own_days_only(spark, tmp_path):
    path = str(tmp_path / "days")
    rows = lambda days, v: spark.createDataFrame(
        [(f"t{d}-{i}" if i else None, dt.datetime(2024, 1, d, i), v, dt.datetime(2024, 2, 1)) for d in days for i in range(4)],
        "unique_transaction_id string, transaction_timestamp timestamp_ntz, status string, _ingestion_timestamp timestamp_ntz")
    assert I.write_day_partitioned(rows(range(1, 31), "a"), path).rows == 120
    files, text = scanned_files(I.in_days(spark.read.parquet(path), [dt.date(2024, 1, 7)]))
    assert files == 1 and re.search(r"PartitionFilters: \[[^\]]*(2024-01-07|19729)", text)
    before = {r.d: r.f for r in spark.read.parquet(path).select("d", F.input_file_name().alias("f")).collect()}
    wrote = I.write_day_partitioned(rows([7], "a"), path)
    after = {r.d: r.f for r in spark.read.parquet(path).select("d", F.input_file_name().alias("f")).collect()}
    assert wrote.days == (dt.date(2024, 1, 7),) and wrote.rows == 4
    assert [d for d in before if before[d] != after[d]] == [dt.date(2024, 1, 7)]


def test_rows_without_a_key_are_neither_doubled_nor_lost(spark, tmp_path):
    path = str(tmp_path / "days")
    schema = "unique_transaction_id string, transaction_timestamp timestamp_ntz, status string, _ingestion_timestamp timestamp_ntz"
    at = dt.datetime(2024, 1, 1)
    rows = lambda values, run: spark.createDataFrame([(None, at, v, dt.datetime(2024, 2, run)) for v in values], schema)
    assert I.write_day_partitioned(rows("", 1), path).days == ()  # nothing landed
    I.write_day_partitioned(rows("aab", 1), path)
    I.write_day_partitioned(rows("aab", 2), path)  # a rerun
    I.write_day_partitioned(rows("c", 3), path)  # late
    I.write_day_partitioned(rows("c", 4).withColumn("extra", F.lit(None).cast("int")), path)  # again, with a new column
    assert sorted(r.status for r in spark.read.parquet(path).collect()) == ["a", "a", "b", "c"]
    I.write_day_partitioned(spark.createDataFrame([(None, None, "no day", at)], schema), path)
    I.write_day_partitioned(spark.createDataFrame([(None, None, "no day", at)], schema), path)
    assert spark.read.parquet(path).count() == 5


def test_failing_sink_keeps_its_keys_pending(spark, tmp_path):
    at = dt.datetime(2024, 1, 30)
    live = spark.createDataFrame([("pred:1", at, "{}"), ("tx:1", at, "{}"), ("tx:2", at, "bad")], "record_key string, written_at timestamp_ntz, payload string")

    def sinks(contract):
        return {"p": U.Sink(P.PRED_PREFIX, P.route_predictions, f"{tmp_path}/p"),
                "t": U.Sink(P.TX_PREFIX, P.route_transactions, f"{tmp_path}/t", contract)}

    marks, runs = f"{tmp_path}/marks", f"{tmp_path}/runs"
    first = U.run_upload(live, sinks(F.col("payload") != "bad"), marks, runs, FIRST)
    assert {(r.sink, r.rows_uploaded, r.success) for r in first.collect()} == {("p", 1, True), ("t", 0, False)}
    assert P.health_status(U.sink_services(first)).first().overall_status == "critical"
    left = P.pending(live, U.read_marks(spark, marks))
    assert {r.record_key for r in left.collect()} == {"tx:1", "tx:2"}
    second = U.run_upload(left, sinks(None), marks, runs, SECOND)
    assert {(r.sink, r.rows_uploaded, r.success) for r in second.collect()} == {("p", 0, True), ("t", 2, True)}
    assert P.health_status(U.sink_services(second)).first().overall_status == "healthy"
    assert P.pending(live, U.read_marks(spark, marks)).count() == 0
