"""A whole ingestion run: landed lines to day partitions, with every landed record
accounted for, per-day verification and ledger rows.

Days are the unit of success.  Each landed record has one outcome:

* ``loaded``    stored in a day that was open
* ``late``      stored in a day that an earlier run had completed
* ``repeated``  of a completed day and stored before: nothing to do
* ``held``      of an open day that has a broken record or could not be written;
                the day stays open and the next run takes it again
* ``broken``    of a completed day, lacks a required field: reject sink
* ``outside``   of a day that was not asked for: reject sink
* ``no_time``   without an event time: reject sink

The outcomes of a run are counted in a table of their own and add up to what
landed.  All days are written in one job; if that fails, each day is written by
itself, so the days that cannot be written are recorded as failed and the others
go on.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.functions.dates import ts_lit
from cohortix.params import REQUIRED_FIELDS
from cohortix.sources.ingest import LoadRequest, in_days, ledger_latest, parse_event_time, scratch_path, stored_table, write_day_partitioned

LEDGER_SCHEMA = "ledger_date date, status string, n_records bigint, n_late bigint, updated_at timestamp_ntz, error string"
OUTCOME_SCHEMA = "run_at timestamp_ntz, outcome string, n_records bigint"
REASONS = {"broken": "lacks required fields", "outside": "day not asked for", "no_time": "no event time"}


@dataclass(frozen=True)
class LoadPaths:
    """Stored tables of the run, all in folders that the executors share."""

    table: str
    ledger: str
    rejects: str
    outcomes: str

    @staticmethod
    def below(home: str) -> LoadPaths:
        return LoadPaths(*(f"{home}/{name}" for name in ("table", "ledger", "rejects", "outcomes")))


def read_stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:  # no run yet
        return spark.createDataFrame([], schema)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path, LEDGER_SCHEMA)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    return read_stored(spark, path, OUTCOME_SCHEMA)


def checked_records(landed: DataFrame, required=REQUIRED_FIELDS, column: str = "value") -> DataFrame:
    """(record, record_id, ts, d, whole): the event time and whether the record is
    a JSON object with all required fields.  Without a time a record has no day."""
    record = F.col(column)
    keys = F.json_object_keys(record)
    whole = F.lit(True)
    for field in required:
        whole = whole & F.coalesce(F.array_contains(keys, field), F.lit(False))
    ts = parse_event_time(F.get_json_object(record, "$._timestamp"))
    return landed.select(record.alias("record"), F.md5(record).alias("record_id"), ts.alias("ts"), F.to_date(ts).alias("d"), whole.alias("whole"))


def _with_outcome(batch: DataFrame, days: dict[date, str], table: DataFrame | None) -> DataFrame:
    """``batch`` with an outcome for each record, as far as it is known before the
    write.  ``days`` (bounded by the request) tells for each landed day whether it
    is open, held or done."""
    spark = batch.sparkSession
    states = spark.createDataFrame(list(days.items()), "d date, state string")
    out = batch.join(F.broadcast(states), "d", "left")
    done = [d for d, state in days.items() if state == "done"]
    if table is not None and done:
        known = in_days(table, done).select("d", "record_id").distinct().withColumn("known", F.lit(True))
        out = out.join(known, ["d", "record_id"], "left")
    else:
        out = out.withColumn("known", F.lit(None).cast("boolean"))
    outcome = (
        F.when(F.col("ts").isNull(), "no_time").when(F.col("state").isNull(), "outside").when(F.col("state") == "held", "held")
        .when(F.col("state") == "open", "loaded").when(F.col("known"), "repeated").when(F.col("whole"), "late").otherwise("broken")
    )
    return out.select("record", "record_id", "ts", "d", outcome.alias("outcome"))


def _reason(error: Exception) -> str:
    lines = str(error).strip().splitlines()
    return f"write failed: {lines[0][:300] if lines else type(error).__name__}"


def _write_days(rows: DataFrame, path: str, days: list[date]) -> dict[date, str]:
    """Writes all days, or each by itself if that fails; days that failed with the reason."""
    def write(some: DataFrame, those: list[date]) -> None:
        write_day_partitioned(some, path, ts_column="_timestamp", cluster=(), key="record_id", days=those)

    try:
        write(rows, days)
        return {}
    except (PySparkException, Py4JError):
        failed = {}
    for day in days:
        try:
            write(rows.filter(F.to_date("_timestamp") == F.lit(day)), [day])
        except (PySparkException, Py4JError) as error:
            failed[day] = _reason(error)
    return failed


def run_load(landed: DataFrame, paths: LoadPaths, request: LoadRequest, run_at: str, shape: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Load the landed records of the days of ``request``; returns this run's
    ledger rows.

    ``shape`` adds columns to the rows (record_id, _timestamp, json_body,
    _ingestion_timestamp) before they are stored; what it raises counts as a
    failed write of the days concerned.  Rejects go to one folder a run, replaced
    when the run is repeated.  A day with a broken record is not written at all.
    Days that nothing was stored in and nothing failed for get no ledger row."""
    spark = landed.sparkSession
    stamp = ts_lit(run_at)
    batch_path = scratch_path(spark, "load-batch")
    checked_records(landed).write.parquet(batch_path)
    batch = spark.read.parquet(batch_path)

    asked = F.col("d").between(F.lit(request.first), F.lit(request.last))
    seen = batch.filter(asked).groupBy("d").agg(F.count_if(~F.col("whole")).alias("broken")).collect()
    ledger = ledger_latest(read_ledger(spark, paths.ledger)).filter((F.col("status") == "completed") & F.col("ledger_date").between(F.lit(request.first), F.lit(request.last)))
    done = {r["ledger_date"] for r in ledger.select("ledger_date").collect()}
    days = {r["d"]: "done" if r["d"] in done else "held" if r["broken"] else "open" for r in seen}
    errors = {r["d"]: f"{r['broken']} records lack required fields" for r in seen if days[r["d"]] == "held"}

    sorted_path = scratch_path(spark, "load-outcomes")
    _with_outcome(batch, days, stored_table(spark, paths.table)).write.parquet(sorted_path)
    sorted_out = spark.read.parquet(sorted_path)
    counts = {(r["outcome"], r["d"]): r["n"] for r in sorted_out.groupBy("outcome", F.when(asked, F.col("d")).alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}

    why = F.create_map(*[F.lit(x) for kv in REASONS.items() for x in kv])
    rejects = sorted_out.filter(F.col("outcome").isin(*REASONS)).select("record", why[F.col("outcome")].alias("reason"))
    rejects.write.mode("overwrite").parquet(f"{paths.rejects}/run={re.sub('[^0-9]', '', run_at)}")

    touched = sorted({d for (outcome, d) in counts if outcome in ("loaded", "late")})
    rows = sorted_out.filter(F.col("outcome").isin("loaded", "late")).select(
        "record_id", F.col("ts").alias("_timestamp"), F.col("record").alias("json_body"), stamp.alias("_ingestion_timestamp"),
    )
    failed = _write_days(shape(rows) if shape else rows, paths.table, touched) if touched else {}
    errors |= failed
    counts = _after_write(counts, failed)

    table = stored_table(spark, paths.table)
    written = [d for d in touched if d not in failed]
    found = {}
    if table is not None and written:
        ids = in_days(rows.select("record_id", F.to_date("_timestamp").alias("d")).distinct(), written)
        back = in_days(table, written).join(ids.withColumn("own", F.lit(True)), ["d", "record_id"], "left")
        found = {r["d"]: (r["own"], r["n"]) for r in back.groupBy("d").agg(F.count("own").alias("own"), F.count(F.lit(1)).alias("n")).collect()}
    entries = []
    for d in sorted({*touched, *errors}):
        landed_rows = sum(counts.get((o, d), 0) for o in ("loaded", "late"))
        own, n = found.get(d, (0, 0))
        error = errors.get(d) or (f"{own} rows stored, {landed_rows} landed" if own != landed_rows else None)
        # a finished day that late records could not be written to is open again
        status = "completed" if error is None else "failed"
        entries.append((d, status, n if error is None else 0, counts.get(("late", d), 0), error))
    made = spark.createDataFrame(entries, "ledger_date date, status string, n_records bigint, n_late bigint, error string")
    made.select("ledger_date", "status", "n_records", "n_late", stamp.alias("updated_at"), "error").write.mode("append").parquet(paths.ledger)
    totals: dict[str, int] = {}
    for (outcome, _), n in counts.items():
        totals[outcome] = totals.get(outcome, 0) + n
    spark.createDataFrame(list(totals.items()), "outcome string, n_records bigint").select(
        stamp.alias("run_at"), "outcome", "n_records").write.mode("append").parquet(paths.outcomes)
    return read_ledger(spark, paths.ledger).filter(F.col("updated_at") == stamp)


def _after_write(counts: dict, failed: dict[date, str]) -> dict:
    """Records of days that could not be written are held for the next run."""
    out: dict = {}
    for (outcome, d), n in counts.items():
        now = "held" if d in failed and outcome in ("loaded", "late") else outcome
        out[now, d] = out.get((now, d), 0) + n
    return out
