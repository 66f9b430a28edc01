"""Landing-zone ingestion: event-stream parsing, raw envelopes, day-partitioned
writes, verification and the resume ledger.

The source system loops over dates on one machine and calls a remote API per
batch; here a landing folder is read once, days are partitions, and the
ledger is a small table updated only after a write commits.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from cohortix.params import MAX_DAILY_VOLUME, MIN_INGEST_YEAR, REQUIRED_FIELDS
from cohortix.session import checkpoint_dir

ENVELOPE_SCHEMA = "_timestamp timestamp_ntz, json_body string, _ingestion_timestamp timestamp_ntz"
CLUSTER_COLUMNS = ("customer_id", "risk_level", "status")
# stamped by a load; the same record brings other values when it is loaded again
AUDIT_COLUMNS = ("_ingestion_timestamp", "_loaded_at")


# ---------------------------------------------------------------------------
# Argument validation of the ingestion entry points
# ---------------------------------------------------------------------------

@dataclass(frozen=True)
class LoadRequest:
    """Days (first to last) and rows a day that a load may ask for."""

    first: date
    last: date
    daily_rows: int | None = None


def load_request(
    first: str,
    last: str,
    daily_rows: int | None = None,
    *,
    earliest: date = date(MIN_INGEST_YEAR, 1, 1),
    latest: date | None = None,
    max_daily_rows: int = MAX_DAILY_VOLUME,
) -> LoadRequest:
    """The request, or one ValueError that lists all that is wrong with it.

    ``latest`` defaults to the end of next year."""
    latest = latest or date(date.today().year + 1, 12, 31)
    days, wrong = {}, []
    for name, text in (("first", first), ("last", last)):
        try:
            days[name] = date.fromisoformat(text)
        except ValueError:
            wrong.append(f"{name} day {text!r} is not an ISO date")
            continue
        if not earliest <= days[name] <= latest:
            wrong.append(f"{name} day {text} lies outside {earliest} to {latest}")
    if len(days) == 2 and days["last"] < days["first"]:
        wrong.append(f"{last} comes before {first}")
    if daily_rows is not None and not 0 < daily_rows <= max_daily_rows:
        wrong.append(f"{daily_rows} rows a day is not within 1 to {max_daily_rows}")
    if wrong:
        raise ValueError("; ".join(wrong))
    return LoadRequest(days["first"], days["last"], daily_rows)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------------------
# Event-stream text -> JSON records
# ---------------------------------------------------------------------------

def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Landed API responses as text lines (one column ``value``)."""
    return spark.read.text(path)


def sse_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Keep ``data: `` lines, strip the prefix, keep documents that parse.

    Returns (record, valid); invalid lines are kept with valid=False so that
    callers can count or quarantine them (the source logs and skips)."""
    t = F.trim(F.col(column))
    data = lines.filter(t.startswith("data: ")).select(F.substr(t, F.lit(7)).alias("record"))
    return data.select("record", F.try_parse_json("record").isNotNull().alias("valid"))


def parse_body(bodies: DataFrame, column: str = "value") -> tuple[DataFrame, Observation]:
    """Whole response bodies, of many lines or one: an event stream when a line
    starts with ``data: ``, otherwise a JSON array or a single object.

    One row per record, with the other columns of the body.  What does not parse
    (a data line, an element, or a body as a whole) is left out and counted, with
    the records, in the same pass: the observation has ``records`` and ``bad``
    once an action has run over the rows."""
    body = F.col(column)
    data = F.filter(F.split(body, "\r?\n"), lambda line: F.ltrim(line).startswith("data: "))
    stream = F.transform(data, lambda line: F.substr(F.trim(line), F.lit(7)))
    # an array that is cut short has no elements: the body is one bad record
    elements = F.coalesce(F.from_json(body, "array<string>", {"mode": "PERMISSIVE"}), F.array(F.lit(None).cast("string")))
    whole = F.when(F.ltrim(body).startswith("["), elements).otherwise(F.array(F.trim(body)))
    records = F.when(F.size(data) > 0, stream).otherwise(whole)
    rest = [c for c in bodies.columns if c != column]
    rows = bodies.filter(body.isNotNull() & (F.trim(body) != "")).select(*rest, F.explode(records).alias("record"))
    rows = rows.withColumn("_good", F.try_parse_json("record").isNotNull())
    seen = Observation("bodies")
    rows = rows.observe(seen, F.count_if("_good").alias("records"), F.count_if(~F.col("_good")).alias("bad"))
    return rows.filter("_good").drop("_good"), seen


# ---------------------------------------------------------------------------
# Envelopes and required fields
# ---------------------------------------------------------------------------

def parse_event_time(text: F.Column) -> F.Column:
    """ISO text with 'Z', an offset, or naive (taken as UTC) -> UTC wall clock."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def raw_envelope(records: DataFrame, run_at: str, column: str = "value", mode: str = "fail") -> DataFrame:
    """(_timestamp, json_body, _ingestion_timestamp) per record.

    mode='fail' raises on a record without a parseable ``_timestamp`` (the
    source's behaviour); mode='quarantine' returns the good rows only - use
    :func:`envelope_rejects` for the others."""
    ts = parse_event_time(F.get_json_object(F.col(column), "$._timestamp"))
    if mode == "fail":
        ts = F.when(ts.isNull(), F.raise_error(F.lit("Missing or invalid required field '_timestamp'"))).otherwise(ts)
    out = records.select(
        ts.alias("_timestamp"), F.col(column).alias("json_body"),
        F.to_timestamp_ntz(F.lit(run_at)).alias("_ingestion_timestamp"),
    )
    return out if mode == "fail" else out.filter(F.col("_timestamp").isNotNull())


def envelope_rejects(records: DataFrame, column: str = "value") -> DataFrame:
    ts = parse_event_time(F.get_json_object(F.col(column), "$._timestamp"))
    return records.filter(ts.isNull())


def required_fields(records: DataFrame, column: str = "value", fields=REQUIRED_FIELDS) -> DataFrame:
    """Missing required keys over *all* records (the source checks only the
    first one)."""
    keys = F.json_object_keys(F.col(column))
    aggs = [F.count(F.lit(1)).alias("total_records")]
    for f in fields:
        aggs.append(F.count_if(~F.coalesce(F.array_contains(keys, f), F.lit(False))).alias(f"missing{f if f.startswith('_') else '_' + f}"))
    out = records.agg(*aggs)
    miss = [c for c in out.columns if c.startswith("missing")]
    ok = None
    for c in miss:
        ok = (F.col(c) == 0) if ok is None else (ok & (F.col(c) == 0))
    return out.withColumn("passed", ok)


# ---------------------------------------------------------------------------
# Writes, verification, partitioned layout
# ---------------------------------------------------------------------------

# Microsecond timestamps in JSON text (the writer default keeps milliseconds).
JSON_TS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
           "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def append_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("append").options(**JSON_TS).json(path)


def read_ndjson(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Newline JSON; with ``schema`` None the schema is inferred by a distributed
    pass over all files: fields that later appends brought are null in earlier
    rows, whole numbers beside fractions become doubles, and what conflicts
    otherwise becomes text."""
    reader = spark.read.options(**JSON_TS)
    if schema:
        reader = reader.schema(schema)
    return reader.json(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Truncate-and-write."""
    df.write.mode("overwrite").parquet(path)


@dataclass(frozen=True)
class DayWrite:
    """What a load wrote: its days (None: rows without a time) and its rows."""

    days: tuple[date | None, ...]
    rows: int


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # nothing loaded yet
        return None


def in_days(df: DataFrame, days, column: str = "d") -> DataFrame:
    """Rows of the given days; on a day-partitioned table this is a partition
    filter, so no other day is read."""
    known = [F.lit(d) for d in days if d is not None]
    keep = F.col(column).isin(known) if known else F.lit(False)
    return df.filter(keep | F.col(column).isNull() if None in days else keep)


def merge_id(df: DataFrame, key: str, audit=AUDIT_COLUMNS) -> F.Column:
    """Identity of a row in a merge: its key or, where that is null, a digest of
    all its values but the audit columns.  Fields that are null leave no trace in
    the digest, so rows stored before a column was added keep their identity."""
    values = sorted(c for c in df.columns if c not in (*audit, "d", key))
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.concat(F.lit("r"), F.md5(F.to_json(F.struct(*values)))))


def write_day_partitioned(staged: DataFrame, path: str, ts_column: str = "transaction_timestamp",
                          cluster=CLUSTER_COLUMNS, key: str = "unique_transaction_id", audit=AUDIT_COLUMNS, days=None) -> DayWrite:
    """Day-partitioned, clustered write that merges into the days it touches.

    The days of the batch (bounded by what a load may ask for) become a partition
    filter on the stored table, so a load reads and rewrites its own days only.
    Rows stored for them stay unless the batch brings the same :func:`merge_id`
    again: a late load adds to its days, and a rerun changes nothing, rows
    without a key included.  A later batch whose ``days`` are not given is staged
    once to find them; one that is a stored table already need not be.  Merged days
    are read and replaced in one job: with dynamic partition overwrite Spark
    moves them in place after the job, when they have been read.  Days are
    rebalanced before the write, so a hot day is split and small ones are joined.
    """
    spark = staged.sparkSession
    obs = Observation("written")
    cols = [c for c in cluster if c in staged.columns]
    if key not in staged.columns:
        raise ValueError(f"a day-partitioned load needs the column {key}")
    out, stored = staged.withColumn("d", F.to_date(ts_column)), stored_table(spark, path)
    if days is None and stored is not None:
        batch = scratch_path(spark, "day-batch")
        out.write.parquet(batch)
        out = spark.read.parquet(batch)
        days = [r["d"] for r in out.select("d").distinct().collect()]
    batch = out
    out = out.observe(obs, F.count(F.lit(1)).alias("rows_written"))
    if stored is not None:
        earlier = in_days(stored, days)
        ids = batch.select(merge_id(batch, key, audit).alias("_merge_id")).distinct()
        earlier = earlier.withColumn("_merge_id", merge_id(earlier, key, audit)).join(ids, "_merge_id", "left_anti").drop("_merge_id")
        out = out.unionByName(earlier, allowMissingColumns=True)
    out = out.hint("rebalance", "d").sortWithinPartitions("d", *cols)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("d").parquet(path)
    if days is None:  # the first load: its days are those of the table
        written = stored_table(spark, path)
        days = [] if written is None else [r["d"] for r in written.select("d").distinct().collect()]
    return DayWrite(tuple(days), obs.get["rows_written"] if days else 0)


def read_partitioned(spark: SparkSession, path: str, start: str | None, end: str | None) -> DataFrame:
    """Scan with a mandatory partition filter (the table requires one)."""
    if not start or not end:
        raise ValueError("a partition filter on d (start and end date) is required")
    validate_span = datetime.strptime(start, "%Y-%m-%d") <= datetime.strptime(end, "%Y-%m-%d")
    if not validate_span:
        raise ValueError("end date before start date")
    return spark.read.parquet(path).filter(F.col("d").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def load_verification(source: DataFrame, loaded: DataFrame, source_ts: str, loaded_day: str = "d") -> DataFrame:
    """Per day: expected rows (source) vs rows found after the load."""
    exp = source.groupBy(F.to_date(source_ts).alias("load_date")).agg(F.count(F.lit(1)).alias("expected_rows"))
    got = loaded.groupBy(F.col(loaded_day).alias("load_date")).agg(F.count(F.lit(1)).alias("loaded_rows"))
    j = exp.join(got, "load_date", "full")
    return j.select(
        "load_date",
        F.coalesce("expected_rows", F.lit(0)).alias("expected_rows"),
        F.coalesce("loaded_rows", F.lit(0)).alias("loaded_rows"),
    ).withColumn("verified", F.col("expected_rows") == F.col("loaded_rows"))


# ---------------------------------------------------------------------------
# ledger
# ---------------------------------------------------------------------------

def ledger_latest(ledger: DataFrame) -> DataFrame:
    """Latest status per date (append-only ledger, last write wins)."""
    return ledger.groupBy("ledger_date").agg(
        F.max_by("status", F.struct("updated_at", "status")).alias("status"),
        F.max_by("n_records", F.struct("updated_at", "status")).alias("n_records"),
        F.max("updated_at").alias("updated_at"),
    )


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day (bounded by the requested range, not by data)."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("ledger_date")
    )


def calendar_of(df: DataFrame, ts_column: str) -> DataFrame:
    """One row per day from the first to the last day of ``df``."""
    span = df.agg(F.min(F.to_date(ts_column)).alias("first"), F.max(F.to_date(ts_column)).alias("last"))
    return span.filter("first IS NOT NULL").select(F.explode(F.sequence("first", "last")).alias("ledger_date"))


def remaining_dates(days: DataFrame, ledger: DataFrame) -> DataFrame:
    """Days of the calendar that the ledger does not hold as completed."""
    done = ledger_latest(ledger).filter(F.col("status") == "completed").select("ledger_date")
    return days.join(done, "ledger_date", "left_anti")


def date_batches(remaining: DataFrame, batch_days: int) -> DataFrame:
    """Contiguous runs of remaining dates cut into batches of at most
    ``batch_days`` (gaps start a new batch, so completed days in between are
    never refetched).  The window runs over calendar rows only."""
    w = Window.orderBy("ledger_date")
    isl = remaining.withColumn("_rn", F.row_number().over(w)).withColumn(
        "_island", F.date_sub("ledger_date", F.col("_rn").cast("int"))
    )
    wi = Window.partitionBy("_island").orderBy("ledger_date")
    isl = isl.withColumn("_k", F.floor((F.row_number().over(wi) - 1) / F.lit(batch_days)))
    return isl.groupBy("_island", "_k").agg(
        F.min("ledger_date").alias("batch_start"),
        F.max("ledger_date").alias("batch_end"),
        F.count(F.lit(1)).alias("n_days"),
        F.array_sort(F.collect_list("ledger_date")).alias("dates"),
    ).drop("_island", "_k")


def ingestion_summary(ledger: DataFrame) -> DataFrame:
    latest = ledger_latest(ledger)
    return latest.agg(
        F.count(F.lit(1)).alias("days_tracked"),
        F.count_if(F.col("status") == "completed").alias("completed_days"),
        F.count_if(F.col("status") == "failed").alias("failed_days"),
        F.sum(F.when(F.col("status") == "completed", F.col("n_records")).otherwise(0)).alias("total_records_ingested"),
    ).withColumn("status", F.when(F.col("failed_days") == 0, "completed").otherwise("partial"))
