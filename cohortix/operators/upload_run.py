"""A daily upload run: pending cache records appended to their sinks.

Every figure of the summary is read back from what the run wrote.  A sink that
fails leaves its keys pending and shows as an error of that run; the others go
on.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.functions.dates import ts_lit
from cohortix.sources.ingest import scratch_path

MARKS_SCHEMA = "record_key string, uploaded_at timestamp_ntz"
RUNS_SCHEMA = "run_at timestamp_ntz, sink string, pending_rows bigint, rows_uploaded bigint, success boolean, error string"


@dataclass(frozen=True)
class Sink:
    """Keys starting with ``prefix``, as ``form`` makes them, appended to
    ``path``; ``contract`` must hold for every row or the append fails."""

    prefix: str
    form: Callable[[DataFrame, str], DataFrame]
    path: str
    contract: Column | None = None


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """Keys uploaded so far, once each."""
    try:
        marks = spark.read.schema(MARKS_SCHEMA).parquet(path)
    except AnalysisException:  # nothing uploaded yet
        return spark.createDataFrame([], MARKS_SCHEMA)
    return marks.groupBy("record_key").agg(F.max("uploaded_at").alias("uploaded_at"))


def _append(rows: DataFrame, sink: Sink, run_at: str) -> int:
    """Append a run's rows (a repeated run replaces its own) and count them as stored."""
    if sink.contract is not None:
        broken = F.raise_error(F.lit(f"a row for {sink.path} breaks the sink's contract")).cast("string")
        kept = F.when(F.coalesce(sink.contract, F.lit(False)), F.col("payload")).otherwise(broken)
        rows = rows.withColumn("payload", kept)
    folder = f"{sink.path}/run={re.sub('[^0-9]', '', run_at)}"
    sink.form(rows, run_at).write.mode("overwrite").parquet(folder)
    return rows.sparkSession.read.parquet(folder).count()


def run_upload(pending: DataFrame, sinks: dict[str, Sink], marks: str, runs: str, run_at: str) -> DataFrame:
    """Upload ``pending`` (record_key, written_at, payload) and return the
    run's summary: one row a sink.  The queue is stored first, so all sinks and
    the marks see the same rows; marks are added for stored sinks only."""
    spark = pending.sparkSession
    queue_path = scratch_path(spark, "upload-queue")
    pending.select("record_key", "written_at", "payload").write.parquet(queue_path)
    queue = spark.read.parquet(queue_path)
    report = []
    for name, sink in sinks.items():
        rows = queue.filter(F.col("record_key").startswith(sink.prefix))
        n, stored, error = rows.count(), 0, None
        try:
            if n:
                stored = _append(rows, sink, run_at)
        except (PySparkException, Py4JJavaError) as failure:
            error = type(failure).__name__
        if error is None and stored != n:
            error = f"{stored} rows stored of {n}"
        if error is None and n:
            rows.select("record_key", ts_lit(run_at).alias("uploaded_at")).write.mode("append").parquet(marks)
        report.append((name, n, stored, error is None, error))
    summary = spark.createDataFrame(report, "sink string, pending_rows bigint, rows_uploaded bigint, success boolean, error string")
    summary.select(ts_lit(run_at).alias("run_at"), "*").write.mode("append").parquet(runs)
    return spark.read.schema(RUNS_SCHEMA).parquet(runs).filter(F.col("run_at") == ts_lit(run_at))


def sink_services(summary: DataFrame) -> DataFrame:
    """(service, status) rows of a run: a sink that failed is in error."""
    return summary.select(F.col("sink").alias("service"), F.when(F.col("success"), "healthy").otherwise("error").alias("status"))
