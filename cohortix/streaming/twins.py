"""Structured Streaming twins of batch operators.

* ``stream_ingest``   landed JSON lines -> raw envelope -> day-partitioned
  parquet, and what can't be enveloped -> a reject table; the streaming
  checkpoint replaces the resume ledger.
* ``stream_route``    keyed write log -> two sinks through ``foreachBatch``.
* ``stream_gate``     rows beyond a bound behind the newest event go to a late
  sink, where they can be counted, instead of being dropped unseen.
* ``stream_dedupe``   one row per key within a horizon, behind such a gate.
* ``stream_latest``   last write per key: every micro-batch is combined per key
  before it is stored, the stored rows are combined on read and merged into a
  keyed base now and then.
* ``stream_daily_counts`` tumbling one-day windows, in time and late.

Which rows are late depends on what has landed before them; apart from that,
results do not depend on how the input falls into micro-batches.  Sinks write
``_batch=<id>`` folders, so a batch that is replayed after a failure rewrites
its folder instead of adding to it.  All queries run with ``availableNow`` in
tests (process what has landed, then stop); on a cluster the same builders run
with a processing-time trigger.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortix.sources.ingest import envelope_rejects, raw_envelope

LOG_SCHEMA = "record_key string, written_at timestamp_ntz, seq bigint, payload string"


def _run(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:  # pragma: no cover - surfaced to caller
        raise query.exception()


def _writer(df: DataFrame, ckpt: str, available_now: bool):
    w = df.writeStream.option("checkpointLocation", ckpt)
    return w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")


def _limited(reader, max_files: int | None):
    return reader.option("maxFilesPerTrigger", max_files) if max_files else reader


# ---------------------------------------------------------------------------
# T1
# ---------------------------------------------------------------------------

def stream_ingest(spark: SparkSession, landing: str, out: str, ckpt: str, run_at: str, rejects: str,
                  max_files: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Envelopes go to ``out``, lines without a usable ``_timestamp`` to ``rejects``."""
    lines = _limited(spark.readStream, max_files).text(landing)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        env = raw_envelope(batch, run_at, "value", mode="quarantine").withColumn("d", F.to_date("_timestamp"))
        env.hint("rebalance", "d").write.mode("overwrite").partitionBy("d").parquet(os.path.join(out, f"_batch={batch_id}"))
        envelope_rejects(batch).write.mode("overwrite").parquet(os.path.join(rejects, f"_batch={batch_id}"))
        batch.unpersist()

    q = _writer(lines, ckpt, available_now).foreachBatch(sink).start()
    if available_now:
        _run(q)
    return q


# ---------------------------------------------------------------------------
# T2
# ---------------------------------------------------------------------------

def stream_route(spark: SparkSession, log_dir: str, preds_out: str, tx_out: str, ckpt: str, run_at: str,
                 max_files: int | None = None, available_now: bool = True) -> StreamingQuery:
    src = _limited(spark.readStream.schema(LOG_SCHEMA), max_files).parquet(log_dir)

    def route_batch(batch: DataFrame, batch_id: int) -> None:
        # One read of the micro-batch feeds both sinks.
        stamped = batch.withColumn("_ingestion_timestamp", F.to_timestamp_ntz(F.lit(run_at))).persist()
        stamped.filter(F.col("record_key").startswith("pred:")).write.mode("overwrite").parquet(
            os.path.join(preds_out, f"_batch={batch_id}"))
        stamped.filter(F.col("record_key").startswith("tx:")).select(
            F.col("written_at").alias("_timestamp"), F.col("payload").alias("json_body"), "_ingestion_timestamp",
        ).write.mode("overwrite").parquet(os.path.join(tx_out, f"_batch={batch_id}"))
        stamped.unpersist()

    q = _writer(src, ckpt, available_now).foreachBatch(route_batch).start()
    if available_now:
        _run(q)
    return q


# ---------------------------------------------------------------------------
# Late rows: a gate that knows how far event time has come
# ---------------------------------------------------------------------------

def _batch_dirs(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished ``_batch=`` folders below ``path``, by Hadoop's file system."""
    return _numbered(spark, path, "_batch=")


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith(prefix) and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(name[len(prefix):]))
    return sorted(found)


def _drop_dirs(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _clock(spark: SparkSession, marks: str, batch_id: int):
    """Newest event time of all batches before ``batch_id``; None at the start.
    Each mark holds the newest time so far, so one small file is read."""
    earlier = [b for b in _batch_dirs(spark, marks) if b < batch_id]
    return spark.read.parquet(os.path.join(marks, f"_batch={earlier[-1]}")).first()["newest"] if earlier else None


def split_late(batch: DataFrame, batch_id: int, marks: str, ts: str, bound: str) -> DataFrame:
    """``batch`` with ``late``: whether a row lies more than ``bound`` (an
    interval) behind the newest event of earlier batches, and ``newest``: how far
    event time has come with this batch.  The clock is kept in ``marks``, one row
    a batch, so a replayed batch is split the same way."""
    spark = batch.sparkSession
    clock = _clock(spark, marks, batch_id)
    own = batch.agg(F.max(ts).alias("newest"))
    if clock is not None:
        own = own.select(F.greatest("newest", F.lit(clock)).alias("newest"))
    own.coalesce(1).write.mode("overwrite").parquet(os.path.join(marks, f"_batch={batch_id}"))
    # only the newest earlier mark is needed to replay this batch
    _drop_dirs(spark, [os.path.join(marks, f"_batch={b}") for b in _batch_dirs(spark, marks) if b < batch_id - 1])
    newest = spark.read.parquet(os.path.join(marks, f"_batch={batch_id}")).first()["newest"]
    late = F.lit(False) if clock is None else F.coalesce(F.col(ts) < F.lit(clock) - F.expr(f"INTERVAL {bound}"), F.lit(False))
    return batch.withColumns({"late": late, "newest": F.lit(newest).cast("timestamp_ntz")})


def stream_gate(src: DataFrame, on_time: str, late: str, ckpt: str, ts: str, bound: str, available_now: bool = True) -> StreamingQuery:
    """Rows of a stream within ``bound`` of the newest event go to ``on_time``, with
    ``newest`` as their event-time clock; later ones to ``late``.  No row is lost
    on the way, whatever a stateful operator behind the gate would drop."""
    marks = os.path.join(os.path.dirname(on_time), "_marks")

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        rows = split_late(batch, batch_id, marks, ts, bound)
        rows.filter("NOT late").drop("late").write.mode("overwrite").parquet(os.path.join(on_time, f"_batch={batch_id}"))
        rows.filter("late").drop("late").write.mode("overwrite").parquet(os.path.join(late, f"_batch={batch_id}"))
        batch.unpersist()

    q = _writer(src, ckpt, available_now).foreachBatch(sink).start()
    if available_now:
        _run(q)
    return q


# ---------------------------------------------------------------------------
# First write within the horizon / last write with compaction
# ---------------------------------------------------------------------------

def stream_dedupe(spark: SparkSession, log_dir: str, out: str, ckpt: str, ttl_days: int,
                  max_files: int | None = None, available_now: bool = True) -> list[StreamingQuery]:
    """One row per key within a horizon of ``ttl_days``.

    A gate sends rows beyond the horizon to ``late`` beside ``out`` (read it for
    their count).  Behind it keys are remembered for the horizon only: the state
    is bounded by the keys of a few horizons, however many were ever seen.  The
    watermark follows the clock that the gate stamps on each batch, so rows that
    the gate let through are never dropped as late."""
    home = os.path.dirname(out)
    gated = os.path.join(home, "on_time")
    src = _limited(spark.readStream.schema(LOG_SCHEMA), max_files).parquet(log_dir)
    gate = stream_gate(src, gated, os.path.join(home, "late"), os.path.join(ckpt, "gate"), "written_at", f"{ttl_days} DAYS", available_now)
    spark._jvm.org.apache.hadoop.fs.Path(gated).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(gated))
    rows = spark.readStream.schema(f"{LOG_SCHEMA}, newest timestamp_ntz").option("recursiveFileLookup", True).parquet(gated)
    rows = rows.withColumn("clock", F.col("newest").cast("timestamp"))  # event time must be TIMESTAMP
    kept = rows.withWatermark("clock", f"{ttl_days} days").dropDuplicatesWithinWatermark(["record_key"]).drop("newest", "clock")
    q = _writer(kept, os.path.join(ckpt, "dedupe"), available_now).format("parquet").outputMode("append").start(out)
    if available_now:
        _run(q)
    return [gate, q]


def stream_latest(spark: SparkSession, log_dir: str, out: str, ckpt: str, max_files: int | None = None,
                  available_now: bool = True, compact_every: int = 16) -> StreamingQuery:
    """Per micro-batch the last write and the number of writes of every key in
    it, combined map-side, so a hot key crosses the shuffle once per task.  Every
    ``compact_every`` batches they are merged into the keyed base."""
    src = _limited(spark.readStream.schema(LOG_SCHEMA), max_files).parquet(log_dir)
    last = F.struct("written_at", "seq", "payload")

    def sink(batch: DataFrame, batch_id: int) -> None:
        one = batch.groupBy("record_key").agg(F.max(last).alias("last"), F.count(F.lit(1)).alias("n_writes"))
        one.select("record_key", "last.*", "n_writes").write.mode("overwrite").parquet(os.path.join(out, f"_batch={batch_id}"))
        if (batch_id + 1) % compact_every == 0:
            compact_latest(spark, out)

    q = _writer(src, ckpt, available_now).foreachBatch(sink).start()
    if available_now:
        _run(q)
    return q


def _generations(spark: SparkSession, out: str) -> tuple[list[int], list[int]]:
    """Batches that the finished bases go through, and batches after the last of them."""
    bases = _numbered(spark, out, "_base=")
    through = bases[-1] if bases else -1
    return bases, [b for b in _batch_dirs(spark, out) if b > through]


def _combined(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.parquet(*paths).groupBy("record_key").agg(
        F.max(F.struct("written_at", "seq", "payload")).alias("last"), F.sum("n_writes").alias("n_writes")
    ).select("record_key", "last.*", "n_writes")


def _latest_paths(spark: SparkSession, out: str) -> list[str]:
    bases, batches = _generations(spark, out)
    return [os.path.join(out, f"_base={b}") for b in bases[-1:]] + [os.path.join(out, f"_batch={b}") for b in batches]


def compact_latest(spark: SparkSession, out: str, since=None) -> None:
    """Merges the newest base and the batches after it into a new base.

    A base counts from the moment it is finished (its ``_SUCCESS`` file), so a
    reader sees either the old base and its batches or the new base, and a
    compaction that fails leaves nothing behind that is read.  What the base
    before the new one already held is deleted; what the new one took over stays
    until the next compaction, for those who still read it.  With ``since`` keys
    whose last write is older are left out, so the base does not grow with all
    keys ever seen.  A batch replayed after its compaction rewrites a folder that
    no one reads again."""
    bases, batches = _generations(spark, out)
    if not batches:
        return
    merged = _combined(spark, _latest_paths(spark, out))
    if since is not None:
        merged = merged.where(F.col("written_at") >= since)
    merged.write.mode("overwrite").parquet(os.path.join(out, f"_base={batches[-1]}"))
    if bases:
        old = [b for b in _batch_dirs(spark, out) if b <= bases[-1]]
        _drop_dirs(spark, [os.path.join(out, f"_batch={b}") for b in old] + [os.path.join(out, f"_base={b}") for b in bases[:-1]])


def read_latest(spark: SparkSession, out: str, since=None) -> DataFrame:
    """Current value of every key; ``since`` leaves out keys whose last write is
    older (the TTL of a cache)."""
    df = _combined(spark, _latest_paths(spark, out)).select("record_key", "payload", "written_at", "seq", "n_writes")
    return df if since is None else df.where(F.col("written_at") >= since)


# ---------------------------------------------------------------------------
# T4
# ---------------------------------------------------------------------------

def stream_daily_counts(spark: SparkSession, events_path: str, out: str, ckpt: str, schema: str, late_bound: str,
                        max_files: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Rows per day and micro-batch, those within ``late_bound`` of the newest event
    and those beyond it apart.  Counts are combined map-side and added up on
    read; what is kept between batches is the clock, one row."""
    src = _limited(spark.readStream.schema(schema), max_files).parquet(events_path)
    marks = os.path.join(os.path.dirname(out), "_marks")

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = split_late(batch.persist(), batch_id, marks, "ts", late_bound)
        day = F.date_trunc("day", "ts").cast("timestamp_ntz")
        counts = rows.groupBy(day.alias("window_start"), "newest").agg(
            F.count_if(~F.col("late")).alias("record_count"), F.count_if("late").alias("late_count"))
        counts.write.mode("overwrite").parquet(os.path.join(out, f"_batch={batch_id}"))
        batch.unpersist()

    q = _writer(src, ckpt, available_now).foreachBatch(sink).start()
    if available_now:
        _run(q)
    return q


def read_window_counts(spark: SparkSession, out: str, late_bound: str) -> DataFrame:
    """Per window: rows in time, rows beyond the bound, and whether it is closed,
    that is, whether further rows of it would be late."""
    df = spark.read.parquet(out)
    clock = df.agg(F.max("newest").alias("clock"))
    total = df.groupBy("window_start").agg(F.sum("record_count").alias("record_count"), F.sum("late_count").alias("late_count"))
    end = F.col("window_start") + F.expr("INTERVAL 1 DAY")
    return total.join(F.broadcast(clock)).select(
        "window_start", end.alias("window_end"), "record_count", "late_count",
        (end <= F.col("clock") - F.expr(f"INTERVAL {late_bound}")).alias("closed"))
