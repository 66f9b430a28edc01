"""Spark session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock (timestamps are compared with
# DuckDB and with literal window bounds), ANSI semantics (bad casts raise like
# the warehouse does), adaptive execution for runtime coalescing / skew splits.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Constraint inference over the long hash / CASE expressions of this
    # engine costs seconds of optimizer time per query and adds nothing the
    # explicit filters do not already push down.
    "spark.sql.constraintPropagation.enabled": "false",
}


def get_session(
    app: str = "cohortix",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the engine's base settings.

    On a cluster ``master`` stays ``None`` so spark-submit decides; tests pass
    ``local[*]``.  Shuffle partitions default to Spark's own value and AQE
    coalesces them at runtime, so the same code sizes itself from sf0.001 to
    100 TB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a live session
                pass
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    """Apply the engine's runtime SQL settings to a session created elsewhere
    (e.g. by a job driver); static settings are left alone."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            try:
                if spark.conf.get(k, None) != v:
                    spark.conf.set(k, v)
            except Exception:  # pragma: no cover - static conf
                pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    leave it unset (tests): a scratch folder of its own is then registered.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="cohortix-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
