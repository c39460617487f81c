"""Session set-up, reliable pinning and scratch paths."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "chartframes", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tested under; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch files, as named by ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder. A cluster without one is an error, as a
    machine-local folder would not outlive the executor that wrote it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        named = tempfile.mkdtemp(prefix="chartframes-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def pin(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the checkpoint folder, so that later branches read the same rows.

    A table that is pinned already stays as it is.
    """
    if getattr(df, "_pinned", False):
        return df
    shared_dir(df.sparkSession)
    pinned = df.checkpoint()
    pinned._pinned = True
    return pinned


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/chartframes-{uuid.uuid4().hex}/{name}"
