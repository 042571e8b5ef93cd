"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "cohortmart",
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs are written for.

    AQE re-plans joins from runtime sizes (broadcast only when the measured
    side is under its threshold; no broadcast from file-size estimates), splits
    skewed join partitions and coalesces small shuffle partitions.  The UI
    stays off.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Broadcast only what has been measured: the static planner sizes a
        # stored table by its compressed files (parquet can expand 5-10x in
        # memory), so estimate-based broadcasts are off; AQE still broadcasts a
        # side whose shuffle output it measured below 10 MB.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # checkpoint files of DataFrames that went out of scope are removed
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir`` (or set on the context)."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    return d or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; only in local mode is one created when unset.

    On a cluster the folder must be shared storage chosen by the operator, so
    an unset value is an error there rather than a silent local temp folder.
    """
    d = checkpoint_dir(spark)
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    d = tempfile.mkdtemp(prefix="cohortmart-ckpt-")
    atexit.register(shutil.rmtree, d, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/cohortmart-{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for Python-side checks in tests."""
    return path[len("file:"):] if path.startswith("file:") else path


@contextmanager
def held_conf(spark: SparkSession, values: Mapping[str, str]):
    """Session settings of what is planned within."""
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def measured_broadcasts(spark: SparkSession):
    """What is planned and run within broadcasts a side of a join only if it was
    measured to be small, or by a hint.  An estimate from the files of a stored
    table is of their compressed bytes: millions of codes in sorted order, or a
    written copy of some of their columns, pass for a few megabytes and would
    all go through the driver."""
    measured, estimated = "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.autoBroadcastJoinThreshold"
    most = spark.conf.get(measured, None) or spark.conf.get(estimated)
    return held_conf(spark, {estimated: "-1", measured: most})


def is_case_sensitive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


__all__ = ["build_session", "checkpoint_dir", "ensure_checkpoint_dir", "scratch_path",
           "local_path", "is_case_sensitive", "held_conf", "measured_broadcasts"]
