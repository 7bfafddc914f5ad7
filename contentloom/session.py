"""Session settings the jobs rely on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def pin_session(spark: SparkSession) -> SparkSession:
    """Dates and time stamps are read and written in UTC; adaptive execution stays on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named by the cluster in ``spark.checkpoint.dir``."""
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
    return folder


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for tables that show a job's result: below the shared one, or, for a session on this
    machine alone that names none, a folder of its own that goes when the process ends."""
    try:
        base = shared_folder(spark)
    except RuntimeError:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise
        base = tempfile.mkdtemp(prefix="contentloom-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}"
