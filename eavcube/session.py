"""Session settings the operators are written for."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings; each can also be changed on a session that already runs.
RUNTIME = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Wide pivots (143 variables x 4 windows) exceed the default of 100 fields.
    "spark.sql.codegen.maxFields": "1000",
    # HotSpot interprets methods over 8000 bytes; generate split code for those stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_LOCAL_FOLDERS: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a running session."""
    for name, value in RUNTIME.items():
        spark.conf.set(name, value)
    return spark


def make_session(app: str = "eavcube", master: str | None = None, **extra: str) -> SparkSession:
    """Build a session; `extra` takes settings with dots written as double underscores."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors share, from `spark.checkpoint.dir`; a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="eavcube-")
    return _LOCAL_FOLDERS[context.applicationId]
