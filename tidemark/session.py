"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
from datetime import datetime

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods above 8000 bytes; wide projections would be
    # interpreted if fused into one. Beyond the limit Spark splits them instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; cluster sizing stays with the caller."""
    for name, value in _SETTINGS.items():
        spark.conf.set(name, value)
    return spark


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_dirs[app]


def allow_checkpoints(spark: SparkSession) -> None:
    """Give checkpoints a folder where the session does not name one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/checkpoints")


def moment(as_of: str | datetime | Column) -> Column:
    """An as-of time as a zone-free timestamp column."""
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def before(as_of: str | datetime | Column, interval: str) -> Column:
    """``as_of`` minus an interval such as ``"30 minutes"``."""
    return moment(as_of) - F.expr(f"INTERVAL {interval}")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds, with fractions, as a double."""
    micros = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return micros / F.lit(1e6)
