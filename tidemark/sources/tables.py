"""Parquet tables and JSON reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import duplicate_keys, insert_new, upsert

AB_REPORT = (
    "test_name STRING, model_a STRING, model_b STRING, "
    "model_a_metrics STRUCT<accuracy: DOUBLE, predictions: BIGINT, avg_confidence: DOUBLE, "
    "correct: BIGINT>, "
    "model_b_metrics STRUCT<accuracy: DOUBLE, predictions: BIGINT, avg_confidence: DOUBLE, "
    "correct: BIGINT>, "
    "winner STRING, confidence STRING, evaluation_time TIMESTAMP_NTZ, "
    "per_symbol ARRAY<STRUCT<symbol: STRING, model_version: STRING, predictions: BIGINT, "
    "accuracy: DOUBLE>>"
)


def append(df: DataFrame, path: str, time: str = "timestamp") -> None:
    """Append rows to a table stored by the date of ``time``."""
    _by_date(df.withColumn("date", F.to_date(time))).mode("append").parquet(path)


def _by_date(df: DataFrame) -> DataFrameWriter:
    """Writer into date folders, with files of even size.

    Rebalancing gathers the rows of small dates and splits those of busy ones.
    """
    return df.hint("rebalance", "date").write.partitionBy("date")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None where nothing has been written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _replace_dates(spark: SparkSession, path: str, staging: str) -> None:
    """Put the staged dates in place of the stored ones."""
    staged = _stored(spark, f"{staging}/merged")
    if staged is not None:
        writer = _by_date(staged).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.parquet(path)
    _mark(spark, staging, False)


_STATE = "pending BOOLEAN, applied MAP<STRING, BIGINT>, version INT"


def _state(spark: SparkSession, staging: str) -> dict:
    """The newest state of a staging folder: is a merge pending, which batches are in.

    Each state is a folder of its own, so that a new one either is there as a whole
    or leaves the one before it.
    """
    try:
        states = spark.read.schema(_STATE).parquet(f"{staging}/state")
        row = states.orderBy(F.desc("version")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    return row.asDict() if row else {"pending": False, "applied": {}, "version": 0}


def _mark(
    spark: SparkSession, staging: str, pending: bool, stream: str | None = None, batch: int | None = None
) -> None:
    """Write the next state; ``batch`` becomes the last one applied from ``stream``."""
    old = _state(spark, staging)
    applied = dict(old["applied"] or {})
    if stream is not None:
        applied[stream] = batch
    row = spark.createDataFrame([(pending, applied)], "pending BOOLEAN, applied MAP<STRING, BIGINT>")
    version = old["version"] + 1
    row.coalesce(1).write.mode("overwrite").parquet(f"{staging}/state/version={version}")
    # only the two newest are ever read
    old_path = spark._jvm.org.apache.hadoop.fs.Path(f"{staging}/state/version={version - 2}")
    old_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old_path, True)


def _pending(spark: SparkSession, staging: str) -> bool:
    return _state(spark, staging)["pending"]


def is_applied(spark: SparkSession, staging: str, stream: str, batch: int) -> bool:
    """Whether this batch of a stream, or a later one, has been recorded."""
    return (_state(spark, staging)["applied"] or {}).get(stream, -1) >= batch


def land_new(
    new: DataFrame,
    path: str,
    staging: str,
    keys: Sequence[str],
    time: str = "timestamp",
    batch: tuple[str, int] | None = None,
) -> None:
    """Append the rows whose key is not stored yet, whenever it was stored.

    ``new`` is unique by ``keys``, which contain ``time``. Only the keys of the
    dates in ``new`` are read. ``batch`` (stream, number) is recorded afterwards and
    skipped when it comes again; a call that failed half way may be repeated, as
    the rows that made it are found. A key with a null equals no other.
    """
    if time not in keys:
        raise ValueError("the time column is part of the key")
    spark = new.sparkSession
    if batch and is_applied(spark, staging, *batch):
        return
    dated = new.withColumn("date", F.to_date(time))
    dated.write.mode("overwrite").parquet(f"{staging}/batch")
    new = spark.read.schema(dated.schema).parquet(f"{staging}/batch")
    table = _stored(spark, path)
    if table is not None:
        dates = [row["date"] for row in new.select("date").distinct().collect()]
        touched = table.where(F.col("date").isin(dates)).select(*keys)
        new = new.join(touched, list(keys), "left_anti").select(*dated.columns)
    _by_date(new).mode("append").parquet(path)
    if batch:
        _mark(spark, staging, _pending(spark, staging), *batch)


def merge_into(
    new: DataFrame,
    path: str,
    staging: str,
    keys: Sequence[str],
    time: str = "timestamp",
    update_cols: Sequence[str] | None = None,
    insert_only: bool = False,
    combine: Callable[[DataFrame], DataFrame] | None = None,
    batch: tuple[str, int] | None = None,
) -> None:
    """Merge rows, unique by ``keys``, into a table stored by date.

    With ``combine`` stored and new rows of a key become one row by it, such as
    sums of partial results; else new rows replace stored ones. ``batch``
    (stream, number) is recorded in the same step that makes the merge certain, and
    skipped when it comes again, so that sums never count a batch twice.

    ``keys`` contains ``time``, so a key never changes date and only the dates
    present in ``new`` are read and rewritten. The merged dates are written to
    ``staging`` first and marked pending while they replace the stored ones. A
    call that finds a pending merge finishes it first, so that the same call can
    be repeated after a failure at any point. ``staging`` belongs to one writer at a
    time; a reader may see some of a merge's dates before the others.
    """
    if time not in keys:
        raise ValueError("the time column is part of the key")
    spark = new.sparkSession
    if _pending(spark, staging):
        _replace_dates(spark, path, staging)
    if batch and is_applied(spark, staging, *batch):
        return
    # written once: a stream's batch would run again for each use
    dated = new.withColumn("date", F.to_date(time))
    dated.write.mode("overwrite").parquet(f"{staging}/batch")
    new = spark.read.schema(dated.schema).parquet(f"{staging}/batch")
    if duplicate_keys(new, keys).take(1):
        raise ValueError("rows of the batch repeat a key; use dedupe_last first")
    table = _stored(spark, path)
    if table is None:
        merged = new
    else:
        # at most as many as the batch has days; as literals they prune the table
        dates = [row["date"] for row in new.select("date").distinct().collect()]
        touched = table.where(F.col("date").isin(dates)).select(*new.columns)
        if combine:
            merged = combine(touched.unionByName(new)).withColumn("date", F.to_date(time))
            merged = merged.select(*new.columns)
        elif insert_only:
            merged = insert_new(touched, new, keys)
        else:
            merged = upsert(touched, new, keys, update_cols)
    _by_date(merged).mode("overwrite").parquet(f"{staging}/merged")
    _mark(spark, staging, True, *(batch or ()))
    _replace_dates(spark, path, staging)


def write_report(report: DataFrame, path: str) -> None:
    """Write a one-row nested report as JSON."""
    report.write.mode("overwrite").json(path)


def read_report(spark: SparkSession, path: str, schema: str = AB_REPORT) -> DataFrame:
    """Read a report; it may be spread over several lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)
