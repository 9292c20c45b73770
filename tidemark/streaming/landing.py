"""Incremental landing of records and candles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.merge import dedupe_last
from tidemark.sources.tables import land_new, merge_into
from tidemark.sources.ticks import PART_KEYS, candle_parts, candles_of, combine_parts


def read_files(
    spark: SparkSession, path: str, schema, pattern: str | None = None, per_trigger: int = 1000
) -> DataFrame:
    """A stream of Parquet files as they land in ``path``."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a checkpoint keeps for life; batches are numbered within it."""
    row = spark.read.schema("id STRING").json(f"{checkpoint}/metadata").first()
    return row["id"]


def _each_batch(stream: DataFrame, checkpoint: str, mode: str, apply) -> StreamingQuery:
    """Run ``apply(rows, (stream id, batch number))`` on what has arrived, then stop."""

    def run(rows: DataFrame, number: int) -> None:
        apply(rows, (_stream_id(rows.sparkSession, checkpoint), number))

    return (
        stream.writeStream.outputMode(mode)
        .foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_stream(
    stream: DataFrame,
    path: str,
    staging: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str = "timestamp",
    newest_by: Sequence[str] = (),
) -> StreamingQuery:
    """Append each key once to a table stored by date, however late it repeats.

    Micro-batches meet the stored keys of their dates, so nothing is held in
    state and no lateness bound drops rows. Of a key's rows in one batch
    ``newest_by`` picks the row to keep, else any one stays. A replayed batch is
    skipped.
    """

    def land(rows: DataFrame, batch: tuple[str, int]) -> None:
        once = dedupe_last(rows, keys, newest_by) if newest_by else rows.dropDuplicates(list(keys))
        land_new(once, path, staging, keys, time, batch)

    return _each_batch(stream, checkpoint, "append", land)


def candle_stream(
    ticks: DataFrame, path: str, staging: str, checkpoint: str, width: str = "1 hour", **columns
) -> StreamingQuery:
    """Fold a tick stream into stored candle parts; ``read_candles`` reads them.

    A tick of any age changes its own candle and no other: each micro-batch is
    aggregated by itself and combined with the stored rows of its dates. A
    replayed batch is skipped, so that volumes and counts hold each tick once.
    """

    def fold(rows: DataFrame, batch: tuple[str, int]) -> None:
        parts = candle_parts(rows, width, **columns)
        merge_into(parts, path, staging, PART_KEYS, combine=combine_parts, batch=batch)

    return _each_batch(ticks, checkpoint, "append", fold)


def read_candles(spark: SparkSession, path: str) -> DataFrame:
    """Candles of a table that ``candle_stream`` has written."""
    return candles_of(spark.read.parquet(path))


def upsert_stream(
    stream: DataFrame,
    path: str,
    staging: str,
    checkpoint: str,
    keys: Sequence[str] = ("symbol", "timestamp"),
    time: str = "timestamp",
    newest_by: Sequence[str] = (),
    mode: str = "update",
) -> StreamingQuery:
    """Merge every micro-batch into a stored table and stop at the end of input.

    ``newest_by`` picks the row to keep where one batch holds a key more than
    once. A replayed batch is skipped.
    """

    def merge(rows: DataFrame, batch: tuple[str, int]) -> None:
        rows = dedupe_last(rows, keys, newest_by) if newest_by else rows
        merge_into(rows, path, staging, keys, time, batch=batch)

    return _each_batch(stream, checkpoint, mode, merge)
