"""Candles from raw ticks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _arrival(df: DataFrame, time: str, tie: str | None) -> Column:
    """A single sortable number for (time, tie).

    A number, unlike a struct, can be updated in place, so that the aggregation
    hashes instead of sorting all ticks.
    """
    if tie is None:
        return F.col(time)
    whole = isinstance(df.schema[tie].dataType, (T.LongType, T.IntegerType, T.ShortType))
    if not whole:
        return F.struct(time, tie)
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("decimal(17,0)")
    room = F.lit("20000000000000000000").cast("decimal(20,0)")
    return (micros * room + F.col(tie).cast("decimal(19,0)")).cast("decimal(38,0)")


PART_KEYS = ("symbol", "timestamp")
CANDLE = ("open", "high", "low", "close", "volume", "trades")


def candle_parts(
    ticks: DataFrame,
    width: str = "1 hour",
    symbol: str = "event_type",
    time: str = "ts",
    price: str = "value",
    tie: str | None = "event_id",
) -> DataFrame:
    """Candles that further ticks can still be combined with.

    Beside the candle a row holds the arrival of its first and last tick
    (``first_key``, ``last_key``), which later parts compare theirs with.
    """
    arrival = _arrival(ticks, time, tie)
    return (
        ticks.groupBy(F.col(symbol).alias("symbol"), F.window(F.col(time), width).alias("_w"))
        .agg(
            F.min(arrival).alias("first_key"),
            F.max(arrival).alias("last_key"),
            F.min_by(price, arrival).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, arrival).alias("close"),
            F.sum(price).alias("volume"),
            F.count(F.lit(1)).alias("trades"),
        )
        .select("symbol", F.col("_w.start").alias("timestamp"), "first_key", "last_key", *CANDLE)
    )


def combine_parts(parts: DataFrame) -> DataFrame:
    """One part for each symbol and time bucket, whatever the order of the parts."""
    return parts.groupBy(*PART_KEYS).agg(
        F.min("first_key").alias("first_key"),
        F.max("last_key").alias("last_key"),
        F.min_by("open", "first_key").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "last_key").alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("trades").alias("trades"),
    )


def candles_of(parts: DataFrame) -> DataFrame:
    """The candles that stored parts stand for."""
    return parts.select(*PART_KEYS, *CANDLE)


def build_candles(
    ticks: DataFrame,
    width: str = "1 hour",
    symbol: str = "event_type",
    time: str = "ts",
    price: str = "value",
    tie: str | None = "event_id",
) -> DataFrame:
    """Open, high, low, close, volume and trade count per symbol and time bucket.

    Ticks are combined before the shuffle, so it moves at most one row per
    symbol, bucket and input task. Works on a stream as well.
    """
    arrival = _arrival(ticks, time, tie)
    return (
        ticks.groupBy(F.col(symbol).alias("symbol"), F.window(F.col(time), width).alias("_w"))
        .agg(
            F.min_by(price, arrival).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, arrival).alias("close"),
            F.sum(price).alias("volume"),
            F.count(F.lit(1)).alias("trades"),
        )
        .select(
            "symbol",
            F.col("_w.start").alias("timestamp"),
            "open", "high", "low", "close", "volume", "trades",
        )
    )
