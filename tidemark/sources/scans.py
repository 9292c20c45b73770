"""Time-bounded reads. Filters and column lists reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schema import DIRECTION_TARGET, MODEL_INPUTS, RETURN_TARGET
from tidemark.session import before


def since(df: DataFrame, start: Column, strict: bool = False, time: str = "timestamp") -> DataFrame:
    """Rows from ``start`` on; tables stored by date are pruned by it as well."""
    at = F.col(time)
    wanted = at > start if strict else at >= start
    if "date" in df.columns:
        wanted = wanted & (F.col("date") >= F.to_date(start))
    return df.where(wanted)


def scan_candles(candles: DataFrame, as_of, days: int = 90) -> DataFrame:
    """Candles of the trailing ``days``."""
    recent = since(candles, before(as_of, f"{days} days"))
    return recent.select("symbol", "timestamp", "open", "high", "low", "close", "volume")


def scan_sentiment(sentiment: DataFrame, as_of, days: int = 90) -> DataFrame:
    recent = since(sentiment, before(as_of, f"{days} days"))
    return recent.select("timestamp", "fear_greed_value")


def scan_training(features: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Labelled rows of the trailing ``days`` with close, model inputs and targets."""
    recent = since(features, before(as_of, f"{days} days"), strict=True)
    return recent.where(F.col(DIRECTION_TARGET).isNotNull()).select(
        "symbol", "timestamp", "close", *MODEL_INPUTS, RETURN_TARGET, DIRECTION_TARGET
    )
