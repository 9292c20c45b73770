"""Provider payloads (nested JSON records) to flat records.

Each function takes a DataFrame with the parsed payload in a struct column, as
``spark.read.schema(..).json(path)`` or ``from_json`` give it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TICKER_PAYLOAD = (
    "quotes STRUCT<USD: STRUCT<price: DOUBLE, market_cap: DOUBLE, volume_24h: DOUBLE, "
    "percent_change_24h: DOUBLE, percent_change_7d: DOUBLE, percent_change_30d: DOUBLE, "
    "ath_price: DOUBLE>>, circulating_supply DOUBLE, total_supply DOUBLE"
)
CANDLE_PAYLOAD = (
    "Response STRING, Message STRING, Data STRUCT<Data: ARRAY<STRUCT<time: BIGINT, "
    "open: STRING, high: STRING, low: STRING, close: STRING, volumeto: STRING>>>"
)
SENTIMENT_PAYLOAD = (
    "data ARRAY<STRUCT<timestamp: STRING, value: STRING, value_classification: STRING>>"
)


def _from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def normalize_tickers(raw: DataFrame, fetched_at: str = "fetched_at") -> DataFrame:
    """One ticker record per payload; optional fields may be missing.

    ``high_24h`` carries the provider's all-time high and ``low_24h`` is never
    given, as in the stored table.
    """
    usd = "payload.quotes.USD"
    return raw.where(F.col(f"{usd}.price").isNotNull()).select(
        "symbol",
        F.col(fetched_at).alias("timestamp"),
        F.col(f"{usd}.price").alias("price_usd"),
        F.col(f"{usd}.market_cap").cast("bigint").alias("market_cap"),
        F.col(f"{usd}.volume_24h").cast("bigint").alias("total_volume"),
        F.col(f"{usd}.percent_change_24h").alias("price_change_24h"),
        F.col(f"{usd}.percent_change_7d").alias("price_change_7d"),
        F.col(f"{usd}.percent_change_30d").alias("price_change_30d"),
        F.col(f"{usd}.ath_price").alias("high_24h"),
        F.lit(None).cast("double").alias("low_24h"),
        F.col("payload.circulating_supply").cast("bigint").alias("circulating_supply"),
        F.col("payload.total_supply").cast("bigint").alias("total_supply"),
    )


def normalize_candles(raw: DataFrame) -> DataFrame:
    """One candle per array entry of every successful payload."""
    entries = raw.where(F.col("payload.Response") == "Success").select(
        "symbol", F.explode("payload.Data.Data").alias("_c")
    )
    price = {n: F.col(f"_c.{n}").cast("double") for n in ("open", "high", "low", "close")}
    return entries.select(
        "symbol",
        _from_epoch(F.col("_c.time")).alias("timestamp"),
        *[c.alias(n) for n, c in price.items()],
        F.col("_c.volumeto").cast("double").alias("volume"),
        F.lit(None).cast("bigint").alias("trades"),
    )


def failed_payloads(raw: DataFrame) -> DataFrame:
    """Payloads the provider marked as failed, with its message."""
    ok = F.coalesce(F.col("payload.Response") == "Success", F.lit(False))
    return raw.where(~ok).select("symbol", F.col("payload.Message").alias("message"))


def normalize_sentiment(raw: DataFrame) -> DataFrame:
    """One reading per array entry; numbers arrive as text."""
    entry = raw.select(F.explode("payload.data").alias("_e"))
    return entry.select(
        _from_epoch(F.col("_e.timestamp").cast("bigint")).alias("timestamp"),
        F.col("_e.value").cast("int").alias("fear_greed_value"),
        F.col("_e.value_classification").alias("fear_greed_classification"),
    )


def attach_symbol(df: DataFrame, directory: DataFrame) -> DataFrame:
    """Add exchange code and provider id; symbols not listed are left out."""
    return df.join(directory, "symbol")


def unknown_symbols(df: DataFrame, directory: DataFrame) -> DataFrame:
    """Symbols that have rows but no directory entry."""
    return df.select("symbol").distinct().join(directory, "symbol", "left_anti")
