"""Candles to model features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import indicators as ind
from tidemark.operators.ema import Averages
from tidemark.operators.series import (
    CHUNK_ROWS,
    chunk_series,
    chunk_window,
    over_series,
    place_in_series,
)
from tidemark.session import before
from tidemark.sources.scans import scan_candles, scan_sentiment, since

WINDOWS = (7, 14, 30)
HORIZONS = (1, 3, 7)
LAGS = (1, 3, 7, 14)
LAGGED = ("close", "volume", "high", "low")
TAIL_ROWS = 60 * 24


def _averages(w, col, windows, name):
    return {f"{name}_{n}": ind.rolling_mean(col, n, w) for n in windows}


def _deviations(w, col, windows, name):
    return {f"{name}_{n}": ind.rolling_std(col, n, w) for n in windows}


def _extremes(w, col, windows):
    top = {f"{col}_max_{n}": ind.rolling_max(col, n, w) for n in windows}
    return top | {f"{col}_min_{n}": ind.rolling_min(col, n, w) for n in windows}


def _distances(col, windows):
    far = {f"dist_from_max_{n}": ind.distance_from(col, f"{col}_max_{n}") for n in windows}
    return far | {f"dist_from_min_{n}": ind.distance_from(col, f"{col}_min_{n}") for n in windows}


def _band(w, col, n):
    return {"bb_middle": ind.rolling_mean(col, n, w), "_bb_std": ind.rolling_std(col, n, w)}


def _band_edges(width):
    upper, lower = (f"(bb_middle {sign} _bb_std * {width}D)" for sign in "+-")
    return {"bb_upper": upper, "bb_lower": lower, "bb_width": f"{upper} - {lower}"}


def sma(df: DataFrame, col: str = "close", windows: Sequence[int] = WINDOWS) -> DataFrame:
    return over_series(df, lambda w: _averages(w, col, windows, "sma"), back=max(windows) - 1)


def volatility(df: DataFrame, col: str = "close", windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Rolling sample deviation of the price."""
    return over_series(
        df, lambda w: _deviations(w, col, windows, "volatility"), back=max(windows) - 1
    )


def rsi(df: DataFrame, col: str = "close", n: int = 14) -> DataFrame:
    return over_series(
        df,
        lambda w: {"_delta": ind.step(col, w)},
        lambda w: {
            f"rsi_{n}": ind.rsi(
                ind.rolling_mean(ind.rise("_delta"), n, w),
                ind.rolling_mean(ind.fall("_delta"), n, w),
            )
        },
        back=n,
    )


def bollinger(df: DataFrame, col: str = "close", n: int = 20, width: float = 2.0) -> DataFrame:
    return over_series(
        df, lambda w: _band(w, col, n), lambda w: _band_edges(width), back=n - 1
    )


def momentum(df: DataFrame, col: str = "close", steps: Sequence[int] = HORIZONS) -> DataFrame:
    """Relative change over ``steps`` rows; missing prices are carried forward."""
    return over_series(
        df,
        lambda w: {"_filled": ind.carried(col, w, "_carry")},
        lambda w: {f"momentum_{n}": ind.change_since("_filled", n, w) for n in steps},
        back=max(steps),
        carry=col,
    )


def volume_ratio(df: DataFrame, n: int = 7) -> DataFrame:
    return over_series(
        df,
        lambda w: _averages(w, "volume", (n,), "volume_sma"),
        lambda w: {"volume_ratio": ind.ratio("volume", f"volume_sma_{n}")},
        back=n - 1,
    )


def price_range(df: DataFrame) -> DataFrame:
    return ind.add(
        df, {"high_low_range": "high - low", "high_low_ratio": ind.ratio("high", "low")}
    )


def _lags(w, cols, lags):
    return {f"{c}_lag_{n}": ind.lagged(c, n, w) for n in lags for c in cols}


def lags(df: DataFrame, cols: Sequence[str] = LAGGED, ns: Sequence[int] = LAGS) -> DataFrame:
    return over_series(df, lambda w: _lags(w, cols, ns), back=max(ns))


def rolling_stats(df: DataFrame, col: str = "close", windows: Sequence[int] = WINDOWS) -> DataFrame:
    return over_series(
        df,
        lambda w: _averages(w, col, windows, f"{col}_mean")
        | _deviations(w, col, windows, f"{col}_std")
        | _extremes(w, col, windows),
        back=max(windows) - 1,
    )


def distance_from_extremes(
    df: DataFrame, col: str = "close", windows: Sequence[int] = WINDOWS
) -> DataFrame:
    return over_series(
        df,
        lambda w: _extremes(w, col, windows),
        lambda w: _distances(col, windows),
        back=max(windows) - 1,
    )


def _targets(horizons, strict):
    out = {}
    for h in horizons:
        change = f"target_return_{h}"
        out[f"target_direction_{h}"] = ind.direction(change, strict)
        out[f"target_category_{h}"] = ind.category(change)
    return out


def targets(
    df: DataFrame,
    col: str = "close",
    horizons: Sequence[int] = HORIZONS,
    strict: bool = False,
) -> DataFrame:
    """Later return, direction and category per horizon.

    Rows without a later price have no direction; ``strict`` gives them 0.
    """
    return over_series(
        df,
        lambda w: {"_filled": ind.carried(col, w, "_carry")},
        lambda w: {f"target_return_{h}": ind.change_until("_filled", h, w) for h in horizons},
        lambda w: _targets(horizons, strict),
        back=0,
        ahead=max(horizons),
        carry=col,
    )


def calendar(df: DataFrame, time: str = "timestamp") -> DataFrame:
    return ind.add(df, ind.calendar(time))


def daily_first(
    sentiment: DataFrame, value: str = "fear_greed_value", time: str = "timestamp"
) -> DataFrame:
    """First known reading of every date."""
    return (
        sentiment.where(F.col(value).isNotNull())
        .groupBy(F.to_date(time).alias("date"))
        .agg(F.min_by(value, F.col(time)).alias(value))
    )


def _filled_readings(days: DataFrame, date, readings: DataFrame, value: str) -> DataFrame:
    """Join readings by date to one row per (symbol, day) and carry them on."""
    dated = days.withColumn("date", date).join(
        readings.withColumnRenamed(value, "_reading"), "date", "left"
    )
    filled = ind.carried("_reading", "PARTITION BY symbol ORDER BY _bucket")
    return ind.add(dated, {value: filled}).drop("date", "_reading")


def attach_sentiment(
    candles: DataFrame, sentiment: DataFrame, value: str = "fear_greed_value"
) -> DataFrame:
    """Each row's latest reading among the dates its symbol has rows on.

    The reading is the same for all rows of a symbol and date, so it is carried
    forward on one row per symbol and date.
    """
    days = candles.select("symbol", F.to_date("timestamp").alias("_bucket")).distinct()
    filled = _filled_readings(days, F.col("_bucket"), daily_first(sentiment, value), value)
    return (
        candles.withColumn("_bucket", F.to_date("timestamp"))
        .join(filled, ["symbol", "_bucket"])
        .drop("_bucket")
    )


def trend_view(candles: DataFrame, tail: int, n: int = 7) -> DataFrame:
    """Close, its rolling mean and its one-row change for each symbol's newest rows."""
    out = over_series(
        candles.select("symbol", "timestamp", "close"),
        lambda w: {
            "_row": place_in_series(w),
            **_averages(w, "close", (n,), "sma"),
            "_filled": ind.carried("close", w, "_carry"),
        },
        lambda w: {
            "momentum_1": ind.change_since("_filled", 1, w),
            "rows_left": "_total - _row",
        },
        back=n,
        carry="close",
    )
    return out.where(F.col("rows_left") < tail).drop("rows_left")


def engineer_features(
    candles: DataFrame,
    sentiment: DataFrame,
    as_of,
    days: int = 90,
    tail: int | None = TAIL_ROWS,
    strict: bool = False,
    rows: int = CHUNK_ROWS,
) -> DataFrame:
    """All 73 computed columns for the newest ``tail`` rows of every symbol.

    Rows move to their (symbol, day), to learn their place in the series and the
    day's sentiment, and to their chunk, where windows share one sort, and those
    of the averages one more. The joins by day and with the averages' carries become
    broadcasts where these small tables allow it. Averages are folded in a scan of
    their own that reads the price alone.
    """
    candles = scan_candles(candles, as_of, days)
    readings = daily_first(scan_sentiment(sentiment, as_of, days))
    chunked = chunk_series(
        candles,
        back=max(WINDOWS),
        ahead=max(HORIZONS),
        rows=rows,
        carry="close",
        enrich=lambda days: _filled_readings(
            days, F.to_date("_bucket"), readings, "fear_greed_value"
        ),
    )
    w = chunk_window()
    averages = Averages("close", {f"ema_{n}": n for n in WINDOWS}, (12, 26, 9), rows=rows)
    rise, fall = ind.rise("_delta"), ind.fall("_delta")
    # windows that others build on come first, while rows are still narrow
    first = {
        "_delta": ind.step("close", w),
        "_filled": ind.carried("close", w, "_carry"),
        "_row": place_in_series(w),
        **averages.count,
    }
    rest = {
        **_averages(w, "close", WINDOWS, "sma"),
        **_band(w, "close", 20),
        **_deviations(w, "close", WINDOWS, "volatility"),
        **_averages(w, "volume", (7,), "volume_sma"),
        **_lags(w, LAGGED, LAGS),
        **_extremes(w, "close", WINDOWS),
        "rsi_14": ind.rsi(ind.rolling_mean(rise, 14, w), ind.rolling_mean(fall, 14, w)),
        **{f"momentum_{n}": ind.change_since("_filled", n, w) for n in HORIZONS},
        **{f"target_return_{h}": ind.change_until("_filled", h, w) for h in HORIZONS},
    }
    out = chunked
    # stretches are sorted once more, so their windows follow those of the chunks
    for columns in (first, rest):
        out = ind.add(out, columns)
    out = out.where("_core")
    for columns in averages.passes:
        out = ind.add(out, columns)
    out = averages.finish(out)
    if tail is not None:
        out = out.where(F.col("_total") - F.col("_row") < tail)
    out = ind.add(
        out,
        {
            **_band_edges(2.0),
            "volume_ratio": ind.ratio("volume", "volume_sma_7"),
            **{f"close_mean_{n}": f"sma_{n}" for n in WINDOWS},
            **{f"close_std_{n}": f"volatility_{n}" for n in WINDOWS},
            **_distances("close", WINDOWS),
            **_targets(HORIZONS, strict),
            **ind.calendar("timestamp"),
        },
    )
    out = price_range(out)
    return out.select(*candles.columns, *feature_columns())


def feature_columns() -> list[str]:
    """Names of the computed columns, in stored order."""
    return [
        *[f"sma_{n}" for n in WINDOWS],
        *[f"ema_{n}" for n in WINDOWS],
        "rsi_14", "macd", "macd_signal", "macd_histogram",
        "bb_middle", "bb_upper", "bb_lower", "bb_width",
        *[f"volatility_{n}" for n in WINDOWS],
        *[f"momentum_{n}" for n in HORIZONS],
        "volume_sma_7", "volume_ratio", "high_low_range", "high_low_ratio",
        *[f"{c}_lag_{n}" for n in LAGS for c in LAGGED],
        *[
            f"{stat}_{n}"
            for n in WINDOWS
            for stat in ("close_mean", "close_std", "close_max", "close_min",
                         "dist_from_max", "dist_from_min")
        ],
        *[f"target_{kind}_{h}" for h in HORIZONS for kind in ("return", "direction", "category")],
        "hour", "day_of_week", "day_of_month", "month", "quarter",
        "fear_greed_value",
    ]


def feature_summary(features: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Row count, time span and mean levels per symbol over the trailing days."""
    return (
        since(features, before(as_of, f"{days} days"), strict=True)
        .groupBy("symbol")
        .agg(
            F.count(F.lit(1)).alias("record_count"),
            F.min("timestamp").alias("earliest_data"),
            F.max("timestamp").alias("latest_data"),
            F.avg("rsi_14").alias("avg_rsi"),
            F.avg("volatility_7").alias("avg_volatility"),
            F.avg("fear_greed_value").alias("avg_sentiment"),
        )
    )
