"""Chunked series work against one window per key and against pandas."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.ema import ema, macd
from tidemark.operators.series import (
    chunk_series,
    number_rows,
    over_series,
    tail_per_group,
)
from tidemark.plans import features as feats

START = datetime(2024, 1, 1)
NAN = float("nan")


def candles(seed=0, counts=(("hot", 700), ("mid", 90), ("one", 1))):
    """Series with gaps and bursts; the first holds most of all rows."""
    rng = random.Random(seed)
    rows = []
    for symbol, n in counts:
        at, price = START, 100.0
        for _ in range(n):
            at += timedelta(hours=rng.choice([1, 1, 1, 1, 2, 5, 60]))
            price = round(max(1.0, price + rng.uniform(-5, 5)), 2)
            rows.append((symbol, at, price, price + 1, price - 0.5, price, rng.uniform(0, 9), 1))
    return pd.DataFrame(
        rows, columns=["symbol", "timestamp", "open", "high", "low", "close", "volume", "trades"]
    )


@pytest.fixture(scope="module")
def series(spark):
    pdf = candles()
    df = spark.createDataFrame(pdf).withColumn(
        "timestamp", F.col("timestamp").cast("timestamp_ntz")
    )
    return df, pdf


def ordered(df):
    return df.toPandas().sort_values(["symbol", "timestamp"]).reset_index(drop=True)


def same(left, right, tolerance=1e-9):
    pd.testing.assert_frame_equal(left, right, check_dtype=False, rtol=0, atol=tolerance)


@pytest.mark.parametrize("rows,back,ahead", [(5, 29, 7), (64, 29, 7), (1, 3, 2), (10000, 3, 0)])
def test_chunks_hold_exactly_the_rows_they_need(series, rows, back, ahead):
    df, pdf = series
    got = chunk_series(df, back, ahead, rows=rows).toPandas()
    assert (got[got._core].groupby(["symbol", "timestamp"]).size() == 1).all()
    assert got._core.sum() == len(pdf)
    place = pdf.sort_values(["symbol", "timestamp"]).copy()
    place["i"] = place.groupby("symbol").cumcount()
    got = got.merge(place[["symbol", "timestamp", "i"]], on=["symbol", "timestamp"])
    total = pdf.groupby("symbol").size()
    for (symbol, _), part in got.groupby(["symbol", "_chunk"]):
        core = part[part._core].i
        held = set(part.i)
        need = range(max(0, core.min() - back), min(total[symbol], core.max() + 1 + ahead))
        assert set(need) <= held
        assert held == set(range(min(held), max(held) + 1))


@pytest.mark.parametrize("rows", [3, 50, 100000])
def test_features_do_not_depend_on_chunk_size(series, spark, rows):
    df, pdf = series
    readings = spark.createDataFrame(
        [(START + timedelta(days=d), None if d % 4 == 0 else d) for d in range(2, 60, 3)],
        "timestamp timestamp_ntz, fear_greed_value bigint",
    )
    as_of = "2024-02-20"
    small = ordered(feats.engineer_features(df, readings, as_of, days=4000, tail=None, rows=rows))
    assert len(small) == len(pdf)
    for symbol, part in pdf.groupby("symbol"):
        part = part.sort_values("timestamp").reset_index(drop=True)
        mine = small[small.symbol == symbol].reset_index(drop=True)
        close = part.close
        for n in (7, 14, 30):
            roll = close.rolling(n, min_periods=1)
            expected = {
                f"sma_{n}": roll.mean(),
                f"volatility_{n}": roll.std(),
                f"close_max_{n}": roll.max(),
                f"ema_{n}": close.ewm(span=n, adjust=False).mean(),
            }
            for name, values in expected.items():
                pd.testing.assert_series_equal(
                    mine[name], values, check_names=False, rtol=0, atol=1e-8
                )
        line = close.ewm(span=12, adjust=False).mean() - close.ewm(span=26, adjust=False).mean()
        smooth = line.ewm(span=9, adjust=False).mean()
        for name, values in {
            "macd": line,
            "macd_signal": smooth,
            "momentum_3": close.pct_change(3),
            "target_return_7": close.pct_change(7).shift(-7),
            "volume_lag_14": part.volume.shift(14),
        }.items():
            pd.testing.assert_series_equal(
                mine[name], values, check_names=False, check_dtype=False, rtol=0, atol=1e-8
            )


def test_ema_skips_missing_values(series):
    df, pdf = series
    gaps = df.withColumn("close", F.when(F.hour("timestamp") % 3 != 0, F.col("close")))
    for rows in (4, 10000):
        got = ordered(ema(gaps, "close", {"e": 7}, rows=rows))
        for _, part in got.groupby("symbol"):
            want = part.close.astype(float).ewm(span=7, adjust=False, ignore_na=True).mean()
            pd.testing.assert_series_equal(
                part.e.astype(float), want, check_names=False, rtol=0, atol=1e-9
            )


def looped(values, span):
    """Average value by value, seeded with the first."""
    a, out = 2 / (span + 1), []
    for x in values:
        out.append(x if not out else a * x + (1 - a) * out[-1])
    return np.array(out)


@pytest.mark.parametrize(
    ("seconds", "count", "scale"), [(60, 2880, 1.0), (10, 9000, 1.0), (1, 20_000, 1e150), (60, 3000, 1e-150)]
)
def test_averages_of_dense_series(spark, seconds, count, scale):
    """Any number of rows in a day, and very large or small prices, by default arguments."""
    df = spark.range(count).select(
        F.lit("a").alias("symbol"),
        F.timestamp_seconds(F.col("id") * seconds).cast("timestamp_ntz").alias("timestamp"),
        ((100 + F.sin(F.col("id") * 0.7) * 40 + F.col("id") % 13) * scale).alias("close"),
    )
    got = ordered(ema(df, "close", {"e3": 3, "e7": 7, "e30": 30}))
    price = got.close.to_numpy()
    for span in (3, 7, 30):
        np.testing.assert_allclose(got[f"e{span}"], looped(price, span), rtol=1e-9)
    got = ordered(macd(df))
    line = looped(price, 12) - looped(price, 26)
    smooth = looped(line, 9)
    for name, want in (("macd", line), ("macd_signal", smooth), ("macd_histogram", line - smooth)):
        np.testing.assert_allclose(got[name], want, rtol=0, atol=1e-9 * scale)


def test_features_of_minute_candles(spark):
    """Two whole days of minutes beside a thin series."""
    dense = spark.range(2880).select(F.lit("dense").alias("symbol"), (F.col("id") * 60).alias("at"))
    thin = spark.range(50).select(F.lit("thin").alias("symbol"), (F.col("id") * 3600).alias("at"))
    price = 50 + F.sin(F.col("at") / 900) * 7
    df = dense.unionByName(thin).select(
        "symbol",
        F.timestamp_seconds("at").cast("timestamp_ntz").alias("timestamp"),
        *[price.alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1.0).alias("volume"),
        F.lit(1).alias("trades"),
    )
    readings = spark.createDataFrame([], "timestamp timestamp_ntz, fear_greed_value bigint")
    got = ordered(feats.engineer_features(df, readings, "1970-01-05", tail=None))
    assert len(got) == 2930
    for _, part in got.groupby("symbol"):
        for span in (7, 14, 30):
            np.testing.assert_allclose(part[f"ema_{span}"], looped(part.close.to_numpy(), span), rtol=1e-9)
        line = looped(part.close.to_numpy(), 12) - looped(part.close.to_numpy(), 26)
        np.testing.assert_allclose(part.macd_signal, looped(line, 9), atol=1e-9)


def test_macd_of_constant_prices_is_zero(spark):
    rows = [("a", START + timedelta(hours=i), 5.0) for i in range(50)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double")
    got = macd(df, rows=7).agg(F.max(F.abs("macd")), F.max(F.abs("macd_signal"))).first()
    assert got[0] < 1e-12 and got[1] < 1e-12


def test_row_numbers_and_tail(series):
    df, pdf = series
    numbered = ordered(number_rows(df))
    want = pdf.sort_values(["symbol", "timestamp"]).reset_index(drop=True)
    assert (numbered._row == want.groupby("symbol").cumcount() + 1).all()
    assert (numbered._total == want.groupby("symbol").close.transform("size")).all()
    for n in (1, 24, 25, 100, 5000):
        kept = ordered(tail_per_group(df, n))
        assert list(kept.close) == list(want.groupby("symbol").tail(n).close)


def test_no_look_ahead(series):
    df, _ = series
    cut = START + timedelta(days=40)
    early = df.where(F.col("timestamp") < F.lit(str(cut)).cast("timestamp_ntz"))
    for build in (feats.sma, feats.rsi, feats.bollinger, feats.momentum, feats.lags):
        whole = ordered(build(df).where(F.col("timestamp") < F.lit(str(cut)).cast("timestamp_ntz")))
        same(whole, ordered(build(early)))


def one_series(spark, closes):
    rows = [("a", START + timedelta(hours=i), c) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double")


def test_one_row_has_no_deviation(spark):
    row = feats.volatility(one_series(spark, [3.0])).first()
    assert row.volatility_7 is None


def test_rsi_without_falls_is_missing(spark):
    rows = feats.rsi(one_series(spark, [1.0, 2.0, 3.0])).collect()
    assert [r.rsi_14 for r in rows] == [None, None, None]


def test_rsi_of_mixed_moves(spark):
    rows = feats.rsi(one_series(spark, [10.0, 12.0, 11.0])).orderBy("timestamp").collect()
    # mean rise 2/3, mean fall 1/3
    assert rows[2].rsi_14 == pytest.approx(100 - 100 / 3)


def test_category_edges(spark):
    cuts = [(-0.03, "strong_down"), (-0.02, "strong_down"), (-0.005, "down"), (0.0, "neutral"),
            (0.005, "neutral"), (0.0051, "up"), (0.02, "up"), (0.021, "strong_up"), (None, None)]
    df = spark.createDataFrame(cuts, "change double, want string")
    got = df.selectExpr("want", f"{feats.ind.category('change')} AS got").collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_momentum_carries_missing_prices_over_chunks(spark):
    closes = [10.0, None, None, 20.0, None, 30.0]
    pdf = pd.Series(closes, dtype=float)
    want = pdf.ffill() / pdf.ffill().shift(1) - 1
    for rows in (1, 100):
        df = one_series(spark, closes)
        got = over_series(
            df,
            lambda w: {"_filled": feats.ind.carried("close", w, "_carry")},
            lambda w: {"change": feats.ind.change_since("_filled", 1, w)},
            back=2, rows=rows, bucket="1 hour", carry="close",
        )
        got = ordered(got).change.astype(float)
        pd.testing.assert_series_equal(got, want, check_names=False)


def test_direction_of_unknown_return(spark):
    df = one_series(spark, [1.0, 2.0])
    assert [r.target_direction_1 for r in feats.targets(df).orderBy("timestamp").collect()] == [
        1, None,
    ]
    strict = feats.targets(df, strict=True).orderBy("timestamp").collect()
    assert [r.target_direction_1 for r in strict] == [1, 0]


def test_zero_volume_and_low(spark):
    df = spark.createDataFrame(
        [("a", START, 1.0, 0.0, 0.0)],
        "symbol string, timestamp timestamp_ntz, high double, low double, volume double",
    )
    assert feats.price_range(df).first().high_low_ratio is None
    assert feats.volume_ratio(df).first().volume_ratio is None


def test_sentiment_before_first_reading_is_missing(spark):
    df = one_series(spark, [1.0] * 60)
    readings = spark.createDataFrame(
        [(START + timedelta(hours=30), None), (START + timedelta(hours=31), 7),
         (START + timedelta(hours=32), 9)],
        "timestamp timestamp_ntz, fear_greed_value int",
    )
    got = feats.attach_sentiment(df, readings).orderBy("timestamp").collect()
    assert [r.fear_greed_value for r in got] == [None] * 24 + [7] * 36


def test_average_over_mostly_missing_values(spark):
    """Carries reach as far as known values go, however thin they are."""
    n, step = 6000, 500
    values = [float(50 + i % 700) if i % step == 0 else None for i in range(n)]
    rows = [("a", START + timedelta(hours=i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "symbol string, timestamp timestamp_ntz, close double")
    got = ema(df, "close", {"e": 30}, rows=64).orderBy("timestamp").collect()
    want = None
    for row, value in zip(got, values, strict=True):
        if value is not None:
            want = value if want is None else want + 2 / 31 * (value - want)
        assert row["e"] == pytest.approx(want, rel=1e-9)


def test_own_underscored_columns_stay(spark, series):
    df = spark.createDataFrame(
        [("a", START + timedelta(hours=i), float(i), i) for i in range(5)],
        "symbol string, timestamp timestamp_ntz, close double, _note int",
    )
    out = over_series(df, lambda w: {"n": f"count(close) OVER ({w})"}, back=0)
    assert [r["_note"] for r in out.orderBy("timestamp").collect()] == list(range(5))
