"""Declared schemas of the persisted tables, and the column lists used by models."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(20, 8)
PERCENT = T.DecimalType(10, 4)
RETURN = T.DecimalType(10, 6)
CHANCE = T.DecimalType(5, 4)
TIME = T.TimestampNTZType()
TEXT, LONG, INT, FLAG = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _table(required: tuple[str, ...], **columns: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField(n, t, n not in required) for n, t in columns.items()]
    )


SERIES_KEY = ("symbol", "timestamp")

OHLCV_DATA = _table(
    SERIES_KEY,
    symbol=TEXT, timestamp=TIME, open=PRICE, high=PRICE, low=PRICE, close=PRICE,
    volume=PRICE, trades=INT,
)
MARKET_DATA = _table(
    SERIES_KEY,
    symbol=TEXT, timestamp=TIME, price_usd=PRICE, market_cap=LONG, total_volume=LONG,
    price_change_24h=PERCENT, price_change_7d=PERCENT, price_change_30d=PERCENT,
    high_24h=PRICE, low_24h=PRICE, circulating_supply=LONG, total_supply=LONG,
)
SENTIMENT_DATA = _table(
    ("timestamp",), timestamp=TIME, fear_greed_value=INT, fear_greed_classification=TEXT
)
PREDICTIONS = _table(
    (),
    symbol=TEXT, prediction_timestamp=TIME, current_price=PRICE, predicted_direction=INT,
    confidence=CHANCE, prob_up=CHANCE, prob_down=CHANCE, predicted_return=RETURN,
    predicted_price=PRICE, signal=TEXT, ensemble_prediction=INT, ensemble_confidence=CHANCE,
)
AB_TEST_CONFIG = _table(
    (),
    test_name=TEXT, model_a_name=TEXT, model_a_path=TEXT, model_b_name=TEXT,
    model_b_path=TEXT, traffic_split=T.DecimalType(3, 2), start_date=TIME, end_date=TIME,
    status=TEXT, created_at=TIME,
)
AB_TEST_RESULTS = _table(
    (),
    test_name=TEXT, symbol=TEXT, model_version=TEXT, prediction_timestamp=TIME,
    predicted_direction=INT, confidence=CHANCE, actual_direction=INT, actual_return=RETURN,
    is_correct=FLAG,
)
MODEL_METRICS = _table(
    (),
    symbol=TEXT, model_name=TEXT, metric_name=TEXT, metric_value=RETURN,
    training_timestamp=TIME,
)
RETRAIN_DECISIONS = _table(
    (), decision_time=TIME, should_retrain=FLAG, reasons=T.ArrayType(TEXT), details=TEXT
)
MONITORING_METRICS = _table(
    ("timestamp",),
    timestamp=TIME, metric_type=TEXT, metric_name=TEXT, metric_value=RETURN, metadata=TEXT,
)

_PRICES = (
    "open high low close volume sma_7 sma_14 sma_30 ema_7 ema_14 ema_30 macd macd_signal "
    "macd_histogram bb_middle bb_upper bb_lower bb_width volatility_7 volatility_14 "
    "volatility_30 volume_sma_7 high_low_range close_lag_1 close_lag_3 close_lag_7 "
    "close_lag_14 close_mean_7 close_std_7 close_max_7 close_min_7"
).split()
_FEATURE_TYPES = {
    **{c: PRICE for c in _PRICES},
    **{c: PERCENT for c in ("rsi_14", "volume_ratio", "high_low_ratio")},
    **{f"momentum_{n}": RETURN for n in (1, 3, 7)},
    **{f"target_return_{n}": RETURN for n in (1, 3, 7)},
    **{f"target_direction_{n}": INT for n in (1, 3, 7)},
    **{c: INT for c in "hour day_of_week day_of_month month quarter fear_greed_value".split()},
}
FEATURES = _table(SERIES_KEY, symbol=TEXT, timestamp=TIME, **_FEATURE_TYPES)
# The columns a repeated feature run replaces in rows that are already stored.
FEATURE_UPDATES = ("close", "rsi_14", "macd", "target_return_1", "target_direction_1")

# Model inputs, in the order of the stored coefficients.
MODEL_INPUTS = (
    "sma_7 sma_14 ema_7 ema_14 rsi_14 macd macd_signal bb_upper bb_lower bb_width "
    "volatility_7 volatility_14 momentum_1 momentum_3 momentum_7 volume_ratio close_lag_1 "
    "close_lag_3 close_lag_7 hour day_of_week fear_greed_value"
).split()
RETURN_TARGET = "target_return_1"
DIRECTION_TARGET = "target_direction_1"
