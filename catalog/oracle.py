"""SQL for an independent engine, equivalent to the registered queries."""

from __future__ import annotations

from tidemark.plans.features import feature_columns
from tidemark.schema import MODEL_INPUTS

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
S = "PARTITION BY symbol ORDER BY timestamp"


def r(expr: str) -> str:
    """Rounded as the queries round: half way always up, no negative zero."""
    return f"round(({expr}) + 1e-9, 6) + 0.0"


def rc(*cols: str, table: str = "") -> str:
    """Rounded columns under their own names."""
    prefix = f"{table}." if table else ""
    return ", ".join(f'{r(prefix + quoted(c))} AS {quoted(c)}' for c in cols)


def quoted(c: str) -> str:
    return f'"{c}"'


def h(*parts: str) -> str:
    joined = " || '|' || ".join(f"CAST({p} AS VARCHAR)" for p in parts)
    return f"CAST('0x' || substr(md5({joined}), 1, 8) AS BIGINT)"


def secs(c: str) -> str:
    return f"CAST(epoch({c}) AS BIGINT)"


def trail(fn: str, col: str, n: int) -> str:
    return f"{fn}({col}) OVER ({S} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def change(a: str, b: str) -> str:
    return f"{a} / nullif({b}, 0) - 1"


def category(c: str) -> str:
    return (
        f"CASE WHEN {c} <= -0.02::DOUBLE THEN 'strong_down' WHEN {c} <= -0.005::DOUBLE THEN 'down' "
        f"WHEN {c} <= 0.005::DOUBLE THEN 'neutral' WHEN {c} <= 0.02::DOUBLE THEN 'up' "
        f"WHEN {c} IS NOT NULL THEN 'strong_up' END"
    )


def direction(c: str) -> str:
    return f"CASE WHEN {c} > 0 THEN 1 WHEN {c} IS NOT NULL THEN 0 END"


def _ema_step(span: int, x: str, y: str) -> str:
    a = f"(2.0::DOUBLE / {span + 1})"
    return f"{a} * {x} + (1 - {a}) * {y}"


E12, E26 = _ema_step(12, "n.close", "e.e12"), _ema_step(26, "n.close", "e.e26")

ROLLING = {
    **{f"sma_{n}": trail("avg", "close", n) for n in (7, 14, 30)},
    **{f"volatility_{n}": trail("stddev_samp", "close", n) for n in (7, 14, 30)},
    **{f"close_max_{n}": trail("max", "close", n) for n in (7, 14, 30)},
    **{f"close_min_{n}": trail("min", "close", n) for n in (7, 14, 30)},
    "bb_middle": trail("avg", "close", 20),
    "bb_std": trail("stddev_samp", "close", 20),
    "volume_sma_7": trail("avg", "volume", 7),
    "mean_rise": trail("avg", "rise", 14),
    "mean_fall": trail("avg", "fall", 14),
    **{f"momentum_{n}": change("close", f"lag(close, {n}) OVER ({S})") for n in (1, 3, 7)},
    **{
        f"target_return_{n}": change(f"lead(close, {n}) OVER ({S})", "close") for n in (1, 3, 7)
    },
    **{
        f"{c}_lag_{n}": f"lag({c}, {n}) OVER ({S})"
        for n in (1, 3, 7, 14)
        for c in ("close", "volume", "high", "low")
    },
}
DERIVED = {
    "rsi_14": "100 - 100 / (1 + mean_rise / nullif(mean_fall, 0))",
    "bb_upper": "bb_middle + 2 * bb_std",
    "bb_lower": "bb_middle - 2 * bb_std",
    "bb_width": "(bb_middle + 2 * bb_std) - (bb_middle - 2 * bb_std)",
    "volume_ratio": "volume / nullif(volume_sma_7, 0)",
    "high_low_range": "high - low",
    "high_low_ratio": "high / nullif(low, 0)",
    **{f"close_mean_{n}": f"sma_{n}" for n in (7, 14, 30)},
    **{f"close_std_{n}": f"volatility_{n}" for n in (7, 14, 30)},
    **{
        f"dist_from_{m}_{n}": f"(close - close_{m}_{n}) / nullif(close_{m}_{n}, 0)"
        for n in (7, 14, 30)
        for m in ("max", "min")
    },
    **{f"target_direction_{n}": direction(f"target_return_{n}") for n in (1, 3, 7)},
    **{f"target_category_{n}": category(f"target_return_{n}") for n in (1, 3, 7)},
    "hour": "CAST(hour(timestamp) AS INTEGER)",
    "day_of_week": "CAST(isodow(timestamp) - 1 AS INTEGER)",
    "day_of_month": "CAST(day(timestamp) AS INTEGER)",
    "month": "CAST(month(timestamp) AS INTEGER)",
    "quarter": "CAST(quarter(timestamp) AS INTEGER)",
}


def _candles(bucket: str) -> str:
    return f"""
        SELECT event_type AS symbol, {bucket} AS timestamp,
               arg_min(value, (ts, event_id)) AS "open", max(value) AS high, min(value) AS low,
               arg_max(value, (ts, event_id)) AS "close", sum(value) AS volume,
               count(*) AS trades
        FROM events GROUP BY 1, 2"""


def _nearest(asked: str, prices: str, base: str) -> str:
    """Predictions with their outcome, by correlated nearest-row lookups."""
    based = (
        "p.current_price"
        if base == "recorded"
        else f"(SELECT f.close FROM {prices} f WHERE f.symbol = p.symbol"
        " AND f.timestamp = p.prediction_timestamp)"
    )
    return f"""
        SELECT q.*, CASE WHEN actual_price > base_price THEN 1 ELSE 0 END AS actual_direction,
               (actual_price - base_price) / nullif(base_price, 0) AS actual_return,
               CASE WHEN predicted_direction =
                    CASE WHEN actual_price > base_price THEN 1 ELSE 0 END
                    THEN 1 ELSE 0 END AS correct
        FROM (SELECT p.*, {based} AS base_price,
                (SELECT arg_min(f.close, (abs(epoch(f.timestamp)
                         - epoch(p.prediction_timestamp) - 3600), f.timestamp))
                 FROM {prices} f WHERE f.symbol = p.symbol
                 AND f.timestamp >= p.prediction_timestamp + INTERVAL 50 MINUTE
                 AND f.timestamp <= p.prediction_timestamp + INTERVAL 70 MINUTE) AS actual_price
              FROM {asked} p) q
        WHERE actual_price IS NOT NULL AND base_price IS NOT NULL"""


TABLES = {
    "candles": _candles("date_trunc('hour', ts)"),
    "fine_candles": _candles("time_bucket(INTERVAL 10 MINUTE, ts)"),
    "sentiment_days": """
        SELECT CAST(ts AS DATE) AS d, CAST(count(DISTINCT user_id) % 101 AS BIGINT) AS v
        FROM events GROUP BY 1 HAVING day(CAST(ts AS DATE)) % 7 <> 3""",
    "readings": """
        SELECT d + INTERVAL 6 HOUR AS timestamp,
               CASE WHEN day(d) % 5 <> 0 THEN v END AS fear_greed_value FROM sentiment_days
        UNION ALL
        SELECT d + INTERVAL 18 HOUR, v * 7 % 101 FROM sentiment_days""",
    "sentiment": """
        SELECT *, CASE WHEN fear_greed_value <= 20 THEN 'extreme_fear'
            WHEN fear_greed_value <= 40 THEN 'fear' WHEN fear_greed_value <= 60 THEN 'neutral'
            WHEN fear_greed_value <= 80 THEN 'greed'
            WHEN fear_greed_value IS NOT NULL THEN 'extreme_greed'
            END AS fear_greed_classification FROM readings""",
    "daily": """
        SELECT CAST(timestamp AS DATE) AS date, arg_min(fear_greed_value, timestamp)
               AS fear_greed_value
        FROM readings WHERE fear_greed_value IS NOT NULL GROUP BY 1""",
    "numbered": f"""
        SELECT *, row_number() OVER ({S}) AS rn, count(*) OVER (PARTITION BY symbol) AS n,
               close - lag(close) OVER ({S}) AS delta FROM candles""",
    "stepped": """
        SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0 END AS rise,
               CASE WHEN delta < 0 THEN -delta ELSE 0 END AS fall FROM numbered""",
    "averages": f"""
        SELECT symbol, rn, close AS e7, close AS e14, close AS e30, close AS e12, close AS e26,
               0.0::DOUBLE AS sig FROM numbered WHERE rn = 1
        UNION ALL
        SELECT n.symbol, n.rn, {_ema_step(7, "n.close", "e.e7")},
               {_ema_step(14, "n.close", "e.e14")}, {_ema_step(30, "n.close", "e.e30")},
               {E12}, {E26}, {_ema_step(9, f"(({E12}) - ({E26}))", "e.sig")}
        FROM averages e JOIN numbered n ON n.symbol = e.symbol AND n.rn = e.rn + 1""",
    "rolled": "SELECT *, "
    + ", ".join(f"{e} AS {c}" for c, e in ROLLING.items())
    + " FROM stepped",
    "core": f"""
        SELECT rolled.*, {", ".join(f"{e} AS {c}" for c, e in DERIVED.items())},
               last_value(daily.fear_greed_value IGNORE NULLS) OVER
                   ({S} ROWS UNBOUNDED PRECEDING) AS fear_greed_value
        FROM rolled LEFT JOIN daily ON daily.date = CAST(rolled.timestamp AS DATE)""",
    "features": """
        SELECT core.*, e7 AS ema_7, e14 AS ema_14, e30 AS ema_30, e12 - e26 AS macd,
               sig AS macd_signal, e12 - e26 - sig AS macd_histogram
        FROM core JOIN averages USING (symbol, rn) WHERE n - rn < 1440""",
    "keyed": f"SELECT *, {h('symbol', secs('timestamp'))} AS k FROM candles",
    "drawn": """
        SELECT symbol, timestamp AS prediction_timestamp, close AS current_price,
               CAST(k % 2 AS INTEGER) AS predicted_direction,
               0.5::DOUBLE + ((k // 2) % 500) / 1000.0::DOUBLE AS confidence,
               close * (1 + (k % 100 - 50) / 1000.0::DOUBLE) AS predicted_price, k
        FROM keyed""",
    "predictions": """
        SELECT *, CASE WHEN confidence > 0.6::DOUBLE AND predicted_direction = 1 THEN 'BUY'
                       WHEN confidence > 0.6::DOUBLE THEN 'SELL' ELSE 'HOLD' END AS signal
        FROM drawn""",
    "ab_config": """
        SELECT 'test_' || CAST(d AS VARCHAR) AS test_name, 'random_forest' AS model_a_name,
               'gradient_boosting' AS model_b_name,
               round(0.3::DOUBLE + day(d) / 100.0::DOUBLE, 2) AS traffic_split,
               CASE WHEN day(d) % 3 = 0 THEN 'active' ELSE 'ended' END AS status,
               CAST(d AS TIMESTAMP) AS created_at
        FROM (SELECT DISTINCT CAST(timestamp AS DATE) AS d FROM candles)""",
    "test": """
        SELECT * FROM ab_config WHERE status = 'active' ORDER BY created_at DESC LIMIT 1""",
    "ab_results": f"""
        SELECT p.*, test.test_name,
               CASE WHEN {h('test.test_name', 'symbol', secs('prediction_timestamp'))}
                    / 4294967296.0::DOUBLE < traffic_split THEN 'A' ELSE 'B' END AS model_version
        FROM predictions p, test""",
    "ab_recent": f"""
        SELECT * FROM ab_results WHERE prediction_timestamp >= {AS_OF} - INTERVAL 7 DAY""",
    "ab_outcomes": _nearest("ab_recent", "candles", "feature"),
    "judged": _nearest("predictions", "candles", "feature"),
    "asked": f"""
        SELECT * FROM predictions WHERE prediction_timestamp >= {AS_OF} - INTERVAL 7 DAY""",
    "outcomes": _nearest("asked", "candles", "recorded"),
    "shifted": """
        SELECT * REPLACE (prediction_timestamp + to_minutes(k % 13) AS prediction_timestamp)
        FROM predictions""",
    "among_many": _nearest("shifted", "fine_candles", "recorded"),
    "model_metrics": f"""
        SELECT symbol, model_name, metric_name,
               {h('symbol', 'model_name', 'metric_name', 'd')} % 1000 / 1000.0::DOUBLE
                   AS metric_value,
               d + to_minutes({h('symbol')} % 60) AS training_timestamp
        FROM (SELECT DISTINCT symbol, CAST(timestamp AS DATE) AS d FROM candles
              WHERE day(CAST(timestamp AS DATE)) % 9 = 1) runs,
             (SELECT unnest(['gradient_boosting', 'logistic_regression', 'random_forest'])
                  AS model_name) models,
             (SELECT unnest(['accuracy', 'f1', 'precision', 'r2', 'recall'])
                  AS metric_name) metrics""",
    "market_data": """
        SELECT symbol, timestamp,
               CASE WHEN (CAST(epoch(timestamp) AS BIGINT) // 3600) % 97 = 0 THEN NULL
                    WHEN (CAST(epoch(timestamp) AS BIGINT) // 3600) % 89 = 0 THEN close * 3
                    ELSE close END AS price_usd, volume AS total_volume
        FROM candles""",
    "directory": """
        SELECT * FROM (VALUES ('click', 'CLK', 'clk-click'), ('purchase', 'PUR', 'pur-purchase'),
            ('view', 'VEW', 'vew-view'), ('signup', 'SGN', 'sgn-signup'))
            AS v(symbol, code, provider_id)""",
    "stored": "SELECT * FROM candles WHERE timestamp < TIMESTAMP '2024-01-25'",
    "arriving": """
        SELECT * REPLACE (close * 2.0 AS "close", volume + 1.0 AS volume)
        FROM candles WHERE hour(timestamp) % 5 = 0""",
    "training": f"""
        SELECT symbol, timestamp, close, {", ".join(MODEL_INPUTS)}, target_return_1,
               target_direction_1
        FROM features WHERE timestamp > {AS_OF} - INTERVAL 30 DAY
        AND target_direction_1 IS NOT NULL""",
    "medians": f"""
        SELECT symbol, {", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in MODEL_INPUTS)}
        FROM training GROUP BY 1""",
    "parts": f"""
        SELECT *, CASE WHEN rn <= floor(n * 0.70::DOUBLE) THEN 'train'
                       WHEN rn <= floor(n * 0.85::DOUBLE) THEN 'validation' ELSE 'test' END
               AS split
        FROM (SELECT *, row_number() OVER ({S}) AS rn, count(*) OVER (PARTITION BY symbol) AS n
              FROM training)""",
    "whole": f"""
        SELECT p.* REPLACE (
            {", ".join(f"coalesce(CAST(p.{c} AS DOUBLE), m.{c}) AS {c}" for c in MODEL_INPUTS)})
        FROM parts p JOIN medians m USING (symbol) WHERE p.n >= 100""",
    "scaler": "SELECT symbol, "
    + ", ".join(
        f"avg({c}) AS {c}__mean, "
        f"CASE WHEN stddev_samp({c}) = 0 THEN 1 ELSE stddev_samp({c}) END AS {c}__std"
        for c in MODEL_INPUTS
    )
    + " FROM whole WHERE split = 'train' GROUP BY 1",
    "scaled": f"""
        SELECT w.* REPLACE (
            {", ".join(f"(w.{c} - s.{c}__mean) / s.{c}__std AS {c}" for c in MODEL_INPUTS)})
        FROM whole w JOIN scaler s USING (symbol)""",
    "ridge": """
        SELECT symbol, my - wx * mx - wz * mz AS intercept, wx, wz FROM (
            SELECT *, (sxy * (szz + 1) - szy * sxz) / ((sxx + 1) * (szz + 1) - sxz * sxz) AS wx,
                      (szy * (sxx + 1) - sxy * sxz) / ((sxx + 1) * (szz + 1) - sxz * sxz) AS wz
            FROM (SELECT symbol, avg(rsi_14) AS mx, avg(momentum_1) AS mz,
                         avg(target_return_1) AS my, var_pop(rsi_14) * count(*) AS sxx,
                         var_pop(momentum_1) * count(*) AS szz,
                         covar_pop(rsi_14, momentum_1) * count(*) AS sxz,
                         covar_pop(rsi_14, target_return_1) * count(*) AS sxy,
                         covar_pop(momentum_1, target_return_1) * count(*) AS szy
                  FROM scaled WHERE split = 'train' GROUP BY 1))""",
    "confusion": """
        SELECT symbol, count(*) AS n,
               count(*) FILTER (WHERE predicted_direction = actual_direction) AS hit,
               count(*) FILTER (WHERE predicted_direction = 1 AND actual_direction = 1) AS tp,
               count(*) FILTER (WHERE predicted_direction = 1) AS said,
               count(*) FILTER (WHERE actual_direction = 1) AS yes
        FROM judged GROUP BY 1""",
    "clf": """
        SELECT symbol, hit / n AS accuracy, coalesce(tp / nullif(said, 0), 0) AS precision,
               coalesce(tp / nullif(yes, 0), 0) AS recall,
               coalesce(2.0 * tp / nullif(said + yes, 0), 0) AS f1
        FROM confusion""",
    "newest": """
        SELECT m.* FROM model_metrics m JOIN (SELECT symbol, max(training_timestamp) AS t
            FROM model_metrics GROUP BY 1) x
        ON m.symbol = x.symbol AND m.training_timestamp = x.t""",
    "latest": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC)
            AS back, count(*) OVER (PARTITION BY symbol) AS rows_held FROM features)
        WHERE back = 1 AND rows_held >= 10""",
    "accuracy": f"""
        SELECT * FROM (
            SELECT symbol,
                count(*) FILTER (WHERE prediction_timestamp >= {AS_OF} - INTERVAL 3 DAY)
                    AS total_predictions,
                avg(correct) FILTER (WHERE prediction_timestamp >= {AS_OF} - INTERVAL 3 DAY)
                    AS accuracy,
                avg(correct) FILTER (WHERE prediction_timestamp < {AS_OF} - INTERVAL 3 DAY)
                    AS baseline_accuracy
            FROM judged WHERE prediction_timestamp >= {AS_OF} - INTERVAL 10 DAY GROUP BY 1)
        WHERE total_predictions > 0""",
    "accuracy_fired": """
        SELECT symbol, CASE WHEN accuracy < 0.5::DOUBLE THEN 'low_accuracy'
                            ELSE 'accuracy_degradation' END AS reason,
               accuracy AS current_accuracy, baseline_accuracy,
               baseline_accuracy - accuracy AS degradation
        FROM accuracy WHERE total_predictions >= 50 AND (accuracy < 0.5::DOUBLE
             OR (baseline_accuracy <> 0 AND baseline_accuracy - accuracy > 0.01::DOUBLE))""",
    "drift": "SELECT a.symbol, "
    + ", ".join(
        f"abs(a.{c} - b.{c}) / nullif(b.{c}_spread, 0) AS {out}"
        for out, c in (
            ("rsi_drift", "rsi_14"),
            ("volatility_drift", "volatility_7"),
            ("volume_drift", "volume_ratio"),
        )
    )
    + f""" FROM (SELECT symbol, avg(rsi_14) AS rsi_14, avg(volatility_7) AS volatility_7,
                     avg(volume_ratio) AS volume_ratio
              FROM core WHERE timestamp >= {AS_OF} - INTERVAL 3 DAY GROUP BY 1) a
        JOIN (SELECT symbol, avg(rsi_14) AS rsi_14, avg(volatility_7) AS volatility_7,
                     avg(volume_ratio) AS volume_ratio, stddev_samp(rsi_14) AS rsi_14_spread,
                     stddev_samp(volatility_7) AS volatility_7_spread,
                     stddev_samp(volume_ratio) AS volume_ratio_spread
              FROM core WHERE timestamp >= {AS_OF} - INTERVAL 30 DAY
              AND timestamp < {AS_OF} - INTERVAL 3 DAY GROUP BY 1) b USING (symbol)""",
    "drift_fired": """
        SELECT symbol, 'data_drift' AS reason,
               greatest(rsi_drift, volatility_drift, volume_drift) AS max_drift,
               rsi_drift, volatility_drift, volume_drift
        FROM drift WHERE greatest(rsi_drift, volatility_drift, volume_drift) > 0.05::DOUBLE""",
    "age": f"""
        SELECT max(training_timestamp) AS last_training,
               (epoch({AS_OF}) - epoch(max(training_timestamp))) / 86400.0::DOUBLE
                   AS days_since_training
        FROM model_metrics""",
    "stamped": f"""
        SELECT 'ohlcv_data' AS table_name, max(timestamp) AS last_update,
               (epoch({AS_OF}) - epoch(max(timestamp))) / 60.0::DOUBLE AS minutes_old
        FROM candles
        UNION ALL
        SELECT 'features', max(timestamp), (epoch({AS_OF}) - epoch(max(timestamp))) / 60.0::DOUBLE
        FROM core""",
    "rolled_up": """
        SELECT 'overall' AS level, 'all' AS name, avg(correct) AS accuracy,
               count(*) AS predictions FROM outcomes
        UNION ALL
        SELECT 'symbol', symbol, avg(correct), count(*) FROM outcomes GROUP BY symbol
        UNION ALL
        SELECT 'signal', signal, avg(correct), count(*) FROM outcomes GROUP BY signal""",
    "late": f"""
        SELECT symbol, arg_max(close, timestamp) AS price FROM candles
        WHERE timestamp >= {AS_OF} - INTERVAL 2 HOUR GROUP BY 1""",
    "met": f"""
        SELECT p.symbol, p.signal, CASE WHEN predicted_direction =
               CASE WHEN price > current_price THEN 1 ELSE 0 END THEN 1 ELSE 0 END AS correct
        FROM predictions p JOIN late USING (symbol)
        WHERE prediction_timestamp BETWEEN {AS_OF} - INTERVAL 20 HOUR
              AND {AS_OF} - INTERVAL 2 HOUR""",
    "wild": """
        SELECT d, string_agg(symbol, ', ' ORDER BY symbol) FILTER (WHERE top > 20.0 * bottom)
               AS names
        FROM (SELECT CAST(timestamp AS DATE) AS d, symbol, max(high) AS top, min(low) AS bottom
              FROM candles GROUP BY 1, 2) GROUP BY 1""",
}


def sql(body: str) -> str:
    """Prefix a query with the tables it uses, in order of need."""
    import re

    needed: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name in TABLES:
            if name != own and name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                visit(TABLES[name], name)
                needed.append(name)

    visit(body)
    listed = ",\n".join(f"{n} AS ({TABLES[n]})" for n in needed)
    return f"WITH RECURSIVE {listed}\n{body}" if needed else body


PRICES = ("open", "high", "low", "close", "volume")
TEXT_COLUMNS = {f"target_category_{n}" for n in (1, 3, 7)}
WHOLE_COLUMNS = {f"target_direction_{n}" for n in (1, 3, 7)} | {
    "hour", "day_of_week", "day_of_month", "month", "quarter", "fear_greed_value",
}


def listed(cols, alias: str = "") -> str:
    """Select list: doubles rounded, other columns as they are."""
    out = []
    for c in cols:
        plain = c in TEXT_COLUMNS or c in WHOLE_COLUMNS
        out.append(quoted(c) if plain else rc(c))
    return ", ".join(out)


def from_core(*cols: str) -> str:
    return sql(f"SELECT symbol, timestamp, {listed(cols)} FROM core")


CANDLE_LIST = f"symbol, timestamp, {rc(*PRICES)}, trades"

_BANDS = (
    "CASE WHEN accuracy > 0.55::DOUBLE THEN 'success' WHEN accuracy > 0.50::DOUBLE "
    "THEN 'warning' ELSE 'danger' END"
)

SQL: dict[str, str] = {
    "candles_hourly": sql(f"SELECT {CANDLE_LIST} FROM candles"),
    "ticker_records": sql(f"""
        SELECT symbol, timestamp, {r('close')} AS price_usd, trades * 1000 AS market_cap,
               CASE WHEN hour(timestamp) % 2 = 0 THEN trades END AS total_volume,
               {r('close - open')} AS price_change_24h,
               CAST(NULL AS DOUBLE) AS price_change_7d, CAST(NULL AS DOUBLE) AS price_change_30d,
               {r('high')} AS high_24h, CAST(NULL AS DOUBLE) AS low_24h,
               trades AS circulating_supply, CAST(NULL AS BIGINT) AS total_supply
        FROM candles"""),
    "candle_records": sql(f"""
        SELECT symbol, timestamp, {rc(*PRICES)}, CAST(NULL AS BIGINT) AS trades
        FROM candles WHERE day(timestamp) % 10 <> 0"""),
    "candle_failures": sql("""
        SELECT symbol, 'rate limit' AS message, count(DISTINCT CAST(timestamp AS DATE)) AS payloads
        FROM candles WHERE day(timestamp) % 10 = 0 GROUP BY 1"""),
    "sentiment_records": sql("""
        SELECT timestamp, CAST(fear_greed_value AS INTEGER) AS fear_greed_value,
               fear_greed_classification FROM sentiment"""),
    "symbol_lookup": sql(f"""
        SELECT symbol, timestamp, {rc('close')}, code, provider_id
        FROM candles JOIN directory USING (symbol)"""),
    "unlisted_symbols": sql("""
        SELECT DISTINCT c.symbol FROM candles c
        WHERE NOT EXISTS (SELECT 1 FROM directory d WHERE d.symbol = c.symbol)"""),
    "candle_scan": sql(f"""
        SELECT symbol, timestamp, {rc(*PRICES)} FROM candles
        WHERE timestamp >= TIMESTAMP '2024-01-30' - INTERVAL 20 DAY"""),
    "sentiment_scan": sql("""
        SELECT timestamp, fear_greed_value FROM sentiment
        WHERE timestamp >= TIMESTAMP '2024-01-30' - INTERVAL 20 DAY"""),
    "training_scan": sql(f"""
        SELECT symbol, timestamp, {listed(['close', *MODEL_INPUTS, 'target_return_1',
        'target_direction_1'])} FROM training"""),
    "upsert_full": sql(f"""
        SELECT {CANDLE_LIST} FROM (
            SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM arriving a
                WHERE a.symbol = s.symbol AND a.timestamp = s.timestamp)
            UNION ALL SELECT * FROM arriving)"""),
    "upsert_partial": sql(f"""
        SELECT {CANDLE_LIST} FROM (
            SELECT s.* REPLACE (coalesce(a.close, s.close) AS "close")
            FROM stored s LEFT JOIN arriving a
            ON a.symbol = s.symbol AND a.timestamp = s.timestamp
            UNION ALL
            SELECT * FROM arriving a WHERE NOT EXISTS (SELECT 1 FROM stored s
                WHERE a.symbol = s.symbol AND a.timestamp = s.timestamp))"""),
    "insert_absent": sql(f"""
        SELECT {CANDLE_LIST} FROM (
            SELECT * FROM stored UNION ALL
            SELECT * FROM arriving a WHERE NOT EXISTS (SELECT 1 FROM stored s
                WHERE a.symbol = s.symbol AND a.timestamp = s.timestamp))"""),
    "appended_table": sql(f"""
        SELECT CAST(prediction_timestamp AS DATE) AS date, signal, count(*) AS predictions,
               {r('sum(confidence)')} AS confidence_sum FROM predictions GROUP BY 1, 2"""),
    "dedupe_backfill": sql(f"""
        SELECT user_id, date, ts, event_id, {rc('value')} FROM (
            SELECT *, CAST(ts AS DATE) AS date, row_number() OVER (
                PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS back
            FROM events) WHERE back = 1"""),
    "accepted_rows": sql(f"""
        SELECT symbol, prediction_timestamp, {rc('current_price')}, predicted_direction,
               {r('round(confidence, 4)')} AS confidence, signal
        FROM predictions WHERE k % 11 <> 0 AND k % 7 <> 0"""),
    "rejected_rows": sql("""
        SELECT symbol, prediction_timestamp,
               CASE WHEN k % 77 = 0 THEN 'current_price,confidence'
                    WHEN k % 11 = 0 THEN 'current_price' ELSE 'confidence' END AS rejected_columns
        FROM predictions WHERE k % 11 = 0 OR k % 7 = 0"""),
    "conformed_rows": sql(f"""
        SELECT symbol, count(*) AS total_rows, count(*) FILTER (WHERE k % 11 <> 0) AS prices,
               count(*) FILTER (WHERE k % 7 <> 0) AS confidences,
               {r('avg(round(confidence, 4)) FILTER (WHERE k % 7 <> 0)')} AS avg_confidence
        FROM predictions GROUP BY 1"""),
    "constraint_violations": sql("""
        SELECT rule, count(*) AS broken_by FROM (
          SELECT unnest(CASE WHEN len(rules) = 0 THEN ['none'] ELSE rules END) AS rule FROM (
            SELECT list_filter([
                CASE WHEN k % 13 = 0 THEN 'required(symbol)' END,
                CASE WHEN k % 11 = 0 THEN 'type(current_price)' END,
                CASE WHEN k % 7 = 0 THEN 'type(confidence)' END,
                CASE WHEN k % 13 <> 0 AND row_number() OVER (
                    PARTITION BY CASE WHEN k % 13 <> 0 THEN symbol END, prediction_timestamp ORDER BY seq, k) > 1
                  THEN 'unique(symbol,prediction_timestamp)' END], lambda x: x IS NOT NULL) AS rules
            FROM (SELECT *, unnest(CASE WHEN k % 5 = 0 THEN [1, 2] ELSE [1] END) AS seq FROM predictions)))
        GROUP BY rule"""),
    "repeated_keys": """
        SELECT event_type AS symbol, date_trunc('hour', ts) AS timestamp, count(*) AS copies
        FROM events GROUP BY 1, 2 HAVING count(*) > 1""",
    "sma": from_core("sma_7", "sma_14", "sma_30"),
    "ema": sql(f"""
        SELECT symbol, timestamp, {r('e7')} AS ema_7, {r('e14')} AS ema_14, {r('e30')} AS ema_30
        FROM numbered JOIN averages USING (symbol, rn)"""),
    "rsi": from_core("rsi_14"),
    "macd": sql(f"""
        SELECT symbol, timestamp, {r('e12 - e26')} AS macd, {r('sig')} AS macd_signal,
               {r('e12 - e26 - sig')} AS macd_histogram
        FROM numbered JOIN averages USING (symbol, rn)"""),
    "bollinger": from_core("bb_middle", "bb_upper", "bb_lower", "bb_width"),
    "volatility": from_core("volatility_7", "volatility_14", "volatility_30"),
    "momentum": from_core("momentum_1", "momentum_3", "momentum_7"),
    "momentum_filled": sql(
        "SELECT symbol, timestamp, "
        + ", ".join(
            f"{r(change('filled', f'lag(filled, {n}) OVER ({S})'))} AS momentum_{n}"
            for n in (1, 3, 7)
        )
        + f""" FROM (SELECT symbol, timestamp, last_value(price_usd IGNORE NULLS) OVER
            ({S} ROWS UNBOUNDED PRECEDING) AS filled FROM market_data)"""
    ),
    "volume_ratio": from_core("volume_sma_7", "volume_ratio"),
    "price_range": from_core("high_low_range", "high_low_ratio"),
    "lags": from_core(
        *[f"{c}_lag_{n}" for n in (1, 3, 7, 14) for c in ("close", "volume", "high", "low")]
    ),
    "rolling_stats": from_core(
        *[f"close_{s}_{n}" for n in (7, 14, 30) for s in ("mean", "std", "max", "min")]
    ),
    "distance_from_extremes": from_core(
        *[f"dist_from_{m}_{n}" for n in (7, 14, 30) for m in ("max", "min")]
    ),
    "targets": from_core(
        *[f"target_{x}_{n}" for n in (1, 3, 7) for x in ("return", "direction", "category")]
    ),
    "targets_strict": sql(
        "SELECT symbol, timestamp, "
        + ", ".join(
            f"coalesce(target_direction_{n}, 0) AS target_direction_{n}" for n in (1, 3, 7)
        )
        + " FROM core"
    ),
    "calendar_parts": from_core("hour", "day_of_week", "day_of_month", "month", "quarter"),
    "daily_first": sql("SELECT date, fear_greed_value FROM daily"),
    "sentiment_attached": from_core("fear_greed_value"),
    "series_tail": sql(f"""
        SELECT symbol, timestamp, {rc('close')} FROM numbered WHERE n - rn < 60"""),
    "feature_table": sql(f"""
        SELECT symbol, timestamp, {listed([*PRICES, *feature_columns()])} FROM features"""),
    "features_from_ticks": sql(f"""
        SELECT symbol, timestamp, {rc('close', 'sma_7', 'momentum_1')} FROM core
        WHERE n - rn < 500"""),
    "feature_summary": sql(f"""
        SELECT symbol, count(*) AS record_count, min(timestamp) AS earliest_data,
               max(timestamp) AS latest_data, {r('avg(rsi_14)')} AS avg_rsi,
               {r('avg(volatility_7)')} AS avg_volatility,
               {r('avg(fear_greed_value)')} AS avg_sentiment
        FROM core WHERE timestamp > {AS_OF} - INTERVAL 7 DAY GROUP BY 1"""),
    "stale_series": """
        SELECT event_type, max(ts) AS last_update FROM events GROUP BY 1
        HAVING max(ts) < TIMESTAMP '2024-01-31 00:10:00' - INTERVAL 30 MINUTE""",
    "missing_prices": sql(f"""
        SELECT count(*) FILTER (WHERE price_usd IS NULL) AS null_count FROM market_data
        WHERE timestamp > {AS_OF} - INTERVAL 10 DAY"""),
    "price_jumps": sql(f"""
        SELECT symbol, timestamp, {rc('price_usd', 'prev_price_usd', 'pct_change')} FROM (
            SELECT *, abs((price_usd - prev_price_usd) / nullif(prev_price_usd, 0)) AS pct_change
            FROM (SELECT symbol, timestamp, price_usd,
                         lag(price_usd) OVER ({S}) AS prev_price_usd
                  FROM market_data WHERE timestamp > {AS_OF} - INTERVAL 2 DAY))
        WHERE pct_change > 0.5"""),
    "jump_counts": sql(f"""
        SELECT symbol, count(*) AS outlier_count FROM (
            SELECT symbol, close, lag(close) OVER ({S}) AS prev FROM candles
            WHERE timestamp >= {AS_OF} - INTERVAL 7 DAY)
        WHERE abs((close - prev) / nullif(prev, 0)) > 0.10::DOUBLE GROUP BY 1"""),
    "validation_row": sql(f"""
        SELECT (SELECT count(*) FROM (SELECT symbol FROM market_data GROUP BY 1
                    HAVING max(timestamp) < TIMESTAMP '2024-01-30 23:40:00'
                        - INTERVAL 30 MINUTE)) AS stale_data_count,
               (SELECT count(*) FROM market_data WHERE price_usd IS NULL AND timestamp >
                    TIMESTAMP '2024-01-30 23:40:00' - INTERVAL 10 DAY) AS null_price_count,
               (SELECT count(*) FROM (SELECT price_usd, lag(price_usd) OVER ({S}) AS prev
                    FROM market_data WHERE timestamp >
                        TIMESTAMP '2024-01-30 23:40:00' - INTERVAL 2 DAY)
                WHERE abs((price_usd - prev) / nullif(prev, 0)) > 0.5) AS outlier_count,
               TIMESTAMP '2024-01-30 23:40:00' AS validation_timestamp"""),
    "table_freshness": sql(f"""
        SELECT table_name, last_update, {rc('minutes_old')} FROM stamped"""),
    "feature_completeness": sql(f"""
        SELECT symbol, total_records, null_rsi, null_macd, null_sentiment,
               {rc('completeness_pct')},
               CASE WHEN completeness_pct > 95 THEN 'success' WHEN completeness_pct > 90
                    THEN 'warning' ELSE 'danger' END AS status
        FROM (SELECT *, (1 - (null_rsi + null_macd + null_sentiment) / (total_records * 3.0::DOUBLE))
                     * 100 AS completeness_pct
              FROM (SELECT symbol, count(*) AS total_records,
                        count(*) FILTER (WHERE rsi_14 IS NULL) AS null_rsi,
                        count(*) FILTER (WHERE macd IS NULL) AS null_macd,
                        count(*) FILTER (WHERE fear_greed_value IS NULL) AS null_sentiment
                    FROM features WHERE timestamp >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1))"""),
    "record_counts": sql(f"""
        SELECT (SELECT count(*) FROM candles WHERE timestamp >= {AS_OF} - INTERVAL 7 DAY)
                   AS ohlcv_count,
               (SELECT count(*) FROM core WHERE timestamp >= {AS_OF} - INTERVAL 7 DAY)
                   AS features_count,
               (SELECT count(*) FROM predictions
                WHERE prediction_timestamp >= {AS_OF} - INTERVAL 7 DAY) AS predictions_count"""),
    "candle_coverage": sql(f"""
        SELECT symbol, count(*) AS total_records, min(timestamp) AS earliest,
               max(timestamp) AS latest,
               {r('(epoch(max(timestamp)) - epoch(min(timestamp))) / 86400.0::DOUBLE')}
                   AS days_span
        FROM candles GROUP BY 1"""),
    "volume_gate": sql("""
        SELECT symbol, count(*) AS row_count, count(*) >= 660 AS enough
        FROM training GROUP BY 1"""),
    "medians": sql(f"SELECT symbol, {rc(*MODEL_INPUTS)} FROM medians"),
    "imputed": sql(f"""
        SELECT g.symbol, g.timestamp, {r('coalesce(g.rsi_14, m.a)')} AS rsi_14,
               {r('coalesce(g.volatility_7, m.b)')} AS volatility_7,
               {r('coalesce(g.momentum_7, m.c)')} AS momentum_7
        FROM (SELECT *  REPLACE (CASE WHEN hour(timestamp) % 6 <> 0 THEN rsi_14 END AS rsi_14)
              FROM training) g
        JOIN (SELECT symbol, median(CASE WHEN hour(timestamp) % 6 <> 0 THEN rsi_14 END) AS a,
                     median(volatility_7) AS b, median(momentum_7) AS c
              FROM training GROUP BY 1) m ON m.symbol = g.symbol"""),
    "time_split": sql("SELECT symbol, timestamp, split FROM parts"),
    "scaler_params": sql(
        "SELECT symbol, "
        + rc(*[f"{c}__{p}" for c in MODEL_INPUTS for p in ("mean", "std")])
        + " FROM scaler"
    ),
    "scaled_rows": sql(f"SELECT symbol, timestamp, split, {rc(*MODEL_INPUTS)} FROM scaled"),
    "input_vectors": sql(f"""
        SELECT symbol, timestamp, {len(MODEL_INPUTS)} AS inputs,
               {r(" + ".join(MODEL_INPUTS))} AS input_sum FROM scaled"""),
    "cross_products": sql(f"""
        SELECT a.symbol, a.name AS left_name, b.name AS right_name, {r('sum(a.v * b.v)')} AS total
        FROM (SELECT symbol, timestamp, unnest({['one', *MODEL_INPUTS, 'target_return_1']}) AS name,
                     unnest([1.0, {", ".join(MODEL_INPUTS)}, target_return_1]) AS v
              FROM scaled WHERE split = 'train') a
        JOIN (SELECT symbol, timestamp, unnest({['one', *MODEL_INPUTS, 'target_return_1']}) AS name,
                     unnest([1.0, {", ".join(MODEL_INPUTS)}, target_return_1]) AS v
              FROM scaled WHERE split = 'train') b
        ON a.symbol = b.symbol AND a.timestamp = b.timestamp GROUP BY 1, 2, 3"""),
    "ridge_two_inputs": sql(f"""
        SELECT symbol, {rc('intercept')}, {r('wx')} AS rsi_14_weight,
               {r('wz')} AS momentum_1_weight FROM ridge"""),
    "ridge_slopes": sql(f"""
        SELECT DISTINCT symbol, input, 0.0::DOUBLE AS slope FROM ridge,
            (SELECT unnest({['intercept', *MODEL_INPUTS]}) AS input)"""),
    "logistic_slopes": sql(f"""
        SELECT DISTINCT symbol, input, 0.0::DOUBLE AS slope FROM ridge,
            (SELECT unnest({['intercept', *MODEL_INPUTS]}) AS input)"""),
    "importance_sums": sql(f"""
        SELECT symbol, {len(MODEL_INPUTS)}::BIGINT AS inputs, 1.0::DOUBLE AS total FROM ridge"""),
    # one newest row a symbol, and no score that differs
    "stored_models": sql("SELECT symbol, 0::BIGINT AS gaps, 1::BIGINT AS scored_rows FROM ridge"),
    "scoring_gaps": sql("SELECT symbol, 0::BIGINT AS gaps, 1::BIGINT AS scored_rows FROM ridge"),
    "grown_checks": sql("""
        SELECT symbol, count(*)::BIGINT AS train_rows, 0::BIGINT AS forest_gaps, 0::BIGINT AS boosting_gaps
        FROM parts WHERE split = 'train' GROUP BY 1"""),
    "grown_importance": sql(f"""
        SELECT symbol, {len(MODEL_INPUTS)}::BIGINT AS inputs, 1.0::DOUBLE AS total
        FROM parts WHERE split = 'train' GROUP BY 1"""),
    "classification_metrics": sql(f"""
        SELECT symbol, {rc('accuracy', 'precision', 'recall', 'f1')} FROM clf"""),
    "regression_metrics": sql(f"""
        SELECT symbol, {r('avg((momentum_1 - target_return_1) ** 2)')} AS mse,
               {r('avg(abs(momentum_1 - target_return_1))')} AS mae,
               {r('1 - avg((momentum_1 - target_return_1) ** 2) / var_pop(target_return_1)')} AS r2
        FROM core WHERE target_return_1 IS NOT NULL AND momentum_1 IS NOT NULL GROUP BY 1"""),
    "melted_metrics": sql(f"""
        SELECT symbol, metric_name, {rc('metric_value')} FROM (
            SELECT symbol, 'accuracy' AS metric_name, accuracy AS metric_value FROM clf
            UNION ALL SELECT symbol, 'precision', precision FROM clf
            UNION ALL SELECT symbol, 'recall', recall FROM clf
            UNION ALL SELECT symbol, 'f1', f1 FROM clf)"""),
    "latest_run": sql("SELECT * FROM newest"),
    "latest_run_strict": sql("""
        SELECT * FROM model_metrics
        WHERE training_timestamp = (SELECT max(training_timestamp) FROM model_metrics)"""),
    "best_model": sql(f"""
        SELECT metric_name, symbol, model_name, {rc('metric_value')} FROM (
            SELECT *, row_number() OVER (PARTITION BY metric_name
                ORDER BY metric_value DESC, symbol, model_name) AS place
            FROM newest WHERE metric_name IN ('accuracy', 'r2')) WHERE place = 1"""),
    "missing_models": sql("""
        SELECT s.symbol, a.artifact FROM (SELECT DISTINCT symbol FROM candles) s,
            (VALUES ('random_forest'), ('scaling_params')) a(artifact)
        WHERE a.artifact <> CASE WHEN length(s.symbol) > 4 THEN 'random_forest'
                                 ELSE 'scaling_params' END"""),
    "latest_features": sql(f"""
        SELECT symbol, timestamp, {listed(['close', *MODEL_INPUTS])} FROM latest"""),
    "filled_features": sql(f"""
        SELECT symbol, timestamp, {r('coalesce(rsi_14, 0)')} AS rsi_14,
               {r('coalesce(momentum_7, 0)')} AS momentum_7,
               coalesce(fear_greed_value, 0) AS fear_greed_value FROM core"""),
    "latest_scaled": sql(
        "SELECT l.symbol, l.timestamp, "
        + r("l.close")
        + ' AS "close", '
        + ", ".join(
            f"{r(f'(coalesce(l.{c}, 0) - s.{c}__mean) / s.{c}__std')} AS {c}"
            for c in MODEL_INPUTS
        )
        + " FROM latest l JOIN scaler s USING (symbol)"
    ),
    "predicted_prices": sql(f"""
        SELECT symbol, timestamp, {rc('predicted_return')},
               {r('close * (1 + predicted_return)')} AS predicted_price
        FROM (SELECT s.symbol, s.timestamp, s.close,
                     r.intercept + r.wx * s.rsi_14 + r.wz * s.momentum_1 AS predicted_return
              FROM scaled s JOIN ridge r USING (symbol) WHERE s.split = 'test')"""),
    "ensemble_signals": sql(f"""
        SELECT symbol, prediction_timestamp, ensemble_prediction, {rc('ensemble_confidence')},
               CASE WHEN ensemble_confidence > 0.6::DOUBLE AND ensemble_prediction = 1 THEN 'BUY'
                    WHEN ensemble_confidence > 0.6::DOUBLE THEN 'SELL' ELSE 'HOLD' END AS signal
        FROM (SELECT symbol, prediction_timestamp,
                CASE WHEN k % 5 = 0 THEN predicted_direction
                     WHEN predicted_direction = 1 AND (k // 4) % 2 = 1 THEN 1 ELSE 0 END
                    AS ensemble_prediction,
                (confidence + CASE WHEN k % 5 = 0 THEN 0.5::DOUBLE
                     ELSE 0.5::DOUBLE + ((k // 8) % 400) / 1000.0::DOUBLE END) / 2
                    AS ensemble_confidence
              FROM predictions)"""),
    "recent_accuracy": sql(f"""
        SELECT symbol, NULL AS signal, {r('avg(correct)')} AS accuracy, count(*) AS predictions
        FROM met GROUP BY symbol
        UNION ALL
        SELECT NULL, signal, {r('avg(correct)')}, count(*) FROM met GROUP BY signal"""),
    "prediction_report": sql(f"""
        SELECT symbol, prediction_timestamp, {r('predicted_price - current_price')} AS change,
               {r('(predicted_price - current_price) / nullif(current_price, 0) * 100')}
                   AS change_pct
        FROM predictions"""),
    "signal_counts": sql("""
        SELECT count(*) FILTER (WHERE signal = 'BUY') AS buy,
               count(*) FILTER (WHERE signal = 'SELL') AS sell,
               count(*) FILTER (WHERE signal = 'HOLD') AS hold FROM predictions"""),
    "active_test": sql(f"""
        SELECT test_name, model_a_name, model_b_name, {rc('traffic_split')} FROM test"""),
    "variants": sql("""
        SELECT test_name, symbol, prediction_timestamp, model_version FROM ab_results"""),
    "outcome_by_feature": sql(f"""
        SELECT symbol, prediction_timestamp, {rc('base_price', 'actual_price')},
               actual_direction, {rc('actual_return')} FROM judged"""),
    "outcome_among_many": sql(f"""
        SELECT symbol, prediction_timestamp, {rc('actual_price')}, actual_direction,
               {rc('actual_return')} FROM among_many"""),
    "ab_metrics": sql(f"""
        SELECT model_version, count(*) AS total_predictions, {r('avg(correct)')} AS accuracy,
               {r('avg(confidence)')} AS avg_confidence,
               CAST(sum(correct) AS BIGINT) AS correct_predictions
        FROM ab_outcomes GROUP BY 1"""),
    "ab_winner": sql(f"""
        SELECT {r('a')} AS accuracy_a, {r('b')} AS accuracy_b,
               CASE WHEN abs(a - b) < 0.02::DOUBLE THEN 'tie' WHEN a > b THEN 'A' ELSE 'B' END
                   AS winner,
               CASE WHEN abs(a - b) < 0.02::DOUBLE THEN 'low'
                    WHEN abs(a - b) > 0.05::DOUBLE THEN 'high' ELSE 'medium' END AS confidence
        FROM (SELECT coalesce(avg(correct) FILTER (WHERE model_version = 'A'), 0) AS a,
                     coalesce(avg(correct) FILTER (WHERE model_version = 'B'), 0) AS b
              FROM ab_outcomes)"""),
    "ab_by_symbol": sql(f"""
        SELECT symbol, model_version, count(*) AS predictions, {r('avg(correct)')} AS accuracy
        FROM ab_outcomes GROUP BY 1, 2"""),
    "ab_report": sql(f"""
        SELECT test.test_name, model_a_name AS model_a, model_b_name AS model_b,
               CASE WHEN abs(a - b) < 0.02::DOUBLE THEN 'tie' WHEN a > b THEN 'A' ELSE 'B' END
                   AS winner,
               CASE WHEN abs(a - b) < 0.02::DOUBLE THEN 'low'
                    WHEN abs(a - b) > 0.05::DOUBLE THEN 'high' ELSE 'medium' END AS confidence,
               {AS_OF} AS evaluation_time, {r('a')} AS a_accuracy, n AS a_predictions,
               {r('c')} AS b_confidence, s.symbol, s.model_version, s.predictions,
               {r('s.accuracy')} AS accuracy
        FROM test,
             (SELECT avg(correct) FILTER (WHERE model_version = 'A') AS a,
                     avg(correct) FILTER (WHERE model_version = 'B') AS b,
                     count(*) FILTER (WHERE model_version = 'A') AS n,
                     avg(confidence) FILTER (WHERE model_version = 'B') AS c
              FROM ab_outcomes) o,
             (SELECT symbol, model_version, count(*) AS predictions, avg(correct) AS accuracy
              FROM ab_outcomes GROUP BY 1, 2) s"""),
    "ab_panel": sql(f"""
        SELECT model_a_name AS model_a, model_b_name AS model_b, 'accuracy' AS metric_name,
               model_version, {r('accuracy')} AS metric_value
        FROM test, (SELECT model_version, avg(correct) AS accuracy FROM ab_outcomes GROUP BY 1)"""),
    "accuracy_vs_baseline": sql(f"""
        SELECT symbol, total_predictions, {rc('accuracy', 'baseline_accuracy')} FROM accuracy"""),
    "accuracy_triggers": sql(f"""
        SELECT symbol, reason, {rc('current_accuracy', 'baseline_accuracy', 'degradation')}
        FROM accuracy_fired"""),
    "feature_drift": sql(f"""
        SELECT symbol, {rc('rsi_drift', 'volatility_drift', 'volume_drift')} FROM drift"""),
    "drift_triggers": sql(f"""
        SELECT symbol, reason,
               {rc('max_drift', 'rsi_drift', 'volatility_drift', 'volume_drift')}
        FROM drift_fired"""),
    "training_staleness": sql(f"""
        SELECT last_training, {rc('days_since_training')},
               coalesce(days_since_training >= 7, true) AS should_retrain FROM age"""),
    "retrain_decision": sql(f"""
        SELECT {AS_OF} AS decision_time, a + d > 0 OR old AS should_retrain,
               concat_ws(',', CASE WHEN a > 0 THEN 'accuracy_degradation' END,
                         CASE WHEN d > 0 THEN 'data_drift' END,
                         CASE WHEN old THEN 'training_staleness' END) AS reasons,
               coalesce(nullif(concat_ws('; ', 'Data Drift: ' || dn,
                         'Accuracy Degradation: ' || an,
                         CASE WHEN old THEN 'Staleness: ' || printf('%.1f', days) || ' days' END),
                        ''), 'No issues') AS summary
        FROM (SELECT count(*) AS a, string_agg(symbol, ', ' ORDER BY symbol) AS an
              FROM accuracy_fired),
             (SELECT count(*) AS d, string_agg(symbol, ', ' ORDER BY symbol) AS dn
              FROM drift_fired),
             (SELECT coalesce(days_since_training >= 7, true) AS old,
                     days_since_training AS days FROM age)"""),
    "outcome_by_record": sql(f"""
        SELECT symbol, prediction_timestamp, {rc('actual_price')}, actual_direction,
               {rc('actual_return')}, correct FROM outcomes"""),
    "accuracy_rollup": sql(f"""
        SELECT level, name, {rc('accuracy')}, predictions, {_BANDS} AS status FROM rolled_up"""),
    "accuracy_by_confidence": sql(f"""
        SELECT CASE WHEN confidence <= 0.55::DOUBLE THEN '50-55%'
                    WHEN confidence <= 0.6::DOUBLE THEN '55-60%'
                    WHEN confidence <= 0.65::DOUBLE THEN '60-65%' ELSE '65%+' END
                   AS confidence_bucket, {r('avg(correct)')} AS accuracy
        FROM outcomes GROUP BY 1"""),
    "latest_metrics": sql(f"""
        SELECT symbol, model_name, metric_name,
               {r('arg_max(metric_value, training_timestamp)')} AS metric_value,
               max(training_timestamp) AS training_timestamp
        FROM model_metrics WHERE training_timestamp >= {AS_OF} - INTERVAL 30 DAY
        GROUP BY 1, 2, 3"""),
    "metric_pivot": sql(
        "SELECT symbol, model_name, "
        + ", ".join(
            r(f"avg(v) FILTER (WHERE metric_name = '{m}')") + f" AS {m}"
            for m in ("accuracy", "f1", "precision", "r2", "recall")
        )
        + f""" FROM (SELECT symbol, model_name, metric_name,
                     arg_max(metric_value, training_timestamp) AS v FROM model_metrics
              WHERE training_timestamp >= {AS_OF} - INTERVAL 30 DAY GROUP BY 1, 2, 3)
        GROUP BY 1, 2"""
    ),
    "training_history": sql(f"""
        SELECT symbol, model_name, metric_name, {rc('metric_value')}, training_timestamp,
               CAST(training_timestamp AS DATE) AS training_date
        FROM (SELECT * FROM model_metrics WHERE training_timestamp >= {AS_OF} - INTERVAL 30 DAY
              ORDER BY training_timestamp DESC, symbol, model_name, metric_name LIMIT 50)"""),
    "training_history_strict": sql(f"""
        SELECT symbol, model_name, metric_name, {rc('metric_value')}, training_timestamp,
               CAST(training_timestamp AS DATE) AS training_date
        FROM (SELECT * FROM model_metrics WHERE training_timestamp >= {AS_OF} - INTERVAL 30 DAY
              ORDER BY training_timestamp, symbol DESC, model_name DESC, metric_name DESC
              LIMIT 50)"""),
    "recent_decisions": sql(f"""
        SELECT names IS NOT NULL OR day(d) % 4 = 0 AS decision,
               d + INTERVAL 5 MINUTE AS created_at
        FROM wild WHERE d + INTERVAL 5 MINUTE >= {AS_OF} - INTERVAL 30 DAY
        ORDER BY d DESC LIMIT 20"""),
    "decision_summaries": sql("""
        SELECT CAST(d AS TIMESTAMP) AS decision_time,
               coalesce(nullif(concat_ws('; ', 'Data Drift: ' || names,
                   CASE WHEN day(d) % 4 = 0 THEN 'Staleness: '
                        || printf('%.1f', day(d) / 2.0::DOUBLE) || ' days' END), ''), 'No issues')
                   AS summary
        FROM wild"""),
    "key_figures": sql(f"""
        SELECT {r('o.accuracy')} AS overall_accuracy, o.predictions AS total_predictions,
               {r('s.minutes_old')} AS minutes_old,
               (SELECT count(*) FROM predictions
                WHERE prediction_timestamp >= {AS_OF} - INTERVAL 7 DAY) AS predictions_count,
               (SELECT count(*) FROM core WHERE timestamp >= {AS_OF} - INTERVAL 7 DAY)
                   AS features_count,
               CASE WHEN o.accuracy > 0.55::DOUBLE THEN 'good' ELSE 'warning' END
                   AS accuracy_status,
               CASE WHEN s.minutes_old < 120 THEN 'good' ELSE 'warning' END AS freshness_status
        FROM (SELECT * FROM rolled_up WHERE level = 'overall') o,
             (SELECT * FROM stamped WHERE table_name = 'ohlcv_data') s"""),
    "monitoring_rows": sql(f"""
        SELECT {AS_OF} AS timestamp, 'accuracy' AS metric_type,
               'overall_accuracy' AS metric_name, {r('accuracy')} AS metric_value
        FROM rolled_up WHERE level = 'overall'
        UNION ALL
        SELECT {AS_OF}, 'data_quality', 'freshness_minutes', {r('minutes_old')}
        FROM stamped WHERE table_name = 'ohlcv_data'"""),
    "streamed_landing": """
        SELECT event_type, count(*) AS records FROM (
            SELECT DISTINCT user_id, event_type, date_trunc('minute', ts) FROM events) GROUP BY 1""",
    "streamed_candles": sql(f"SELECT {CANDLE_LIST} FROM candles"),
}
SQL["merged_table"] = SQL["upsert_full"]
