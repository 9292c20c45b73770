"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog import tables as t
from catalog.tables import AS_OF
from tidemark import schema
from tidemark.operators import asof, growing, linear, merge, metrics, prepare, quality, trees
from tidemark.operators.ema import ema as exponential
from tidemark.operators.ema import macd as macd_lines
from tidemark.operators.series import tail_per_group
from tidemark.plans import abtest, features, inference, monitor, registry, retrain, training
from tidemark.sources import payloads, scans
from tidemark.sources import tables as stored
from tidemark.sources.ticks import build_candles
from tidemark.streaming import landing

KEY = ["symbol", "timestamp"]
TEST_NAME = "test_2024-01-30"
SYMBOLS = ("click", "error", "purchase", "signup", "view")


def tidy(df: DataFrame) -> DataFrame:
    """Doubles to six places for comparison.

    Two-digit prices give many values exactly half way between two roundings;
    a nudge far below the last place rounds them up whatever their last bit.
    """
    kinds = dict(df.dtypes)
    return df.select(
        *[
            (F.round(F.col(c) + 1e-9, 6) + F.lit(0.0)).alias(c) if kinds[c] in ("double", "float") else F.col(c)
            for c in df.columns
        ]
    )


# --- sources -----------------------------------------------------------------


def candles_hourly(spark, sf):
    return tidy(build_candles(t.events(spark, sf)))


def ticker_records(spark, sf):
    raw = t.candles(spark, sf).select(
        "symbol",
        F.col("timestamp").alias("fetched_at"),
        F.to_json(
            F.struct(
                F.struct(
                    F.struct(
                        F.col("close").alias("price"),
                        (F.col("trades") * 1000).alias("market_cap"),
                        F.when(F.hour("timestamp") % 2 == 0, F.col("trades")).alias("volume_24h"),
                        (F.col("close") - F.col("open")).alias("percent_change_24h"),
                        F.col("high").alias("ath_price"),
                    ).alias("USD")
                ).alias("quotes"),
                F.col("trades").alias("circulating_supply"),
            )
        ).alias("text"),
    )
    parsed = raw.withColumn("payload", F.from_json("text", payloads.TICKER_PAYLOAD))
    return tidy(payloads.normalize_tickers(parsed))


def _candle_payloads(spark, sf):
    entry = F.struct(
        t.seconds("timestamp").alias("time"),
        *[F.col(c).cast("string").alias(c) for c in ("open", "high", "low", "close")],
        F.col("volume").cast("string").alias("volumeto"),
    )
    day = F.dayofmonth("d")
    # one payload per symbol and day: at most 24 hourly entries
    daily = t.candles(spark, sf).groupBy("symbol", F.to_date("timestamp").alias("d")).agg(
        F.collect_list(entry).alias("entries")
    )
    text = F.to_json(
        F.struct(
            F.when(day % 10 == 0, "Error").otherwise("Success").alias("Response"),
            F.when(day % 10 == 0, "rate limit").alias("Message"),
            F.struct(F.col("entries").alias("Data")).alias("Data"),
        )
    )
    return daily.select("symbol", F.from_json(text, payloads.CANDLE_PAYLOAD).alias("payload"))


def candle_records(spark, sf):
    return tidy(payloads.normalize_candles(_candle_payloads(spark, sf)))


def candle_failures(spark, sf):
    failed = payloads.failed_payloads(_candle_payloads(spark, sf))
    return failed.groupBy("symbol", "message").agg(F.count(F.lit(1)).alias("payloads"))


def sentiment_records(spark, sf):
    entry = F.struct(
        t.seconds("timestamp").cast("string").alias("timestamp"),
        F.col("fear_greed_value").cast("string").alias("value"),
        F.col("fear_greed_classification").alias("value_classification"),
    )
    # two readings per date
    daily = t.sentiment(spark, sf).groupBy(F.to_date("timestamp")).agg(
        F.to_json(F.struct(F.collect_list(entry).alias("data"))).alias("text")
    )
    parsed = daily.select(F.from_json("text", payloads.SENTIMENT_PAYLOAD).alias("payload"))
    return payloads.normalize_sentiment(parsed)


def symbol_lookup(spark, sf):
    rows = t.candles(spark, sf).select("symbol", "timestamp", "close")
    return tidy(payloads.attach_symbol(rows, t.symbol_directory(spark)))


def unlisted_symbols(spark, sf):
    return payloads.unknown_symbols(t.candles(spark, sf), t.symbol_directory(spark))


def candle_scan(spark, sf):
    return tidy(scans.scan_candles(t.candles(spark, sf), "2024-01-30 00:00:00", 20))


def sentiment_scan(spark, sf):
    return scans.scan_sentiment(t.sentiment(spark, sf), "2024-01-30 00:00:00", 20)


def training_scan(spark, sf):
    return tidy(scans.scan_training(t.features(spark, sf), AS_OF))


# --- write semantics ---------------------------------------------------------


def _stored_candles(spark, sf):
    return t.candles(spark, sf).where(F.col("timestamp") < F.lit("2024-01-25").cast("timestamp_ntz"))


def _arriving_candles(spark, sf):
    """Later candles, and corrections to a fifth of the stored ones."""
    changed = t.candles(spark, sf).where(F.hour("timestamp") % 5 == 0)
    return changed.withColumns(
        {"close": F.col("close") * 2.0, "volume": F.col("volume") + 1.0}
    )


def upsert_full(spark, sf):
    return tidy(merge.upsert(_stored_candles(spark, sf), _arriving_candles(spark, sf), KEY))


def upsert_partial(spark, sf):
    return tidy(
        merge.upsert(_stored_candles(spark, sf), _arriving_candles(spark, sf), KEY, ["close"])
    )


def insert_absent(spark, sf):
    return tidy(merge.insert_new(_stored_candles(spark, sf), _arriving_candles(spark, sf), KEY))


def merged_table(spark, sf):
    """The full upsert through a stored table, in two batches."""
    path, staging = t.folder(spark, sf, "merged"), t.folder(spark, sf, "merged_staging")
    _stored_candles(spark, sf).withColumn("date", F.to_date("timestamp")).write.mode(
        "overwrite"
    ).partitionBy("date").parquet(path)
    stored.merge_into(_arriving_candles(spark, sf), path, staging, KEY)
    return tidy(stored.read_table(spark, path).drop("date"))


def appended_table(spark, sf):
    path = t.folder(spark, sf, "appended")
    first = t.predictions(spark, sf).where("signal = 'HOLD'")
    first.withColumn("date", F.to_date("prediction_timestamp")).write.mode(
        "overwrite"
    ).partitionBy("date").parquet(path)
    rest = t.predictions(spark, sf).where("signal <> 'HOLD'")
    stored.append(rest, path, "prediction_timestamp")
    rows = stored.read_table(spark, path)
    return tidy(
        rows.groupBy("date", "signal").agg(
            F.count(F.lit(1)).alias("predictions"), F.sum("confidence").alias("confidence_sum")
        )
    )


def dedupe_backfill(spark, sf):
    """Overlapping batches of ticks reduced to the last one per user and date."""
    ticks = t.events(spark, sf).select(
        "user_id", F.to_date("ts").alias("date"), "ts", "event_id", "value"
    )
    return tidy(merge.dedupe_last(ticks, ["user_id", "date"], ["ts", "event_id"]))


def _loose_predictions(spark, sf):
    """Predictions as text, some with unreadable or oversized numbers."""
    k = F.col("k")
    return t.predictions(spark, sf).select(
        "symbol", "prediction_timestamp",
        F.when(k % 11 == 0, "n/a").otherwise(F.col("current_price").cast("string"))
        .alias("current_price"),
        F.col("predicted_direction").cast("string").alias("predicted_direction"),
        F.when(k % 7 == 0, F.lit(123.5)).otherwise(F.col("confidence")).alias("confidence"),
        "signal",
    )


def accepted_rows(spark, sf):
    good, _ = merge.split_valid(_loose_predictions(spark, sf), schema.PREDICTIONS)
    price, sure = F.col("current_price").cast("double"), F.col("confidence").cast("double")
    return tidy(
        good.select(
            "symbol", "prediction_timestamp", price.alias("current_price"),
            "predicted_direction", sure.alias("confidence"), "signal",
        )
    )


def rejected_rows(spark, sf):
    _, bad = merge.split_valid(_loose_predictions(spark, sf), schema.PREDICTIONS)
    return bad.select(
        "symbol", "prediction_timestamp",
        F.array_join("rejected_columns", ",").alias("rejected_columns"),
    )


def conformed_rows(spark, sf):
    rows = merge.conform(_loose_predictions(spark, sf), schema.PREDICTIONS)
    return tidy(
        rows.groupBy("symbol").agg(
            F.count(F.lit(1)).alias("total_rows"),
            F.count("current_price").alias("prices"),
            F.count("confidence").alias("confidences"),
            F.avg(F.col("confidence").cast("double")).alias("avg_confidence"),
        )
    )


def constraint_violations(spark, sf):
    """Rows that break each rule, and those that break none, of unruly predictions."""
    k = F.col("k")
    rows = t.predictions(spark, sf).select(
        F.when(k % 13 != 0, F.col("symbol")).alias("symbol"), "prediction_timestamp",
        F.when(k % 11 == 0, "n/a").otherwise(F.col("current_price").cast("string")).alias("current_price"),
        F.when(k % 7 == 0, F.lit(123.5)).otherwise(F.col("confidence")).alias("confidence"), "k",
        F.explode(F.when(k % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("seq"),
    )
    keyed = T.StructType([T.StructField(f.name, f.dataType, f.name != "symbol") for f in schema.PREDICTIONS])
    checked = merge.check_rows(rows, keyed, ["symbol", "prediction_timestamp"], ["seq", "k"])
    rules = F.when(F.size("violations") == 0, F.array(F.lit("none"))).otherwise(F.col("violations"))
    return checked.select(F.explode(rules).alias("rule")).groupBy("rule").agg(F.count("*").alias("broken_by"))


def repeated_keys(spark, sf):
    hourly = t.events(spark, sf).select(
        F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").cast("timestamp_ntz")
        .alias("timestamp"),
    )
    return merge.duplicate_keys(hourly, KEY)


# --- indicators --------------------------------------------------------------


def _added(spark, sf, df):
    base = set(t.candles(spark, sf).columns)
    return tidy(df.select(*KEY, *[c for c in df.columns if c not in base]))


def sma(spark, sf):
    return _added(spark, sf, features.sma(t.candles(spark, sf)))


def ema(spark, sf):
    spans = {"ema_7": 7, "ema_14": 14, "ema_30": 30}
    return _added(spark, sf, exponential(t.candles(spark, sf), "close", spans))


def rsi(spark, sf):
    return _added(spark, sf, features.rsi(t.candles(spark, sf)))


def macd(spark, sf):
    return _added(spark, sf, macd_lines(t.candles(spark, sf)))


def bollinger(spark, sf):
    return _added(spark, sf, features.bollinger(t.candles(spark, sf)))


def volatility(spark, sf):
    return _added(spark, sf, features.volatility(t.candles(spark, sf)))


def momentum(spark, sf):
    return _added(spark, sf, features.momentum(t.candles(spark, sf)))


def momentum_filled(spark, sf):
    """Momentum of prices with gaps, which are carried forward."""
    prices = t.market_data(spark, sf).select(*KEY, "price_usd")
    return tidy(features.momentum(prices, "price_usd").drop("price_usd"))


def volume_ratio(spark, sf):
    return _added(spark, sf, features.volume_ratio(t.candles(spark, sf)))


def price_range(spark, sf):
    return _added(spark, sf, features.price_range(t.candles(spark, sf)))


def lags(spark, sf):
    return _added(spark, sf, features.lags(t.candles(spark, sf)))


def rolling_stats(spark, sf):
    return _added(spark, sf, features.rolling_stats(t.candles(spark, sf)))


def distance_from_extremes(spark, sf):
    added = features.distance_from_extremes(t.candles(spark, sf))
    return tidy(added.select(*KEY, *[c for c in added.columns if c.startswith("dist_")]))


def targets(spark, sf):
    return _added(spark, sf, features.targets(t.candles(spark, sf)))


def targets_strict(spark, sf):
    out = features.targets(t.candles(spark, sf), strict=True)
    return out.select(*KEY, *[f"target_direction_{h}" for h in features.HORIZONS])


def calendar_parts(spark, sf):
    return _added(spark, sf, features.calendar(t.candles(spark, sf)))


def daily_first(spark, sf):
    return features.daily_first(t.sentiment(spark, sf))


def sentiment_attached(spark, sf):
    rows = features.attach_sentiment(t.candles(spark, sf), t.sentiment(spark, sf))
    return _added(spark, sf, rows)


def series_tail(spark, sf):
    return tidy(tail_per_group(t.candles(spark, sf), 60).select(*KEY, "close"))


def feature_table(spark, sf):
    return tidy(features.engineer_features(t.candles(spark, sf), t.sentiment(spark, sf), AS_OF))


def features_from_ticks(spark, sf):
    """Flagship: ticks to candles to the short and trailing view of each symbol."""
    bars = build_candles(t.events(spark, sf))
    view = features.trend_view(bars, 500)
    return tidy(view)


def feature_summary(spark, sf):
    return tidy(features.feature_summary(t.features(spark, sf), AS_OF))


# --- quality -----------------------------------------------------------------


def stale_series(spark, sf):
    ticks = t.events(spark, sf)
    return quality.stale(ticks, "2024-01-31 00:10:00", "30 minutes", "event_type", "ts")


def missing_prices(spark, sf):
    return quality.null_count(t.market_data(spark, sf), "price_usd", AS_OF, "10 days")


def price_jumps(spark, sf):
    return tidy(quality.jumps(t.market_data(spark, sf), "price_usd", 0.5, AS_OF, "2 days"))


def jump_counts(spark, sf):
    return quality.jump_counts(t.features(spark, sf), "close", 0.10, AS_OF)


def validation_row(spark, sf):
    return quality.validate(
        t.market_data(spark, sf), "2024-01-30 23:40:00", null_window="10 days",
        jump_window="2 days",
    )


def _fresh(spark, sf):
    return quality.freshness(
        {"ohlcv_data": t.candles(spark, sf), "features": t.features(spark, sf)}, AS_OF
    )


def table_freshness(spark, sf):
    return tidy(_fresh(spark, sf))


def _complete(spark, sf):
    cols = {"null_rsi": "rsi_14", "null_macd": "macd", "null_sentiment": "fear_greed_value"}
    return quality.completeness(t.features(spark, sf), cols, AS_OF, "30 days")


def feature_completeness(spark, sf):
    return tidy(monitor.completeness_status(_complete(spark, sf)))


def _counts(spark, sf):
    return quality.record_counts(
        {
            "ohlcv": (t.candles(spark, sf), "timestamp"),
            "features": (t.features(spark, sf), "timestamp"),
            "predictions": (t.predictions(spark, sf), "prediction_timestamp"),
        },
        AS_OF,
    )


def record_counts(spark, sf):
    return _counts(spark, sf)


def candle_coverage(spark, sf):
    return tidy(quality.coverage(t.candles(spark, sf)))


def volume_gate(spark, sf):
    return quality.require_rows(scans.scan_training(t.features(spark, sf), AS_OF), 660, "symbol")


# --- training ----------------------------------------------------------------


def _training_rows(spark, sf):
    return scans.scan_training(t.features(spark, sf), AS_OF)


def medians(spark, sf):
    return tidy(prepare.group_medians(_training_rows(spark, sf), schema.MODEL_INPUTS))


def imputed(spark, sf):
    gaps = _training_rows(spark, sf).withColumn(
        "rsi_14", F.when(F.hour("timestamp") % 6 != 0, F.col("rsi_14"))
    )
    filled = prepare.impute_median(gaps, ["rsi_14", "volatility_7", "momentum_7"])
    return tidy(filled.select(*KEY, "rsi_14", "volatility_7", "momentum_7"))


def time_split(spark, sf):
    return prepare.time_split(_training_rows(spark, sf)).select(*KEY, "split")


def _preparation(spark, sf):
    return training.prepare_training(t.features(spark, sf), AS_OF, t.folder(spark, sf, "preparing"))


def _prepared(spark, sf):
    return t.settle(spark, sf, "prepared", lambda: _preparation(spark, sf)[0])


def _scaler(spark, sf):
    _prepared(spark, sf)
    # written beside the prepared rows, by the same run
    return spark.read.parquet(t.folder(spark, sf, "preparing") + "/scaler")


def scaler_params(spark, sf):
    return tidy(_scaler(spark, sf))


def scaled_rows(spark, sf):
    rows = _prepared(spark, sf)
    return tidy(rows.select(*KEY, "split", *schema.MODEL_INPUTS))


def input_vectors(spark, sf):
    from pyspark.ml.functions import vector_to_array

    rows = prepare.assemble(_prepared(spark, sf)).select(*KEY, vector_to_array("features").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return tidy(rows.select(*KEY, F.size("v").alias("inputs"), total.alias("input_sum")))


def cross_products(spark, sf):
    rows = _prepared(spark, sf).where("split = 'train'")
    out = linear.gram(rows, schema.MODEL_INPUTS, schema.RETURN_TARGET)
    return tidy(out)


RIDGE_INPUTS = ("rsi_14", "momentum_1")


def _two_input_ridge(spark, sf):
    rows = _prepared(spark, sf).where("split = 'train'")
    return linear.fit_ridge(rows, RIDGE_INPUTS)


def ridge_two_inputs(spark, sf):
    model = _two_input_ridge(spark, sf)
    return tidy(
        model.select(
            "symbol", "intercept",
            *[F.col("coefficients")[i].alias(f"{c}_weight") for i, c in enumerate(RIDGE_INPUTS)],
        )
    )


def ridge_model(spark, sf):
    rows = _prepared(spark, sf).where("split = 'train'")
    model = linear.fit_ridge(rows)
    return model.select("symbol", "intercept", F.size("coefficients").alias("inputs"))


def logistic_model(spark, sf):
    rows = _prepared(spark, sf).where("split = 'train'")
    model = linear.fit_logistic(rows)
    return model.select("symbol", "intercept", F.size("coefficients").alias("inputs"))


def _slopes(scored, model, error, places):
    """Slope of a fitted objective, penalty included, per symbol and input."""
    inputs = schema.MODEL_INPUTS
    sums = scored.groupBy("symbol").agg(
        F.sum(error).alias("intercept_slope"),
        *[F.sum(F.col(c) * error).alias(c) for c in inputs],
    )
    joined = sums.join(model.select("symbol", "coefficients"), "symbol")
    parts = [F.struct(F.lit("intercept").alias("input"), F.col("intercept_slope").alias("slope"))]
    for i, c in enumerate(inputs):
        slope = F.col(c) + F.col("coefficients")[i]
        parts.append(F.struct(F.lit(c).alias("input"), slope.alias("slope")))
    rows = joined.select("symbol", F.explode(F.array(*parts)).alias("p")).select("symbol", "p.*")
    return rows.withColumn("slope", F.round("slope", places) + F.lit(0.0))


def ridge_slopes(spark, sf):
    """The normal equations of the full ridge model: all zero where it is optimal."""
    rows = _prepared(spark, sf).where("split = 'train'").where(F.col(schema.RETURN_TARGET).isNotNull())
    model = linear.fit_ridge(rows)
    scored = linear.predict_linear(rows, model, out="_z")
    return _slopes(scored, model, F.col("_z") - F.col(schema.RETURN_TARGET), 6)


def logistic_slopes(spark, sf):
    """The gradient of the logistic objective at the fitted coefficients."""
    rows = _prepared(spark, sf).where("split = 'train'")
    rows = rows.where(F.col(schema.DIRECTION_TARGET).isNotNull())
    model = linear.fit_logistic(rows)
    scored = linear.predict_logistic(rows, model)
    return _slopes(scored, model, F.col("prob_up") - F.col(schema.DIRECTION_TARGET), 4)


def _all_judged(spark, sf):
    """All predictions, however old, with their outcomes."""
    return asof.nearest_outcome(t.predictions(spark, sf), t.candles(spark, sf), base="feature")


def classification_metrics(spark, sf):
    found = _all_judged(spark, sf)
    return tidy(
        metrics.clf_metrics(found, ["symbol"], "actual_direction", "predicted_direction")
    )


def regression_metrics(spark, sf):
    rows = t.features(spark, sf).where("target_return_1 IS NOT NULL AND momentum_1 IS NOT NULL")
    return tidy(metrics.reg_metrics(rows, ["symbol"], "target_return_1", "momentum_1"))


def melted_metrics(spark, sf):
    found = _all_judged(spark, sf)
    wide = metrics.clf_metrics(found, ["symbol"], "actual_direction", "predicted_direction")
    return tidy(metrics.melt_metrics(wide, ["symbol"], training.CLF_METRICS))


def latest_run(spark, sf):
    return metrics.latest_run(t.model_metrics(spark, sf)).select(*schema.MODEL_METRICS.names)


def latest_run_strict(spark, sf):
    rows = metrics.latest_run(t.model_metrics(spark, sf), strict=True)
    return rows.select(*schema.MODEL_METRICS.names)


def best_model(spark, sf):
    return tidy(metrics.best_model(metrics.latest_run(t.model_metrics(spark, sf))))


# Settings other than the defaults (100 trees, 100 rounds) of the tree models.
FOREST: dict = {}
BOOSTING: dict = {}
_trained: dict = {}


def _all_models(spark, sf):
    """All models of all symbols, fitted once per application."""
    place = (spark.sparkContext.applicationId, sf)
    if place not in _trained:
        _trained[place] = training.train(
            t.features(spark, sf), AS_OF, SYMBOLS, t.folder(spark, sf, "training"),
            FOREST, BOOSTING,
        )
    return _trained[place]


def trained_metrics(spark, sf):
    return _all_models(spark, sf)[1]


def importance_sums(spark, sf):
    """Inputs of each forest and the sum of their importance, which is one."""
    found = forest_importance(spark, sf)
    total = F.round(F.sum("importance"), 6)
    return found.groupBy("symbol").agg(F.count("*").alias("inputs"), total.alias("total"))


def forest_importance(spark, sf):
    models, _ = _all_models(spark, sf)
    return training.importance(models.random_forest, spark)


# Settings of the trees that are grown for all symbols together.
GROWN_FOREST: dict = {}
GROWN_BOOSTING: dict = {"rounds": 10}
_grown: dict = {}


def _grown_trees(spark, sf):
    """Packed ensembles and nodes of all symbols, grown once per application."""
    place = (spark.sparkContext.applicationId, sf)
    if place not in _grown:
        rows = _prepared(spark, sf).where("split = 'train'")
        _grown[place] = training.grow_together(rows, t.folder(spark, sf, "grown"), GROWN_FOREST, GROWN_BOOSTING)
    return _grown[place]


def grown_checks(spark, sf):
    """Rows below the first boosting tree's root, and nodes of either kind that do not
    hold what their parents left them."""
    _, forest, boosting = _grown_trees(spark, sf)
    roots = boosting.where("tree = 0 AND node = 1").select("symbol", F.col("n").cast("long").alias("train_rows"))
    node = ["symbol", "tree", "node"]
    odd = F.expr("abs(a.n - b.n) > 1e-6 OR abs(a.s - b.s) > 1e-6 OR b.n IS NULL")
    wrong = [
        nodes.alias("a").join(growing.leaf_values(nodes).alias("b"), node, "left")
        .groupBy("symbol").agg(F.count_if(odd).alias(name))
        for nodes, name in ((forest, "forest_gaps"), (boosting, "boosting_gaps"))
    ]
    return roots.join(wrong[0], "symbol").join(wrong[1], "symbol")


def grown_importance(spark, sf):
    """Inputs and the sum of their importance in the forests, which is one."""
    found = growing.grown_importance(_grown_trees(spark, sf)[1])
    total = F.round(F.sum("importance"), 6)
    return found.groupBy("symbol").agg(F.count("*").alias("inputs"), total.alias("total"))


def grown_metrics(spark, sf):
    """Validation metrics of the trees that were grown together."""
    packed = _grown_trees(spark, sf)[0]
    held = _prepared(spark, sf).where("split = 'validation'")
    names = {"random_forest": "random_forest", "gradient_boosting": "gradient_boosting"}
    scored = trees.score_trees(held, packed, names, parts=training.SCORE_PARTS)
    parts = []
    for name in names:
        measured = metrics.clf_metrics(scored, ["symbol"], schema.DIRECTION_TARGET, f"{name}_prediction")
        named = measured.withColumn("model_name", F.lit(name))
        parts.append(metrics.melt_metrics(named, ["symbol", "model_name"], training.CLF_METRICS))
    return parts[0].unionByName(parts[1])


_SCORES = [f"{p}_{c}" for p in ("rf", "gb") for c in ("prediction", "confidence", "prob_up", "prob_down")]


def _gaps(one, other):
    """Symbols and how many of their scores differ by more than rounding."""
    told = [F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) for c in _SCORES]
    apart = F.sum(sum([F.when(gap <= 1e-9, 0).otherwise(1) for gap in told]))
    both = one.alias("a").join(other.alias("b"), KEY, "full")
    return both.groupBy("symbol").agg(apart.alias("gaps"), F.count("*").alias("scored_rows"))


def stored_models(spark, sf):
    """Scores by the models in memory against those of the run read back."""
    models, _ = _all_models(spark, sf)
    path = t.folder(spark, sf, "models")
    registry.save_models(models, path, AS_OF)
    loaded = registry.load_models(spark, path, SYMBOLS, AS_OF)
    return _gaps(_scored(spark, sf, models), _scored(spark, sf, loaded))


def scoring_gaps(spark, sf):
    """Scores by node tables against those of each symbol's own model objects."""
    models, _ = _all_models(spark, sf)
    kinds = {"rf": models.random_forest, "gb": models.gradient_boosting}
    rows = _live_rows(spark, sf, models)
    prefixes = {"random_forest": "rf", "gradient_boosting": "gb"}
    return _gaps(trees.score_trees(rows, models.nodes, prefixes), inference.score_clf(kinds, rows))


# --- inference ---------------------------------------------------------------


def missing_models(spark, sf):
    symbols = t.candles(spark, sf).select("symbol")
    entries = F.when(F.length("symbol") > 4, "random_forest").otherwise("scaling_params")
    registry = symbols.distinct().withColumn("artifact", entries)
    return inference.missing_models(symbols, registry)


def latest_features(spark, sf):
    return tidy(inference.latest_features(t.features(spark, sf)))


def filled_features(spark, sf):
    rows = t.features(spark, sf).select(*KEY, *schema.MODEL_INPUTS)
    return tidy(inference.fill(rows).select(*KEY, "rsi_14", "momentum_7", "fear_greed_value"))


def latest_scaled(spark, sf):
    rows = inference.fill(inference.latest_features(t.features(spark, sf)))
    return tidy(prepare.apply_scaler(rows, _scaler(spark, sf)))


def predicted_prices(spark, sf):
    rows = _prepared(spark, sf).where("split = 'test'")
    scored = inference.score_reg(_two_input_ridge(spark, sf), rows, RIDGE_INPUTS)
    return tidy(scored.select(*KEY, "predicted_return", "predicted_price"))


def _live_rows(spark, sf, models):
    """The newest row of each symbol, scaled, stored for the scoring passes."""

    def build():
        rows = inference.fill(inference.latest_features(t.features(spark, sf)))
        return prepare.apply_scaler(rows, models.scaler)

    return t.settle(spark, sf, "live_rows", build)


def _scored(spark, sf, models):
    scaled = _live_rows(spark, sf, models)
    prefixes = {"random_forest": "rf", "gradient_boosting": "gb"}
    out = inference.score_reg(models.ridge, trees.score_trees(scaled, models.nodes, prefixes))
    out = inference.ensemble(
        out, ["rf_prediction", "gb_prediction"], ["rf_confidence", "gb_confidence"]
    )
    return inference.signal(out).drop(*schema.MODEL_INPUTS)


def live_predictions(spark, sf):
    return _scored(spark, sf, _all_models(spark, sf)[0])


def _votes(spark, sf):
    k = F.col("k")
    return t.predictions(spark, sf).select(
        "symbol", "prediction_timestamp",
        F.col("predicted_direction").alias("rf_prediction"),
        F.col("confidence").alias("rf_confidence"),
        F.when(k % 5 != 0, (F.expr("k div 4") % 2).cast("int")).alias("gb_prediction"),
        F.when(k % 5 != 0, F.lit(0.5) + (F.expr("k div 8") % 400) / F.lit(1000.0))
        .alias("gb_confidence"),
    )


def ensemble_signals(spark, sf):
    voted = inference.ensemble(
        _votes(spark, sf), ["rf_prediction", "gb_prediction"], ["rf_confidence", "gb_confidence"]
    )
    out = inference.signal(voted)
    return tidy(
        out.select(
            "symbol", "prediction_timestamp", "ensemble_prediction", "ensemble_confidence",
            "signal",
        )
    )


def recent_accuracy(spark, sf):
    found = inference.recent_accuracy(
        t.predictions(spark, sf), t.features(spark, sf), AS_OF, "20 hours", "2 hours"
    )
    return tidy(inference.accuracy_by(found, "symbol", "signal"))


def prediction_report(spark, sf):
    rows = inference.prediction_report(t.predictions(spark, sf))
    return tidy(rows.select("symbol", "prediction_timestamp", "change", "change_pct"))


def signal_counts(spark, sf):
    return inference.signal_counts(t.predictions(spark, sf))


# --- A/B tests ---------------------------------------------------------------


def active_test(spark, sf):
    return tidy(abtest.active_test(t.ab_config(spark, sf)))


def variants(spark, sf):
    return t.ab_results(spark, sf).select(
        "test_name", "symbol", "prediction_timestamp", "model_version"
    )


def ab_predictions(spark, sf):
    """Latest rows scored by the model their variant names."""
    models, _ = _all_models(spark, sf)
    scaled = _live_rows(spark, sf, models)
    drawn = abtest.assign_variant(scaled, abtest.active_test(t.ab_config(spark, sf)), "timestamp")
    out = abtest.ab_score(drawn, models.nodes)
    return out.drop(*schema.MODEL_INPUTS)


def outcome_by_feature(spark, sf):
    found = asof.nearest_outcome(
        t.predictions(spark, sf), t.candles(spark, sf), base="feature"
    )
    return tidy(
        found.select(
            "symbol", "prediction_timestamp", "base_price", "actual_price", "actual_direction",
            "actual_return",
        )
    )


def outcome_among_many(spark, sf):
    """Predictions at odd minutes against ten-minute candles, with equal distances."""
    shift = F.make_dt_interval(mins=(F.col("k") % 13).cast("int"))
    shifted = t.predictions(spark, sf).withColumn(
        "prediction_timestamp", F.col("prediction_timestamp") + shift
    )
    found = asof.nearest_outcome(shifted, t.fine_candles(spark, sf))
    return tidy(
        found.select(
            "symbol", "prediction_timestamp", "actual_price", "actual_direction", "actual_return"
        )
    )


def _ab_outcomes(spark, sf):
    return abtest.ab_outcomes(t.ab_results(spark, sf), t.candles(spark, sf), TEST_NAME, AS_OF)


def ab_metrics(spark, sf):
    return tidy(abtest.ab_metrics(_ab_outcomes(spark, sf)))


def ab_winner(spark, sf):
    return tidy(abtest.ab_winner(abtest.ab_metrics(_ab_outcomes(spark, sf))))


def ab_by_symbol(spark, sf):
    return tidy(abtest.ab_by_symbol(_ab_outcomes(spark, sf)))


def _report_path(spark, sf):
    path = t.folder(spark, sf, "ab_report")
    test = abtest.active_test(t.ab_config(spark, sf))
    stored.write_report(abtest.ab_report(test, _ab_outcomes(spark, sf), AS_OF), path)
    return path


def ab_report(spark, sf):
    """The nested report written as JSON, read back and flattened."""
    report = stored.read_report(spark, _report_path(spark, sf))
    return tidy(
        report.select(
            "test_name", "model_a", "model_b", "winner", "confidence", "evaluation_time",
            F.col("model_a_metrics.accuracy").alias("a_accuracy"),
            F.col("model_a_metrics.predictions").alias("a_predictions"),
            F.col("model_b_metrics.avg_confidence").alias("b_confidence"),
            F.inline("per_symbol"),
        )
    )


def ab_panel(spark, sf):
    return tidy(monitor.ab_panel(stored.read_report(spark, _report_path(spark, sf))))


# --- retraining --------------------------------------------------------------


def _judged(spark, sf):
    return retrain.judged_predictions(t.predictions(spark, sf), t.candles(spark, sf), AS_OF)


def _accuracy(spark, sf):
    return retrain.accuracy_vs_baseline(_judged(spark, sf), AS_OF)


def accuracy_vs_baseline(spark, sf):
    return tidy(_accuracy(spark, sf))


def accuracy_triggers(spark, sf):
    return tidy(retrain.accuracy_triggers(_accuracy(spark, sf), floor=0.5, drop=0.01))


def feature_drift(spark, sf):
    return tidy(retrain.drift(t.features(spark, sf), AS_OF))


def drift_triggers(spark, sf):
    return tidy(retrain.drift_triggers(retrain.drift(t.features(spark, sf), AS_OF), 0.05))


def training_staleness(spark, sf):
    return tidy(retrain.staleness(t.model_metrics(spark, sf), AS_OF))


def _decision(spark, sf):
    return retrain.decide(
        retrain.accuracy_triggers(_accuracy(spark, sf), floor=0.5, drop=0.01),
        retrain.drift_triggers(retrain.drift(t.features(spark, sf), AS_OF), 0.05),
        retrain.staleness(t.model_metrics(spark, sf), AS_OF),
        AS_OF,
    )


def retrain_decision(spark, sf):
    row = monitor.decision_summary(_decision(spark, sf))
    return row.select(
        "decision_time", "should_retrain", F.array_join("reasons", ",").alias("reasons"), "summary"
    )


# --- monitoring --------------------------------------------------------------


def _outcomes(spark, sf):
    return monitor.outcomes(t.predictions(spark, sf), t.features(spark, sf), AS_OF)


def outcome_by_record(spark, sf):
    return tidy(
        _outcomes(spark, sf).select(
            "symbol", "prediction_timestamp", "actual_price", "actual_direction",
            "actual_return", "correct",
        )
    )


def accuracy_rollup(spark, sf):
    return tidy(monitor.accuracy_status(monitor.accuracy_rollup(_outcomes(spark, sf))))


def accuracy_by_confidence(spark, sf):
    return tidy(monitor.accuracy_by_confidence(_outcomes(spark, sf)))


def latest_metrics(spark, sf):
    return tidy(metrics.latest_metrics(t.model_metrics(spark, sf), AS_OF))


def metric_pivot(spark, sf):
    latest = metrics.latest_metrics(t.model_metrics(spark, sf), AS_OF)
    return tidy(
        metrics.pivot_metrics(latest, ["accuracy", "f1", "precision", "r2", "recall"])
    )


def training_history(spark, sf):
    return tidy(metrics.training_history(t.model_metrics(spark, sf), 50, AS_OF))


def training_history_strict(spark, sf):
    return tidy(metrics.training_history(t.model_metrics(spark, sf), 50, AS_OF, strict=True))


def recent_decisions(spark, sf):
    rows = monitor.recent_decisions(t.retrain_decisions(spark, sf), AS_OF)
    return rows.select("decision", "created_at")


def decision_summaries(spark, sf):
    rows = monitor.decision_summary(t.retrain_decisions(spark, sf))
    return rows.select("decision_time", "summary")


def key_figures(spark, sf):
    rolled = monitor.accuracy_rollup(_outcomes(spark, sf))
    return tidy(monitor.key_figures(rolled, _fresh(spark, sf), _counts(spark, sf)))


def monitoring_rows(spark, sf):
    rolled = monitor.accuracy_rollup(_outcomes(spark, sf))
    rows = monitor.monitoring_rows(rolled, _fresh(spark, sf), AS_OF)
    return tidy(rows.drop("metadata"))


# --- streaming ---------------------------------------------------------------


def _tick_stream(spark, sf):
    shape = t.events(spark, sf).schema
    return landing.read_files(spark, sf, shape, "events.parquet")


def _fresh_folder(spark, sf, name):
    """A new folder for one run: a stream must not resume an earlier one."""
    return t.folder(spark, sf, f"{name}_{spark.sparkContext._jvm.java.util.UUID.randomUUID()}")


def streamed_landing(spark, sf):
    """Ticks landed once per user, type and minute."""
    base = _fresh_folder(spark, sf, "landing")
    minute = F.date_trunc("minute", "ts").cast("timestamp_ntz")
    ticks = _tick_stream(spark, sf).select("user_id", "event_type", minute.alias("ts"))
    landing.land_stream(
        ticks, f"{base}/table", f"{base}/staging", f"{base}/checkpoint", ["user_id", "event_type", "ts"], "ts"
    ).awaitTermination()
    landed = spark.read.parquet(f"{base}/table")
    return landed.groupBy("event_type").agg(F.count(F.lit(1)).alias("records"))


def _run_candle_stream(spark, sf):
    base = _fresh_folder(spark, sf, "stream")
    landing.candle_stream(
        _tick_stream(spark, sf), f"{base}/table", f"{base}/staging", f"{base}/checkpoint"
    ).awaitTermination()
    return landing.read_candles(spark, f"{base}/table")


def streamed_candles(spark, sf):
    return tidy(_run_candle_stream(spark, sf))


QUERIES = [
    candles_hourly, ticker_records, candle_records, candle_failures, sentiment_records,
    symbol_lookup, unlisted_symbols, candle_scan, sentiment_scan, training_scan,
    upsert_full, upsert_partial, insert_absent, merged_table, appended_table, dedupe_backfill,
    accepted_rows, rejected_rows, conformed_rows, constraint_violations, repeated_keys,
    sma, ema, rsi, macd, bollinger, volatility, momentum, momentum_filled, volume_ratio,
    price_range, lags, rolling_stats, distance_from_extremes, targets, targets_strict,
    calendar_parts, daily_first, sentiment_attached, series_tail, feature_table,
    features_from_ticks, feature_summary,
    stale_series, missing_prices, price_jumps, jump_counts, validation_row, table_freshness,
    feature_completeness, record_counts, candle_coverage, volume_gate,
    medians, imputed, time_split, scaler_params, scaled_rows, input_vectors, cross_products,
    ridge_two_inputs, ridge_model, ridge_slopes, logistic_model, logistic_slopes, classification_metrics, regression_metrics,
    melted_metrics, latest_run, latest_run_strict, best_model, trained_metrics,
    forest_importance, importance_sums, stored_models, scoring_gaps,
    grown_checks, grown_importance, grown_metrics,
    missing_models, latest_features, filled_features, latest_scaled, predicted_prices,
    live_predictions, ensemble_signals, recent_accuracy, prediction_report, signal_counts,
    active_test, variants, ab_predictions, outcome_by_feature, outcome_among_many, ab_metrics,
    ab_winner, ab_by_symbol, ab_report, ab_panel,
    accuracy_vs_baseline, accuracy_triggers, feature_drift, drift_triggers,
    training_staleness, retrain_decision,
    outcome_by_record, accuracy_rollup, accuracy_by_confidence, latest_metrics, metric_pivot,
    training_history, training_history_strict, recent_decisions, decision_summaries,
    key_figures, monitoring_rows,
    streamed_landing, streamed_candles,
]
