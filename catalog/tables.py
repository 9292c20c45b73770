"""Input tables of the registered queries, derived from the given tables.

Tables that the operators treat as stored (candles, features, predictions and
so on) are written once per application to the shared folder and read back, as
a scheduled run would find them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.abtest import active_test, assign_variant
from tidemark.plans.features import engineer_features
from tidemark.plans.inference import signal_of
from tidemark.session import configure, shared_dir
from tidemark.sources.ticks import build_candles

AS_OF = "2024-01-31 00:00:00"

_settled: dict[tuple[str, str, str], str] = {}


def folder(spark: SparkSession, sf: str, name: str) -> str:
    tag = hashlib.md5(sf.encode()).hexdigest()[:8]
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/{app}/{tag}/{name}"


def settle(
    spark: SparkSession, sf: str, name: str, build: Callable[[], DataFrame]
) -> DataFrame:
    """The stored table ``name``, written on first use."""
    configure(spark)
    place = (spark.sparkContext.applicationId, sf, name)
    if place not in _settled:
        path = folder(spark, sf, name)
        build().write.mode("overwrite").parquet(path)
        _settled[place] = path
    return spark.read.parquet(_settled[place])


def events(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf}/events.parquet")


def candles(spark: SparkSession, sf: str) -> DataFrame:
    return settle(spark, sf, "candles", lambda: build_candles(events(spark, sf)))


def fine_candles(spark: SparkSession, sf: str) -> DataFrame:
    return settle(
        spark, sf, "fine_candles", lambda: build_candles(events(spark, sf), "10 minutes")
    )


def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Two readings per date, the morning one sometimes missing; some dates lack both."""

    def build():
        daily = (
            events(spark, sf)
            .groupBy(F.to_date("ts").alias("d"))
            .agg((F.countDistinct("user_id") % 101).alias("v"))
            .where(F.dayofmonth("d") % 7 != 3)
        )
        morning = F.when(F.dayofmonth("d") % 5 != 0, F.col("v"))
        midnight = F.col("d").cast("timestamp_ntz")
        readings = F.array(
            F.struct(
                (midnight + F.expr("INTERVAL 6 HOURS")).alias("timestamp"),
                morning.alias("fear_greed_value"),
            ),
            F.struct(
                (midnight + F.expr("INTERVAL 18 HOURS")).alias("timestamp"),
                (F.col("v") * 7 % 101).alias("fear_greed_value"),
            ),
        )
        v = F.col("fear_greed_value")
        name = (
            F.when(v <= 20, "extreme_fear").when(v <= 40, "fear").when(v <= 60, "neutral")
            .when(v <= 80, "greed").when(v.isNotNull(), "extreme_greed")
        )
        return daily.select(F.inline(readings)).withColumn("fear_greed_classification", name)

    return settle(spark, sf, "sentiment", build)


def features(spark: SparkSession, sf: str) -> DataFrame:
    return settle(
        spark,
        sf,
        "features",
        lambda: engineer_features(candles(spark, sf), sentiment(spark, sf), AS_OF),
    )


def number_of(*parts: Column) -> Column:
    """A number in [0, 2^32) from the md5 of the parts."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def seconds(time: str) -> Column:
    return F.unix_timestamp(F.col(time).cast("timestamp"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """One prediction per candle, with values drawn from a hash of its key."""

    def build():
        k = F.col("k")
        drawn = candles(spark, sf).withColumn("k", number_of(F.col("symbol"), seconds("timestamp")))
        direction = (k % 2).cast("int")
        confidence = F.lit(0.5) + (F.expr("k div 2") % 500) / F.lit(1000.0)
        return drawn.select(
            "symbol",
            F.col("timestamp").alias("prediction_timestamp"),
            F.col("close").alias("current_price"),
            direction.alias("predicted_direction"),
            confidence.alias("confidence"),
            signal_of(direction, confidence).alias("signal"),
            (F.col("close") * (F.lit(1.0) + (k % 100 - 50) / F.lit(1000.0))).alias(
                "predicted_price"
            ),
            "k",
        )

    return settle(spark, sf, "predictions", build)


def ab_config(spark: SparkSession, sf: str) -> DataFrame:
    """One test per day of data; every third day's test is active."""
    day = F.col("d")
    return (
        candles(spark, sf)
        .select(F.to_date("timestamp").alias("d"))
        .distinct()
        .select(
            F.concat(F.lit("test_"), day.cast("string")).alias("test_name"),
            F.lit("random_forest").alias("model_a_name"),
            F.lit("gradient_boosting").alias("model_b_name"),
            (F.lit(0.3) + F.dayofmonth(day) / F.lit(100.0))
            .cast("decimal(3,2)")
            .alias("traffic_split"),
            F.when(F.dayofmonth(day) % 3 == 0, "active").otherwise("ended").alias("status"),
            day.cast("timestamp_ntz").alias("created_at"),
        )
    )


def ab_results(spark: SparkSession, sf: str) -> DataFrame:
    return settle(
        spark,
        sf,
        "ab_results",
        lambda: assign_variant(predictions(spark, sf), active_test(ab_config(spark, sf))).select(
            "test_name", "symbol", "model_version", "prediction_timestamp",
            "predicted_direction", "confidence",
        ),
    )


def model_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of training runs on some days, each symbol at its own minute."""

    def build():
        runs = (
            candles(spark, sf)
            .select("symbol", F.to_date("timestamp").alias("d"))
            .distinct()
            .where(F.dayofmonth("d") % 9 == 1)
        )
        models = ("gradient_boosting", "logistic_regression", "random_forest")
        metrics = ("accuracy", "f1", "precision", "r2", "recall")
        listed = lambda names: F.explode(F.array(*[F.lit(n) for n in names]))
        rows = runs.withColumn("model_name", listed(models)).withColumn(
            "metric_name", listed(metrics)
        )
        value = number_of(*[F.col(c) for c in ("symbol", "model_name", "metric_name", "d")])
        minutes = (number_of(F.col("symbol")) % 60).cast("int")
        return rows.select(
            "symbol", "model_name", "metric_name",
            (value % 1000 / F.lit(1000.0)).alias("metric_value"),
            (F.col("d").cast("timestamp_ntz") + F.make_dt_interval(mins=minutes)).alias(
                "training_timestamp"
            ),
        )

    return settle(spark, sf, "model_metrics", build)


def market_data(spark: SparkSession, sf: str) -> DataFrame:
    """Candle closes as prices, with missing and tripled ones mixed in."""
    hour = F.expr("unix_timestamp(CAST(timestamp AS TIMESTAMP)) div 3600")
    price = F.when(hour % 97 != 0, F.when(hour % 89 == 0, F.col("close") * 3).otherwise(
        F.col("close")))
    return candles(spark, sf).select(
        "symbol", "timestamp", price.alias("price_usd"), F.col("volume").alias("total_volume")
    )


def symbol_directory(spark: SparkSession) -> DataFrame:
    """Exchange code and provider id; one event type is not listed."""
    rows = [
        ("click", "CLK", "clk-click"),
        ("purchase", "PUR", "pur-purchase"),
        ("view", "VEW", "vew-view"),
        ("signup", "SGN", "sgn-signup"),
    ]
    return spark.createDataFrame(rows, "symbol string, code string, provider_id string")


def retrain_decisions(spark: SparkSession, sf: str) -> DataFrame:
    """One decision per day, with the symbols that traded oddly that day."""

    def build():
        daily = (
            candles(spark, sf)
            .groupBy(F.to_date("timestamp").alias("d"), "symbol")
            .agg(F.max("high").alias("top"), F.min("low").alias("bottom"))
        )
        wild = F.when(F.col("top") > F.lit(20.0) * F.col("bottom"), F.struct("symbol"))
        days = daily.groupBy("d").agg(F.array_sort(F.collect_list(wild)).alias("t"))
        old = F.dayofmonth("d") % 4 == 0
        reasons = F.array_compact(
            F.array(
                F.when(F.size("t") > 0, "data_drift"), F.when(old, "training_staleness")
            )
        )
        at = F.col("d").cast("timestamp_ntz")
        details = F.to_json(
            F.struct(
                reasons.alias("reasons"),
                F.struct(F.col("t").alias("triggers")).alias("drift_check"),
                F.struct((F.dayofmonth("d") / F.lit(2.0)).alias("days_since_training")).alias(
                    "staleness_check"
                ),
            )
        )
        return days.select(
            at.alias("decision_time"),
            (F.size(reasons) > 0).alias("should_retrain"),
            reasons.alias("reasons"),
            details.alias("details"),
            (at + F.expr("INTERVAL 5 MINUTES")).alias("created_at"),
        )

    return settle(spark, sf, "retrain_decisions", build)
