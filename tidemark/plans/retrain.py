"""Checks that decide whether models need retraining."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.asof import nearest_outcome
from tidemark.session import before, moment, seconds_between
from tidemark.sources.scans import since

# Thresholds of the checks.
ACCURACY_FLOOR = 0.48
ACCURACY_DROP = 0.10
MIN_PREDICTIONS = 50
DRIFT_LIMIT = 0.30
MAX_AGE_DAYS = 7.0
DRIFT_FEATURES = {
    "rsi_drift": "rsi_14",
    "volatility_drift": "volatility_7",
    "volume_drift": "volume_ratio",
}


def judged_predictions(
    predictions: DataFrame, prices: DataFrame, as_of, oldest: str = "10 days"
) -> DataFrame:
    """Predictions of the trailing days with their outcomes; no older row is read."""
    return nearest_outcome(predictions, prices, base="feature", start=before(as_of, oldest))


def accuracy_vs_baseline(
    outcomes: DataFrame,
    as_of,
    current: str = "3 days",
    oldest: str = "10 days",
    time: str = "prediction_timestamp",
) -> DataFrame:
    """Current accuracy and that of the days before, per symbol, in one pass."""
    at = F.col(time)
    recent = at >= before(as_of, current)
    return (
        outcomes.where(at >= before(as_of, oldest))
        .groupBy("symbol")
        .agg(
            F.count_if(recent).alias("total_predictions"),
            F.avg(F.when(recent, F.col("correct"))).alias("accuracy"),
            F.avg(F.when(~recent, F.col("correct"))).alias("baseline_accuracy"),
        )
        .where(F.col("total_predictions") > 0)
    )


def accuracy_triggers(
    accuracy: DataFrame,
    floor: float = ACCURACY_FLOOR,
    drop: float = ACCURACY_DROP,
    min_predictions: int = MIN_PREDICTIONS,
) -> DataFrame:
    """Symbols below the floor, or else well below their own baseline."""
    now, base = F.col("accuracy"), F.col("baseline_accuracy")
    reason = F.when(now < floor, "low_accuracy").when(
        (base != 0) & (base - now > drop), "accuracy_degradation"
    )
    judged = accuracy.where(F.col("total_predictions") >= min_predictions)
    return (
        judged.withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select(
            "symbol",
            "reason",
            now.alias("current_accuracy"),
            base.alias("baseline_accuracy"),
            (base - now).alias("degradation"),
        )
    )


def drift(
    features: DataFrame,
    as_of,
    cols: Mapping[str, str] = DRIFT_FEATURES,
    recent: str = "3 days",
    history: str = "30 days",
) -> DataFrame:
    """Shift of recent means in units of the historical deviation, per symbol."""
    at = F.col("timestamp")
    new = at >= before(as_of, recent)
    stats = []
    for out, c in cols.items():
        stats.append(F.avg(F.when(new, F.col(c))).alias(f"_now_{out}"))
        stats.append(F.avg(F.when(~new, F.col(c))).alias(f"_past_{out}"))
        stats.append(F.stddev_samp(F.when(~new, F.col(c))).alias(f"_spread_{out}"))
    both = (
        since(features, before(as_of, history))
        .groupBy("symbol")
        .agg(F.count_if(new).alias("_recent"), F.count_if(~new).alias("_history"), *stats)
        .where((F.col("_recent") > 0) & (F.col("_history") > 0))
    )
    return both.select(
        "symbol",
        *[
            (
                F.abs(F.col(f"_now_{out}") - F.col(f"_past_{out}"))
                / F.nullif(F.col(f"_spread_{out}"), F.lit(0.0))
            ).alias(out)
            for out in cols
        ],
    )


def drift_triggers(
    drifts: DataFrame,
    limit: float = DRIFT_LIMIT,
    cols: Mapping[str, str] = DRIFT_FEATURES,
) -> DataFrame:
    """Symbols whose largest known drift is above the limit."""
    largest = F.greatest(*[F.col(c) for c in cols])
    return (
        drifts.withColumn("max_drift", largest)
        .where(F.col("max_drift") > limit)
        .select("symbol", F.lit("data_drift").alias("reason"), "max_drift", *cols)
    )


def staleness(metrics: DataFrame, as_of, max_age_days: float = MAX_AGE_DAYS) -> DataFrame:
    """One row: time since the last training; no history counts as stale."""
    last = F.col("last_training")
    age = seconds_between(last, moment(as_of)) / F.lit(86400.0)
    return (
        metrics.agg(F.max("training_timestamp").alias("last_training"))
        .withColumn("days_since_training", age)
        .withColumn(
            "should_retrain",
            F.coalesce(F.col("days_since_training") >= max_age_days, F.lit(True)),
        )
    )


def decide(
    accuracy: DataFrame, drifted: DataFrame, age: DataFrame, as_of
) -> DataFrame:
    """One decision row from accuracy triggers, drift triggers and staleness.

    ``details`` is a JSON document that lists the triggers: at most one entry
    per symbol and check.
    """
    checks = (
        accuracy.select(F.lit("accuracy").alias("check"), "symbol",
                        F.struct("symbol", "reason", "current_accuracy", "baseline_accuracy",
                                 "degradation").alias("a"))
        .unionByName(
            drifted.select(F.lit("drift").alias("check"), "symbol",
                           F.struct("symbol", "reason", "max_drift", *DRIFT_FEATURES).alias("d")),
            allowMissingColumns=True,
        )
        .unionByName(
            age.select(F.lit("age").alias("check"),
                       F.struct("should_retrain", F.col("last_training").cast("string")
                                .alias("last_training"), "days_since_training").alias("s")),
            allowMissingColumns=True,
        )
    )
    one = checks.agg(
        F.array_sort(F.collect_list("a")).alias("_accuracy"),
        F.array_sort(F.collect_list("d")).alias("_drift"),
        F.first("s", ignorenulls=True).alias("_age"),
    )
    old = F.coalesce(F.col("_age.should_retrain"), F.lit(True))
    reasons = F.array_compact(
        F.array(
            F.when(F.size("_accuracy") > 0, F.lit("accuracy_degradation")),
            F.when(F.size("_drift") > 0, F.lit("data_drift")),
            F.when(old, F.lit("training_staleness")),
        )
    )
    found = one.withColumn("reasons", reasons)
    fires = F.size("reasons") > 0
    checked = lambda c: F.struct(
        (F.size(c) > 0).alias("should_retrain"), F.col(c).alias("triggers")
    )
    details = F.to_json(
        F.struct(
            fires.alias("should_retrain"),
            F.col("reasons"),
            checked("_accuracy").alias("accuracy_check"),
            checked("_drift").alias("drift_check"),
            F.col("_age").alias("staleness_check"),
            moment(as_of).cast("string").alias("decision_time"),
        )
    )
    return found.select(
        moment(as_of).alias("decision_time"),
        fires.alias("should_retrain"),
        "reasons",
        details.alias("details"),
        moment(as_of).alias("created_at"),
    )
