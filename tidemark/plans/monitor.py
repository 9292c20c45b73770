"""Rollups behind the monitoring report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.asof import nearest_outcome
from tidemark.operators.quality import status
from tidemark.session import before, moment

# Right-closed confidence buckets.
CONFIDENCE_BUCKETS = ((0.55, "50-55%"), (0.6, "55-60%"), (0.65, "60-65%"), (1.0, "65%+"))


def outcomes(predictions: DataFrame, prices: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Recent predictions against the recorded price, an hour later."""
    start = before(as_of, f"{days} days")
    return nearest_outcome(predictions, prices, base="recorded", start=start)


def accuracy_rollup(found: DataFrame) -> DataFrame:
    """Accuracy and count overall, per symbol and per signal, in one pass."""
    keys = [F.col("symbol"), F.col("signal")]
    rolled = found.groupingSets([[], [keys[0]], [keys[1]]], *keys).agg(
        F.grouping_id().alias("_set"),
        F.avg("correct").alias("accuracy"),
        F.count(F.lit(1)).alias("predictions"),
    )
    level = F.when(F.col("_set") == 3, "overall").when(F.col("_set") == 1, "symbol")
    return rolled.select(
        level.otherwise("signal").alias("level"),
        F.coalesce("symbol", "signal", F.lit("all")).alias("name"),
        "accuracy",
        "predictions",
    )


def confidence_bucket(value: Column) -> Column:
    """Bucket name; values outside (0, 1] have none."""
    chain = F.when(value <= 0, None)
    for top, name in CONFIDENCE_BUCKETS:
        chain = chain.when(value <= top, name)
    return chain


def accuracy_by_confidence(found: DataFrame) -> DataFrame:
    bucketed = found.withColumn("confidence_bucket", confidence_bucket(F.col("confidence")))
    return (
        bucketed.where(F.col("confidence_bucket").isNotNull())
        .groupBy("confidence_bucket")
        .agg(F.avg("correct").alias("accuracy"))
    )


def ab_panel(report: DataFrame) -> DataFrame:
    """Accuracy of both variants of a report, one row each."""
    unknown = F.lit("N/A")
    rows = F.array(
        *[
            F.struct(
                F.lit(v.upper()).alias("model_version"),
                F.coalesce(F.col(f"model_{v}_metrics.accuracy"), F.lit(0.0)).alias("metric_value"),
            )
            for v in ("a", "b")
        ]
    )
    return report.select(
        F.coalesce("model_a", unknown).alias("model_a"),
        F.coalesce("model_b", unknown).alias("model_b"),
        F.lit("accuracy").alias("metric_name"),
        F.inline(rows),
    )


def recent_decisions(
    decisions: DataFrame, as_of, n: int = 20, window: str = "30 days"
) -> DataFrame:
    """The newest decisions, newest first."""
    return (
        decisions.where(F.col("created_at") >= before(as_of, window))
        .select(F.col("should_retrain").alias("decision"), "details", "created_at")
        .orderBy(F.desc("created_at"), F.desc("details"))
        .limit(n)
    )


_DETAILS = (
    "reasons ARRAY<STRING>, "
    "accuracy_check STRUCT<triggers: ARRAY<STRUCT<symbol: STRING>>>, "
    "drift_check STRUCT<triggers: ARRAY<STRUCT<symbol: STRING>>>, "
    "staleness_check STRUCT<days_since_training: DOUBLE>"
)


def decision_summary(decisions: DataFrame) -> DataFrame:
    """Add ``summary``: one readable line from the detail document."""
    doc = F.from_json("details", _DETAILS)

    def names(check):
        found = F.transform(f"_d.{check}.triggers", lambda t: F.coalesce(t["symbol"], F.lit("")))
        return F.when(F.size(found) > 0, F.concat_ws(", ", found))

    def told(reason, text):
        return F.when(F.array_contains("_d.reasons", reason), text)

    days = F.coalesce(F.col("_d.staleness_check.days_since_training"), F.lit(0.0))
    parts = F.concat_ws(
        "; ",
        told("data_drift", F.concat(F.lit("Data Drift: "), names("drift_check"))),
        told(
            "accuracy_degradation",
            F.concat(F.lit("Accuracy Degradation: "), names("accuracy_check")),
        ),
        told(
            "training_staleness",
            F.concat(F.lit("Staleness: "), F.format_string("%.1f", days), F.lit(" days")),
        ),
    )
    readable = F.col("_d.reasons").isNotNull()
    text = F.when(~readable, "Invalid details format").when(parts == "", "No issues")
    return (
        decisions.withColumn("_d", doc)
        .withColumn("summary", text.otherwise(parts))
        .drop("_d")
    )


def accuracy_status(rolled: DataFrame) -> DataFrame:
    return rolled.withColumn("status", status(F.col("accuracy"), 0.55, 0.50))


def completeness_status(complete: DataFrame) -> DataFrame:
    return complete.withColumn("status", status(F.col("completeness_pct"), 95.0, 90.0))


def key_figures(rolled: DataFrame, fresh: DataFrame, counts: DataFrame) -> DataFrame:
    """One row with the headline numbers and their bands.

    The parts have one row each and are read as scalar subqueries.
    """
    overall = rolled.where(F.col("level") == "overall")
    first = fresh.where(F.col("table_name") == "ohlcv_data")

    known = overall.select(F.struct("accuracy", "predictions")).scalar()
    figures = counts.select(
        F.coalesce(known["accuracy"], F.lit(0.0)).alias("overall_accuracy"),
        F.coalesce(known["predictions"], F.lit(0)).alias("total_predictions"),
        first.select("minutes_old").scalar().alias("minutes_old"),
        F.col("predictions_count"),
        F.col("features_count"),
    )
    accuracy_band = F.when(F.col("overall_accuracy") > 0.55, "good").otherwise("warning")
    age = F.coalesce(F.col("minutes_old"), F.lit(999.0))
    return figures.withColumns(
        {
            "accuracy_status": accuracy_band,
            "freshness_status": F.when(age < 120, "good").otherwise("warning"),
        }
    )


def monitoring_rows(rolled: DataFrame, fresh: DataFrame, as_of) -> DataFrame:
    """Overall accuracy and data age in long format with their detail documents.

    The accuracy document lists the rollup, which has one entry per symbol and
    signal.
    """
    entry = F.struct("level", "name", "accuracy", "predictions")
    overall = F.max(F.when(F.col("level") == "overall", F.col("accuracy")))
    accuracy = rolled.agg(
        F.coalesce(overall, F.lit(0.0)).alias("metric_value"),
        F.to_json(F.array_sort(F.collect_list(entry))).alias("metadata"),
    ).select(
        F.lit("accuracy").alias("metric_type"),
        F.lit("overall_accuracy").alias("metric_name"),
        "metric_value",
        "metadata",
    )
    table = F.struct(
        "table_name", F.col("last_update").cast("string").alias("last_update"), "minutes_old"
    )
    first = F.max(F.when(F.col("table_name") == "ohlcv_data", F.col("minutes_old")))
    quality = fresh.agg(
        F.coalesce(first, F.lit(0.0)).alias("metric_value"),
        F.to_json(F.array_sort(F.collect_list(table))).alias("metadata"),
    ).select(
        F.lit("data_quality").alias("metric_type"),
        F.lit("freshness_minutes").alias("metric_name"),
        "metric_value",
        "metadata",
    )
    both = accuracy.unionByName(quality)
    return both.select(moment(as_of).alias("timestamp"), *both.columns)
