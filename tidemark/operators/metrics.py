"""Model metrics: confusion and error rates, long and wide tables, best runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import before


def _rate(top: Column, bottom: Column) -> Column:
    """Quotient as a double; 0 where nothing was counted."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def clf_metrics(
    df: DataFrame, by: Sequence[str], label: str = "label", predicted: str = "prediction"
) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class per group."""
    yes, said = F.col(label) == 1, F.col(predicted) == 1
    counted = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col(label) == F.col(predicted)).alias("_hit"),
        F.count_if(yes & said).alias("_tp"),
        F.count_if(said).alias("_said"),
        F.count_if(yes).alias("_yes"),
    )
    tp = F.col("_tp")
    return counted.select(
        *by,
        _rate(F.col("_hit"), F.col("_n")).alias("accuracy"),
        _rate(tp, F.col("_said")).alias("precision"),
        _rate(tp, F.col("_yes")).alias("recall"),
        _rate(2 * tp, F.col("_said") + F.col("_yes")).alias("f1"),
    )


def reg_metrics(
    df: DataFrame, by: Sequence[str], label: str = "label", predicted: str = "prediction"
) -> DataFrame:
    """Mean squared and absolute error and R2 per group."""
    err = F.col(predicted) - F.col(label)
    sums = df.groupBy(*by).agg(
        F.avg(err * err).alias("mse"),
        F.avg(F.abs(err)).alias("mae"),
        F.var_pop(label).alias("_var"),
    )
    fit = F.lit(1.0) - F.col("mse") / F.nullif(F.col("_var"), F.lit(0.0))
    flat = F.when(F.col("mse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return sums.withColumn("r2", F.coalesce(fit, flat)).drop("_var")


def melt_metrics(wide: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per metric; nested columns are not listed and so left out."""
    long = wide.unpivot(list(ids), list(metrics), "metric_name", "metric_value")
    return long.where(F.col("metric_value").isNotNull())


def latest_run(metrics: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of each symbol's latest run; ``strict`` takes the latest run overall."""
    at = "training_timestamp"
    if strict:
        newest = metrics.agg(F.max(at)).scalar()
        return metrics.where(F.col(at) == newest)
    return metrics.join(metrics.groupBy("symbol").agg(F.max(at).alias(at)), ["symbol", at])


def best_model(metrics: DataFrame, names: Sequence[str] = ("accuracy", "r2")) -> DataFrame:
    """Best (symbol, model) per metric; ties go to the first by name."""
    rank = F.struct(-F.col("metric_value"), "symbol", "model_name")
    best = F.min_by(F.struct("symbol", "model_name", "metric_value"), rank).alias("_best")
    wanted = metrics.where(F.col("metric_name").isin(*names) & F.col("metric_value").isNotNull())
    return wanted.groupBy("metric_name").agg(best).select("metric_name", "_best.*")


def latest_metrics(metrics: DataFrame, as_of, window: str = "30 days") -> DataFrame:
    """Newest value per symbol, model and metric in the trailing window."""
    recent = metrics.where(F.col("training_timestamp") >= before(as_of, window))
    return recent.groupBy("symbol", "model_name", "metric_name").agg(
        F.max_by("metric_value", "training_timestamp").alias("metric_value"),
        F.max("training_timestamp").alias("training_timestamp"),
    )


def pivot_metrics(latest: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per symbol and model with a column per metric."""
    return (
        latest.groupBy("symbol", "model_name")
        .pivot("metric_name", list(names))
        .agg(F.avg("metric_value"))
    )


def training_history(
    metrics: DataFrame, n: int = 50, as_of=None, window: str = "30 days", strict: bool = False
) -> DataFrame:
    """The newest ``n`` metric rows, newest first; ``strict`` takes the oldest."""
    recent = metrics
    if as_of is not None:
        recent = metrics.where(F.col("training_timestamp") >= before(as_of, window))
    names = ["symbol", "model_name", "metric_name"]
    newest = [F.desc("training_timestamp"), *names]
    recent = recent.withColumn("training_date", F.to_date("training_timestamp"))
    if strict:
        oldest = [F.asc("training_timestamp"), *[F.desc(c) for c in names]]
        return recent.orderBy(*oldest).limit(n).orderBy(*newest)
    return recent.orderBy(*newest).limit(n)
