"""Latest features to predictions, signals and accuracy of past predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.asof import judged
from tidemark.operators.linear import predict_linear
from tidemark.operators.prepare import assemble
from tidemark.operators.skew import spread_join
from tidemark.schema import MODEL_INPUTS
from tidemark.session import before, moment
from tidemark.sources.scans import since

REQUIRED_ARTIFACTS = ("random_forest", "scaling_params")
SIGNAL_THRESHOLD = 0.6


def missing_models(
    symbols: DataFrame, registry: DataFrame, required: Sequence[str] = REQUIRED_ARTIFACTS
) -> DataFrame:
    """(symbol, artifact) pairs that inference needs and the registry lacks."""
    needed = symbols.select("symbol").distinct().withColumn(
        "artifact", F.explode(F.array(*[F.lit(a) for a in required]))
    )
    return needed.join(registry.select("symbol", "artifact"), ["symbol", "artifact"], "left_anti")


def latest_features(
    features: DataFrame,
    cols: Sequence[str] = MODEL_INPUTS,
    min_rows: int = 10,
    start=None,
) -> DataFrame:
    """Newest row of every symbol that has at least ``min_rows`` rows.

    With ``start`` only rows from then on are read and counted. Only one row per symbol and task is shuffled.
    """
    if start is not None:
        features = since(features, moment(start))
    newest = [F.max_by(c, "timestamp").alias(c) for c in ("close", *cols)]
    return (
        features.groupBy("symbol")
        .agg(F.max("timestamp").alias("timestamp"), *newest, F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= min_rows)
        .drop("_n")
    )


def fill(df: DataFrame, value: float = 0, cols: Sequence[str] = MODEL_INPUTS) -> DataFrame:
    """Missing model inputs become ``value``."""
    return df.fillna(value, list(cols))


def score_clf(
    classifiers: Mapping[str, Mapping[str, object]],
    scaled: DataFrame,
    cols: Sequence[str] = MODEL_INPUTS,
) -> DataFrame:
    """Class, confidence and probabilities from each symbol's own classifiers.

    ``classifiers`` maps a column prefix to the models by symbol; a symbol
    without one of them has NULL there. ``scaled`` is read once per symbol, so
    it is best a stored table, partitioned by symbol if large.
    """
    rows = assemble(scaled, cols)
    symbols = sorted({s for by_symbol in classifiers.values() for s in by_symbol})
    if not symbols:
        raise ValueError("no classifier to score with")
    parts = []
    for symbol in symbols:
        part = rows.where(F.col("symbol") == symbol)
        for prefix, by_symbol in classifiers.items():
            if symbol in by_symbol:
                part = by_symbol[symbol].transform(part)
                chosen, chances = "CAST(prediction AS INT)", F.col("probability")
                part = part.withColumn("_p", vector_to_array(chances))
            else:
                chosen = "CAST(NULL AS INT)"
                part = part.withColumn("_p", F.lit(None).cast("array<double>"))
            # a model that has seen one class only has no chance for the other
            found = {
                "prediction": chosen,
                "confidence": f"get(_p, {chosen})",
                "prob_up": "CASE WHEN _p IS NOT NULL THEN coalesce(get(_p, 1), 0D) END",
                "prob_down": "get(_p, 0)",
            }
            part = part.selectExpr(
                "*", *[f"{sql} AS {prefix}_{name}" for name, sql in found.items()]
            ).drop("rawPrediction", "probability", "prediction", "_p")
        parts.append(part.drop("features"))
    return reduce(DataFrame.unionByName, parts)


def score_reg(
    model: DataFrame, scaled: DataFrame, cols: Sequence[str] = MODEL_INPUTS, price: str = "close"
) -> DataFrame:
    """Predicted return and price from linear coefficients."""
    scored = predict_linear(scaled, model, cols, "predicted_return")
    return scored.withColumn(
        "predicted_price", F.col(price) * (F.lit(1.0) + F.col("predicted_return"))
    )


def _mean_known(cols: Sequence[str]) -> Column:
    known = F.array_compact(F.array(*[F.col(c).cast("double") for c in cols]))
    total = F.aggregate(known, F.lit(0.0), lambda a, x: a + x)
    return F.try_divide(total, F.size(known).cast("double"))


def ensemble(df: DataFrame, votes: Sequence[str], confidences: Sequence[str]) -> DataFrame:
    """Majority vote and mean confidence.

    The mean vote is rounded half to even, so an even split is down. A model
    without a confidence counts as 0.5.
    """
    total = sum((F.coalesce(F.col(c).cast("double"), F.lit(0.5)) for c in confidences), F.lit(0.0))
    return df.withColumns(
        {
            "ensemble_prediction": F.bround(_mean_known(votes), 0).cast("int"),
            "ensemble_confidence": total / F.lit(float(len(confidences))),
        }
    )


def signal_of(direction: Column, confidence: Column, threshold: float = SIGNAL_THRESHOLD) -> Column:
    sure = confidence > threshold
    return F.when(sure & (direction == 1), "BUY").when(sure, "SELL").otherwise("HOLD")


def signal(
    df: DataFrame,
    threshold: float = SIGNAL_THRESHOLD,
    direction: str = "ensemble_prediction",
    confidence: str = "ensemble_confidence",
) -> DataFrame:
    """BUY or SELL above the threshold, else HOLD."""
    return df.withColumn("signal", signal_of(F.col(direction), F.col(confidence), threshold))


def recent_accuracy(
    predictions: DataFrame,
    features: DataFrame,
    as_of,
    oldest: str = "90 minutes",
    newest: str = "30 minutes",
) -> DataFrame:
    """Predictions of about an hour ago against each symbol's latest price since."""
    at = F.col("prediction_timestamp")
    asked = since(predictions, before(as_of, oldest), time="prediction_timestamp")
    asked = asked.where(at <= before(as_of, newest))
    latest = (
        since(features, before(as_of, newest))
        .groupBy("symbol")
        .agg(F.max_by("close", "timestamp").alias("actual_price"))
    )
    met = spread_join(asked, latest, ["symbol"])
    return judged(met.withColumn("base_price", F.col("current_price")))


def accuracy_by(outcomes: DataFrame, *cols: str) -> DataFrame:
    """Accuracy and row count for each column by itself, in one pass."""
    sets = [[F.col(c)] for c in cols]
    grouped = outcomes.groupingSets(sets, *[F.col(c) for c in cols]).agg(
        F.avg("correct").alias("accuracy"), F.count(F.lit(1)).alias("predictions")
    )
    return grouped


def prediction_report(predictions: DataFrame) -> DataFrame:
    """Predicted change in price and percent, for each prediction."""
    change = F.col("predicted_price") - F.col("current_price")
    return predictions.withColumns(
        {
            "change": change,
            "change_pct": F.try_divide(change, F.col("current_price")) * 100.0,
        }
    )


def signal_counts(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        *[F.count_if(F.col("signal") == s).alias(s.lower()) for s in ("BUY", "SELL", "HOLD")]
    )
