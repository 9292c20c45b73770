"""Comparing two models on split traffic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.asof import nearest_outcome
from tidemark.operators.trees import score_trees
from tidemark.schema import MODEL_INPUTS
from tidemark.session import before, moment

# The test that runs when none is configured.
DEFAULT_TEST = {
    "test_name": "rf_vs_gb_v1",
    "model_a_name": "random_forest",
    "model_b_name": "gradient_boosting",
    "traffic_split": 0.5,
}


def active_test(config: DataFrame, default: Mapping[str, object] = DEFAULT_TEST) -> DataFrame:
    """One row: the newest active test, or the default if none is active."""
    cols = list(DEFAULT_TEST)
    active = config.where(F.col("status") == "active")
    newest = active.agg(F.max_by(F.struct(*cols), F.struct("created_at", "test_name")).alias("_t"))
    return newest.select(
        *[F.coalesce(F.col(f"_t.{c}"), F.lit(default[c])).alias(c) for c in cols]
    ).withColumn("traffic_split", F.col("traffic_split").cast("double"))


def draw(test, symbol, time):
    """Uniform number in [0, 1) that depends only on test, symbol and time."""
    seconds = F.unix_timestamp(time.cast("timestamp")).cast("string")
    digest = F.md5(F.concat_ws("|", test, symbol, seconds))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def assign_variant(df: DataFrame, test: DataFrame, time: str = "prediction_timestamp") -> DataFrame:
    """Add the test's name and variant A or B; ``test`` is one row."""
    # the one-row test is read as a scalar subquery, so nothing is joined
    one = test.select(F.struct(*DEFAULT_TEST).alias("t")).scalar()
    taken = draw(one["test_name"], F.col("symbol"), F.col(time)) < one["traffic_split"]
    return df.withColumns(
        {
            "test_name": one["test_name"],
            "model_version": F.when(taken, "A").otherwise("B"),
            "model_name": F.when(taken, one["model_a_name"]).otherwise(one["model_b_name"]),
        }
    )


def ab_score(
    scaled: DataFrame,
    nodes: DataFrame,
    artifacts: Sequence[str] = ("random_forest", "gradient_boosting"),
    cols: Sequence[str] = MODEL_INPUTS,
) -> DataFrame:
    """Score each row with the packed classifier its ``model_name`` names.

    Rows that name another model, or one that their symbol lacks, are left out.
    """
    places = {name: f"_ab{i}" for i, name in enumerate(artifacts)}
    scored = score_trees(scaled, nodes, places, cols)

    def named(what: str):
        return F.coalesce(
            *[F.when(F.col("model_name") == n, F.col(f"{p}_{what}")) for n, p in places.items()]
        )

    scored = scored.withColumns(
        {"predicted_direction": named("prediction"), "confidence": named("confidence")}
    )
    return scored.where(F.col("predicted_direction").isNotNull()).select(
        *scaled.columns, "predicted_direction", "confidence"
    )


def ab_outcomes(results: DataFrame, prices: DataFrame, test_name, as_of) -> DataFrame:
    """A test's recent predictions with what happened an hour later."""
    own = results.where(F.col("test_name") == test_name)
    return nearest_outcome(own, prices, base="feature", start=before(as_of, "7 days"))


def ab_metrics(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("model_version").agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.avg("correct").alias("accuracy"),
        F.avg("confidence").alias("avg_confidence"),
        F.sum("correct").alias("correct_predictions"),
    )


def ab_winner(metrics: DataFrame, tie: float = 0.02, clear: float = 0.05) -> DataFrame:
    """One row: winner and how sure; a variant without outcomes has accuracy 0."""

    def accuracy(version):
        found = F.max(F.when(F.col("model_version") == version, F.col("accuracy")))
        return F.coalesce(found, F.lit(0.0)).cast("double")

    both = metrics.agg(
        accuracy("A").alias("accuracy_a"),
        accuracy("B").alias("accuracy_b"),
        F.count(F.lit(1)).alias("_variants"),
    )
    winner, sure = verdict(F.col("accuracy_a"), F.col("accuracy_b"), tie, clear)
    some = F.col("_variants") > 0
    return both.select(
        "accuracy_a",
        "accuracy_b",
        F.when(some, winner).alias("winner"),
        F.when(some, sure).alias("confidence"),
    )


def verdict(a: Column, b: Column, tie: float = 0.02, clear: float = 0.05) -> tuple[Column, Column]:
    """Winner and confidence from two accuracies."""
    gap = a - b
    even = F.abs(gap) < tie
    winner = F.when(even, "tie").when(gap > 0, "A").otherwise("B")
    return winner, F.when(even, "low").when(F.abs(gap) > clear, "high").otherwise("medium")


def ab_by_symbol(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("symbol", "model_version").agg(
        F.count(F.lit(1)).alias("predictions"), F.avg("correct").alias("accuracy")
    )


def ab_report(test: DataFrame, outcomes: DataFrame, as_of) -> DataFrame:
    """One nested row: winner, metrics per variant and per symbol.

    Outcomes are reduced to one row per symbol and variant before anything is
    gathered, so the report grows with the symbols, not with the predictions.
    """
    cells = outcomes.groupBy("symbol", "model_version").agg(
        F.count(F.lit(1)).alias("predictions"),
        F.sum("correct").alias("correct"),
        F.sum("confidence").alias("_confidence"),
    )
    cells = cells.withColumn("accuracy", F.col("correct") / F.col("predictions"))
    entry = F.struct("symbol", "model_version", "predictions", "accuracy")

    def variant(version):
        mine = F.col("model_version") == version
        n = F.sum(F.when(mine, F.col("predictions")))
        hits = F.sum(F.when(mine, F.col("correct")))
        return F.when(
            n > 0,
            F.struct(
                (hits / n).alias("accuracy"),
                n.alias("predictions"),
                (F.sum(F.when(mine, F.col("_confidence"))) / n).alias("avg_confidence"),
                hits.alias("correct"),
            ),
        )

    body = cells.agg(
        variant("A").alias("model_a_metrics"),
        variant("B").alias("model_b_metrics"),
        F.array_sort(F.collect_list(entry)).alias("per_symbol"),
    )
    a, b = (
        F.coalesce(F.col(f"model_{v}_metrics.accuracy"), F.lit(0.0)) for v in ("a", "b")
    )
    winner, sure = verdict(a, b)
    some = F.size("per_symbol") > 0
    named = test.select(F.struct("test_name", "model_a_name", "model_b_name")).scalar()
    return body.select(
        named["test_name"].alias("test_name"),
        named["model_a_name"].alias("model_a"),
        named["model_b_name"].alias("model_b"),
        "model_a_metrics",
        "model_b_metrics",
        F.when(some, winner).alias("winner"),
        F.when(some, sure).alias("confidence"),
        moment(as_of).alias("evaluation_time"),
        "per_symbol",
    )
