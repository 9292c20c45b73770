"""Stored models, the registry of runs, and scoring from node tables."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.trees import score_trees
from tidemark.plans import inference, registry, training
from tidemark.schema import DIRECTION_TARGET

COLS = ("x", "y", "z")
ARTIFACTS = {"random_forest": "rf", "gradient_boosting": "gb"}


@pytest.fixture(scope="module")
def rows(spark):
    """Three symbols of unlike sizes, one of them with a single class."""
    df = spark.range(900).select(
        F.when(F.col("id") % 9 < 6, "big").when(F.col("id") % 9 < 8, "mid").otherwise("one/class").alias("symbol"),
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("timestamp"),
        *[F.rand(i).alias(c) for i, c in enumerate(COLS)],
    )
    up = (F.col("x") + F.col("y") * F.col("z") > 0.8).cast("int")
    return df.withColumn(DIRECTION_TARGET, F.when(F.col("symbol") == "one/class", 0).otherwise(up)).cache()


@pytest.fixture(scope="module")
def fitted(spark, rows, tmp_path_factory):
    names = ["big", "mid", "one/class"]
    models = registry.Trained(
        rows.groupBy("symbol").agg(F.count("*").alias("means")),
        rows.groupBy("symbol").agg(F.avg("x").alias("intercept")),
        rows.groupBy("symbol").agg(F.avg("y").alias("intercept")),
        random_forest=training.fit_per_symbol(training.forest(trees=7, depth=6), rows, names, COLS),
        gradient_boosting=training.fit_per_symbol(training.boosting(rounds=5, depth=3), rows, names[:2], COLS),
    )
    _, models.nodes = registry.pack_trees(spark, models.trees(), str(tmp_path_factory.mktemp("trees")))
    return models


def by_time(df):
    return {r["timestamp"]: r for r in df.collect()}


@pytest.mark.parametrize("parts", [1, 5])
def test_node_tables_score_as_the_models_do(rows, fitted, parts):
    want = by_time(inference.score_clf({"rf": fitted.random_forest, "gb": fitted.gradient_boosting}, rows, COLS))
    got = by_time(score_trees(rows, fitted.nodes, ARTIFACTS, COLS, parts))
    assert got.keys() == want.keys() and len(got) == 900
    for key, row in got.items():
        for name in (c for p in ARTIFACTS.values() for c in (f"{p}_prediction", f"{p}_confidence", f"{p}_prob_up", f"{p}_prob_down")):
            assert (row[name] is None) == (want[key][name] is None), name
            assert row[name] is None or row[name] == pytest.approx(want[key][name], abs=1e-9), name
        assert (row["gb_prediction"] is None) == (row["symbol"] == "one/class")


def test_one_branch_for_all_symbols(rows, fitted):
    plan = score_trees(rows, fitted.nodes, ARTIFACTS, COLS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FlatMapCoGroups") == 1 and "Union" not in plan


def test_rows_without_models_or_inputs(spark, rows, fitted):
    odd = spark.createDataFrame(
        [("big", 1, None, 0.5, None), ("absent", 2, 0.1, 0.2, 0.3), (None, 3, 0.1, 0.2, 0.3)],
        "symbol string, n int, x double, y double, z double",
    )
    got = score_trees(odd, fitted.nodes, ARTIFACTS, COLS).collect()
    assert [r["n"] for r in got] == [1] and 0 <= got[0]["rf_prob_up"] <= 1
    assert score_trees(odd.where("n > 5"), fitted.nodes, ARTIFACTS, COLS).count() == 0


def test_runs_are_added_and_resolved_by_time(spark, rows, fitted, tmp_path):
    path = str(tmp_path)
    registry.save_models(fitted, path, "2024-01-01 00:00:00")
    newer = registry.Trained(
        fitted.scaler.where("symbol = 'big'"),
        fitted.ridge.where("symbol = 'big'").withColumn("intercept", F.lit(7.0)),
        fitted.logistic.where("symbol = 'big'"),
        random_forest={"big": fitted.random_forest["mid"]},
    )
    registry.save_models(newer, path, "2024-02-01 00:00:00")
    assert registry.load_registry(spark, path).select("run").distinct().count() == 2
    everything = ["big", "mid", "one/class"]

    def loaded(as_of):
        return registry.load_models(spark, path, everything, as_of, objects=True)

    old, now = loaded("2024-01-15"), loaded(None)
    intercepts = {r["symbol"]: r["intercept"] for r in now.ridge.collect()}
    assert intercepts["big"] == 7.0 and len(intercepts) == 3
    assert {r["symbol"]: r["intercept"] for r in old.ridge.collect()} == {
        r["symbol"]: r["intercept"] for r in fitted.ridge.collect()
    }
    assert old.random_forest.keys() == now.random_forest.keys() == set(everything)
    for models, big in ((old, fitted.random_forest["big"]), (now, fitted.random_forest["mid"])):
        own = rows.where("symbol = 'big'")
        want = by_time(inference.score_clf({"rf": {"big": big}}, own, COLS))
        for scored in (
            score_trees(own, models.nodes, ARTIFACTS, COLS),
            inference.score_clf({"rf": models.random_forest}, own, COLS),
        ):
            got = by_time(scored)
            assert all(got[k]["rf_prob_up"] == pytest.approx(want[k]["rf_prob_up"]) for k in want)
    # boosting was not fitted again, so the older run holds
    assert now.gradient_boosting.keys() == {"big", "mid"}
    # the same run once more changes nothing
    registry.save_models(newer, path, "2024-02-01 00:00:00")
    assert registry.load_registry(spark, path).groupBy("symbol", "artifact", "run").count().where("count > 1").isEmpty()
