"""Trees grown for all symbols together, against brute force and single fits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import growing
from tidemark.operators.trees import score_trees
from tidemark.plans import inference, registry, training
from tidemark.schema import DIRECTION_TARGET

COLS = ("x", "y", "z", "w")
ARTIFACTS = {"random_forest": "rf", "gradient_boosting": "gb"}


@pytest.fixture(scope="module")
def rows(spark):
    """A symbol with most rows, a small one, and one with a single class."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("one/class").alias("symbol"),
        "id",
        *[F.round(F.rand(i), 3).alias(c) for i, c in enumerate(COLS)],
    )
    up = (F.col("x") + F.col("y") * F.col("z") + 0.3 * F.rand(9) > 0.9).cast("int")
    return df.withColumn(DIRECTION_TARGET, F.when(F.col("symbol") == "one/class", 0).otherwise(up)).cache()


@pytest.fixture(scope="module")
def grown(rows, tmp_path_factory):
    table = str(tmp_path_factory.mktemp("grown"))
    fitting = rows.where("id % 3 != 0").withColumn("part", F.lit("own")).withColumn("n", F.lit(1))
    binned = growing.bin_rows(fitting, f"{table}/binned", COLS, block_rows=500)
    forest = growing.grow_forest(binned, f"{table}/forest", trees=12, depth=6)
    boosting = growing.grow_boosting(binned, f"{table}/boosting", rounds=6, depth=3)
    packed = growing.pack_grown(forest, binned, "random_forest").unionByName(
        growing.pack_grown(boosting, binned, "gradient_boosting", margins=True)
    )
    packed.write.parquet(f"{table}/packed")
    return binned, forest, boosting, rows.sparkSession.read.parquet(f"{table}/packed")


def accuracy(scored, name):
    told = F.avg((F.col(f"{name}_prediction") == F.col(DIRECTION_TARGET)).cast("double"))
    return {r[0]: r[1] for r in scored.groupBy("symbol").agg(told).collect()}


def test_blocks_hold_every_row_once(grown):
    binned = grown[0]
    blocks = binned.blocks.select("symbol", (F.length("keys") / 8).alias("n"), (F.length("bins") / 4).alias("m")).collect()
    sizes = {}
    for b in blocks:
        assert b["n"] == b["m"]
        sizes[b["symbol"]] = sizes.get(b["symbol"], 0) + b["n"]
    assert sum(sizes.values()) == 4000 and sizes["big"] > sizes["mid"] and len(blocks) > 5


def test_as_accurate_as_single_fits(rows, grown):
    fitting, held = rows.where("id % 3 != 0"), rows.where("id % 3 = 0")
    names = ["big", "mid"]
    single = {
        "rf": training.fit_per_symbol(training.forest(trees=12, depth=6), fitting, names, COLS),
        "gb": training.fit_per_symbol(training.boosting(rounds=6, depth=3), fitting, names, COLS),
    }
    want = inference.score_clf(single, held.where("symbol != 'one/class'"), COLS)
    got = score_trees(held, grown[3], ARTIFACTS, COLS)
    for name in ("rf", "gb"):
        one, all_ = accuracy(want, name), accuracy(got, name)
        assert all_["one/class"] == 1.0
        assert all(all_[s] > 0.8 and abs(all_[s] - one[s]) <= 0.04 for s in names), (one, all_)


def test_nodes_share_out_their_parents_rows(grown):
    for nodes in grown[1:3]:
        below = growing.leaf_values(nodes)
        again = nodes.alias("a").join(below.alias("b"), ["symbol", "tree", "node"])
        assert again.where("abs(a.n - b.n) > 1e-6 OR abs(a.s - b.s) > 1e-6").isEmpty()
        assert again.count() == nodes.count()
        assert nodes.where("feature >= 0 AND (gain <= 0 OR n_left <= 0 OR n_left >= n)").isEmpty()
    roots = {r["symbol"]: r["n"] for r in grown[2].where("node = 1 AND tree = 0").collect()}
    assert roots == {"big": 2800, "mid": 800, "one/class": 400}
    assert grown[1].where("symbol = 'one/class' AND feature >= 0").isEmpty()


def test_first_boosting_cut_by_brute_force(rows, grown):
    own = rows.where("id % 3 != 0 AND symbol = 'mid'").toPandas()
    y = 2 * own[DIRECTION_TARGET].to_numpy() - 1.0
    cuts = next(r["cuts"] for r in grown[0].cuts.collect() if r["symbol"] == "mid")
    best = max(
        (
            (y[left].sum() ** 2 / left.sum() + y[~left].sum() ** 2 / (~left).sum() - y.sum() ** 2 / len(y), -i, -b)
            for i, c in enumerate(COLS)
            for b, cut in enumerate(np.unique(cuts[i]))
            if 0 < (left := own[c].to_numpy() <= cut).sum() < len(y)
        )
    )
    root = grown[2].where("symbol = 'mid' AND tree = 0 AND node = 1").first()
    assert (root["feature"], root["bin"]) == (-best[1], -best[2])
    assert root["gain"] == pytest.approx(best[0])


def test_margins_are_those_that_scoring_finds(spark, rows, grown, tmp_path):
    """Targets stored with the blocks are the slopes at the scored margins."""
    binned, _, boosting, _ = grown
    first = boosting.where("tree = 0")
    moved = growing._advance(binned.blocks, first, 0, 3, 1.0, len(COLS))
    total = sum(np.frombuffer(r["margin"]).sum() for r in moved.select("margin").collect())
    packed = growing.pack_grown(first, binned, "gradient_boosting", margins=True)
    scored = score_trees(rows.where("id % 3 != 0"), packed, {"gradient_boosting": "gb"}, COLS)
    chance = F.sum(0.5 * F.log(F.col("gb_prob_up") / (1 - F.col("gb_prob_up"))))
    assert scored.agg(chance).first()[0] == pytest.approx(total)


def test_importance(grown):
    found = growing.grown_importance(grown[1], COLS).collect()
    by_symbol = {}
    for r in found:
        by_symbol.setdefault(r["symbol"], {})[r["feature"]] = r["importance"]
    assert all(len(v) == len(COLS) for v in by_symbol.values())
    assert sum(by_symbol["big"].values()) == pytest.approx(1)
    assert max(by_symbol["big"], key=by_symbol["big"].get) == "x"
    assert set(by_symbol["one/class"].values()) == {0.0}


def test_nulls_and_empty_tables(spark, tmp_path):
    schema = f"symbol string, x double, y double, z double, w double, {DIRECTION_TARGET} int"
    odd = [("a", None, float("nan"), 1.0, float("inf"), i % 2) for i in range(8)]
    odd += [("a", 0.1 * i, 1.0, 1.0, None, 1) for i in range(8)]
    odd += [(None, 1.0, 1.0, 1.0, 1.0, 1), ("a", 1.0, 1.0, 1.0, 1.0, None)]
    frame = spark.createDataFrame(odd, schema)
    packed, trees, _ = training.grow_together(
        frame, str(tmp_path / "odd"), {"trees": 3, "depth": 2, "min_rows": 1}, {"rounds": 2, "depth": 2}, COLS
    )
    scored = score_trees(frame.where("symbol = 'a'"), packed, ARTIFACTS, COLS).collect()
    assert len(scored) == 17 and all(0 <= r["rf_prob_up"] <= 1 and 0 < r["gb_prob_up"] < 1 for r in scored)
    none, _, _ = training.grow_together(
        frame.where("x > 99"), str(tmp_path / "none"), {"trees": 2, "depth": 2}, {"rounds": 2, "depth": 2}, COLS
    )
    assert none.count() == 0


def test_grown_runs_are_stored_and_loaded(spark, rows, grown, tmp_path):
    table = rows.groupBy("symbol").agg(F.avg("x").alias("intercept"))
    models = registry.Trained(table, table, table, nodes=grown[3])
    registry.save_models(models, str(tmp_path), "2024-01-01 00:00:00")
    loaded = registry.load_models(spark, str(tmp_path), ["big", "mid"], objects=True)
    assert not loaded.random_forest and loaded.nodes.count() == 4
    held = rows.where("id % 3 = 0 AND symbol = 'mid'")
    one, other = (score_trees(held, n, ARTIFACTS, COLS).orderBy("id").collect() for n in (grown[3], loaded.nodes))
    assert one == other
