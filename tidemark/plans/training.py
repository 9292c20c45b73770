"""Training all models of all symbols."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.growing import bin_rows, grow_boosting, grow_forest, pack_grown
from tidemark.operators.linear import fit_logistic, fit_ridge, predict_linear, predict_logistic
from tidemark.operators.metrics import clf_metrics, melt_metrics, reg_metrics
from tidemark.operators.prepare import (
    apply_scaler,
    assemble,
    fit_scaler,
    impute_median,
    time_split,
)
from tidemark.operators.trees import score_trees
from tidemark.plans.registry import Trained, pack_trees
from tidemark.schema import DIRECTION_TARGET, MODEL_INPUTS, RETURN_TARGET
from tidemark.session import moment
from tidemark.sources.scans import scan_training

CLF_METRICS = ("accuracy", "precision", "recall", "f1")
REG_METRICS = ("mse", "mae", "r2")
#: Tasks that a symbol's validation rows are dealt to for scoring.
SCORE_PARTS = 4


def prepare_training(
    features: DataFrame, as_of, table: str, min_rows: int = 100, impute_scope: str = "all"
) -> tuple[DataFrame, DataFrame]:
    """Imputed, split and standardised rows, and the scaling parameters.

    Symbols with fewer than ``min_rows`` labelled rows are left out. Medians and
    scaling each need passes of their own over the rows before them, so the
    split rows, the filled rows and the parameters are written below ``table``
    and read from there: the features are read twice, whatever follows.
    """
    if impute_scope not in ("all", "train"):
        raise ValueError("impute_scope is 'all' or 'train'")
    spark = features.sparkSession

    def stored(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{table}/{name}")
        return spark.read.schema(df.schema).parquet(f"{table}/{name}")

    parts = stored("split", time_split(scan_training(features, as_of), min_rows=min_rows))
    fit_on = parts.where(F.col("split") == "train") if impute_scope == "train" else None
    filled = stored("filled", impute_median(parts, MODEL_INPUTS, fit_on=fit_on, all_missing=0.0))
    scaler = stored("scaler", fit_scaler(filled.where(F.col("split") == "train")))
    return apply_scaler(filled, scaler), scaler


def forest(trees: int = 100, depth: int = 10, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=5, seed=seed,
        labelCol=DIRECTION_TARGET,
    )


def boosting(
    rounds: int = 100, depth: int = 5, rate: float = 0.1, seed: int = 42
) -> GBTClassifier:
    return GBTClassifier(
        maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, labelCol=DIRECTION_TARGET
    )


def fit_symbols(train: DataFrame, symbols: Sequence[str]) -> list[str]:
    """Those of ``symbols`` that the prepared rows hold, in the given order.

    Preparation leaves out symbols with too few rows.
    """
    present = {row["symbol"] for row in train.select("symbol").distinct().collect()}
    return [s for s in symbols if s in present]


def fit_per_symbol(
    estimator,
    train: DataFrame,
    symbols: Sequence[str],
    cols: Sequence[str] = MODEL_INPUTS,
    parallelism: int = 4,
) -> dict[str, object]:
    """One tree model per symbol; every fit is a distributed job of its own.

    A few fits run side by side; symbols without prepared rows are skipped.
    ``train`` is best a stored table partitioned by
    symbol, so that each fit reads its own files.
    """
    rows = assemble(train, cols)

    def fit(symbol):
        return symbol, estimator.fit(rows.where(F.col("symbol") == symbol))

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        run = inheritable_thread_target(train.sparkSession)
        return dict(pool.map(run(fit), fit_symbols(train, symbols)))


def fit_forest(train: DataFrame, symbols: Sequence[str], **settings) -> dict[str, object]:
    return fit_per_symbol(forest(**settings), train, symbols)


def fit_boosting(train: DataFrame, symbols: Sequence[str], **settings) -> dict[str, object]:
    return fit_per_symbol(boosting(**settings), train, symbols)


def grow_together(
    train: DataFrame,
    table: str,
    forest_settings: Mapping[str, object] | None = None,
    boosting_settings: Mapping[str, object] | None = None,
    cols: Sequence[str] = MODEL_INPUTS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Forests and boosting of all symbols in jobs that do not grow with the symbols.

    Returns the packed ensembles for scoring and the nodes of either kind, all
    stored below ``table``. Settings are those of ``growing.grow_forest`` and
    ``growing.grow_boosting``.
    """
    binned = bin_rows(train, f"{table}/binned", cols)
    trees = grow_forest(binned, f"{table}/random_forest", **(forest_settings or {}))
    rounds = grow_boosting(binned, f"{table}/gradient_boosting", **(boosting_settings or {}))
    rate = (boosting_settings or {}).get("rate", 0.1)
    packed = pack_grown(trees, binned, "random_forest").unionByName(
        pack_grown(rounds, binned, "gradient_boosting", margins=True, rate=rate)
    )
    packed.write.mode("overwrite").parquet(f"{table}/packed")
    return train.sparkSession.read.parquet(f"{table}/packed"), trees, rounds


def importance(
    models: Mapping[str, object], spark: SparkSession, cols: Sequence[str] = MODEL_INPUTS
) -> DataFrame:
    """Feature importance per symbol and column of tree models."""
    rows = [
        (symbol, name, float(model.featureImportances[i]))
        for symbol, model in models.items()
        for i, name in enumerate(cols)
    ]
    return spark.createDataFrame(rows, "symbol string, feature string, importance double")


def train(
    features: DataFrame,
    as_of,
    symbols: Sequence[str],
    table: str,
    forest_settings: Mapping[str, object] | None = None,
    boosting_settings: Mapping[str, object] | None = None,
    together: bool = False,
) -> tuple[Trained, DataFrame]:
    """Fit the four models of each symbol; returns them and validation metrics.

    The prepared rows are written to ``table`` once, partitioned by symbol, and
    every fit reads that table. With ``together`` the trees of all symbols are
    grown in the same jobs, which suits many symbols; else each symbol's ensembles
    are fitted by jobs of their own and kept as model objects too.
    """
    spark = features.sparkSession
    rows, scaler = prepare_training(features, as_of, table)
    rows.write.mode("overwrite").partitionBy("symbol").parquet(f"{table}/rows")
    rows = spark.read.schema(rows.schema).parquet(f"{table}/rows")
    fitting = rows.where(F.col("split") == "train")
    ridge = fit_ridge(fitting)
    ridge.write.mode("overwrite").parquet(f"{table}/ridge")
    fit_logistic(fitting).write.mode("overwrite").parquet(f"{table}/logistic")
    models = Trained(
        scaler,
        spark.read.parquet(f"{table}/ridge"),
        spark.read.parquet(f"{table}/logistic"),
    )
    if together:
        mine = fitting.where(F.col("symbol").isin(*symbols))
        models.nodes, _, _ = grow_together(mine, f"{table}/grown", forest_settings, boosting_settings)
    else:
        models.random_forest = fit_forest(fitting, symbols, **(forest_settings or {}))
        models.gradient_boosting = fit_boosting(fitting, symbols, **(boosting_settings or {}))
    trees = {name: by_symbol for name, by_symbol in models.trees().items() if by_symbol}
    if trees:
        _, models.nodes = pack_trees(spark, trees, f"{table}/trees")
    return models, validation_metrics(models, rows.where(F.col("split") == "validation"), as_of)


def validation_metrics(models: Trained, rows: DataFrame, as_of) -> DataFrame:
    """Long table of metrics per symbol and model."""
    found = []

    def add(name: str, measured: DataFrame, metrics: Sequence[str]) -> None:
        named = measured.withColumn("model_name", F.lit(name))
        found.append(melt_metrics(named, ["symbol", "model_name"], metrics))

    scored = predict_logistic(rows, models.logistic)
    measured = clf_metrics(scored, ["symbol"], DIRECTION_TARGET)
    add("logistic_regression", measured, CLF_METRICS)
    if models.nodes is not None:
        scored = score_trees(rows, models.nodes, {name: name for name in models.trees()}, parts=SCORE_PARTS)
        for name in models.trees():
            own = scored.where(F.col(f"{name}_prediction").isNotNull())
            measured = clf_metrics(own, ["symbol"], DIRECTION_TARGET, f"{name}_prediction")
            add(name, measured, CLF_METRICS)
    scored = predict_linear(rows, models.ridge)
    add("ridge_regression", reg_metrics(scored, ["symbol"], RETURN_TARGET), REG_METRICS)
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.withColumn("training_timestamp", moment(as_of))
