"""A registry of fitted models: runs are added, none is overwritten.

A run's tables, packed tree ensembles and saved models lie in folders named after
it; its registry rows are written last, so a run is found whole or not at all.
What holds at a time is the newest run of each (symbol, artifact) up to then.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.trees import pack_saved
from tidemark.session import moment

LOADERS: dict[str, Callable] = {
    "random_forest": RandomForestClassificationModel.load,
    "gradient_boosting": GBTClassificationModel.load,
}
MARGINS = ("gradient_boosting",)
TABLES = {
    "scaling_params": "scaler",
    "ridge_regression": "ridge",
    "logistic_regression": "logistic",
}


@dataclass
class Trained:
    """Fitted models: tables for the linear ones; trees packed by symbol for scoring,
    and as objects where they were fitted or loaded."""

    scaler: DataFrame
    ridge: DataFrame
    logistic: DataFrame
    nodes: DataFrame | None = None
    random_forest: dict[str, object] = field(default_factory=dict)
    gradient_boosting: dict[str, object] = field(default_factory=dict)

    def trees(self) -> dict[str, dict[str, object]]:
        return {
            "random_forest": self.random_forest,
            "gradient_boosting": self.gradient_boosting,
        }


def save_trees(
    spark: SparkSession, trees: Mapping[str, Mapping[str, object]], folder: str, parallelism: int = 4
) -> DataFrame:
    """Save each model in a numbered folder; returns symbol, artifact, margins, folder."""
    models = [(s, a, m) for a, by_symbol in sorted(trees.items()) for s, m in sorted(by_symbol.items())]

    def save(numbered):
        number, (_, _, model) = numbered
        model.write().overwrite().save(f"{folder}/{number}")

    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        list(pool.map(inheritable_thread_target(spark)(save), enumerate(models)))
    rows = [(s, a, a in MARGINS, f"{folder}/{i}") for i, (s, a, _) in enumerate(models)]
    return spark.createDataFrame(rows, "symbol string, artifact string, margins boolean, folder string")


def pack_trees(
    spark: SparkSession, trees: Mapping[str, Mapping[str, object]], folder: str
) -> tuple[DataFrame, DataFrame]:
    """Saved entries and stored packed rows of tree models, both below ``folder``."""
    entries = save_trees(spark, trees, f"{folder}/saved")
    pack_saved(spark, entries).write.mode("overwrite").parquet(f"{folder}/packed")
    return entries, spark.read.parquet(f"{folder}/packed")


def _folder(run) -> str:
    return f"of={datetime.fromisoformat(str(run)):%Y%m%d-%H%M%S-%f}"


def save_models(models: Trained, path: str, run) -> None:
    """Add the models as the run of that time; a run saved again replaces itself."""
    spark, of = models.scaler.sparkSession, _folder(run)
    entries = []
    for artifact, name in TABLES.items():
        getattr(models, name).write.mode("overwrite").parquet(f"{path}/{artifact}/{of}")
        kept = spark.read.parquet(f"{path}/{artifact}/{of}")
        entries.append(kept.select("symbol", F.lit(artifact).alias("artifact"), F.lit(None).cast("string").alias("folder")))
    trees = {name: by_symbol for name, by_symbol in models.trees().items() if by_symbol}
    if trees:
        saved, _ = pack_trees(spark, trees, f"{path}/trees/{of}")
        entries.append(saved.select("symbol", "artifact", "folder"))
    elif models.nodes is not None:  # grown as tables, so there are no objects to save
        models.nodes.write.mode("overwrite").parquet(f"{path}/trees/{of}/packed")
        kept = spark.read.parquet(f"{path}/trees/{of}/packed")
        entries.append(kept.select("symbol", "artifact", F.lit(None).cast("string").alias("folder")))
    registry = entries[0]
    for part in entries[1:]:
        registry = registry.unionByName(part)
    registry = registry.select(
        "symbol", "artifact", moment(run).alias("run"), "folder", F.lit(of.removeprefix("of=")).alias("stamp")
    )
    registry.coalesce(1).write.mode("overwrite").parquet(f"{path}/registry/{of}")


def load_registry(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, artifact, run, folder, stamp) of everything stored."""
    schema = "symbol STRING, artifact STRING, run TIMESTAMP_NTZ, folder STRING, stamp STRING"
    return spark.read.schema(schema).parquet(f"{path}/registry/*")


def resolve(registry: DataFrame, as_of=None) -> DataFrame:
    """The newest entry of each (symbol, artifact), up to ``as_of`` if given."""
    if as_of is not None:
        registry = registry.where(F.col("run") <= moment(as_of))
    newest = F.max_by(F.struct("run", "folder", "stamp"), "run").alias("_newest")
    return registry.groupBy("symbol", "artifact").agg(newest).select("symbol", "artifact", "_newest.*")


def load_models(
    spark: SparkSession, path: str, symbols: Sequence[str], as_of=None, objects: bool = False
) -> Trained:
    """The models of the given symbols as they held at ``as_of`` (None: the newest).

    Trees come packed for scoring, and with ``objects`` as models too, where the run
    was fitted as such.
    """
    held = resolve(load_registry(spark, path), as_of).where(F.col("symbol").isin(*symbols))
    # one row for each run in use, symbol and artifact; folders prune the reads
    held.persist()
    stamps: dict[str, list[str]] = {}
    for row in held.groupBy("artifact").agg(F.collect_set("stamp").alias("stamps")).collect():
        stamps[row["artifact"]] = row["stamps"]

    def at(artifact: str, folder: str, rest: str = "") -> DataFrame | None:
        """Rows of the runs that hold for an artifact's symbols."""
        if artifact not in stamps:
            return None
        rows = spark.read.parquet(*[f"{path}/{folder}/of={s}{rest}" for s in stamps[artifact]])
        rows = rows.withColumn("stamp", F.regexp_extract("_metadata.file_path", "/of=([0-9-]+)/", 1))
        mine = held.where(F.col("artifact") == artifact)
        keys = ["symbol", "stamp"] + (["artifact"] if rest else [])
        return rows.join(F.broadcast(mine.select(*keys)), keys, "left_semi").drop("stamp")

    packed = [p for name in LOADERS if (p := at(name, "trees", "/packed")) is not None]
    nodes = packed[0].unionByName(packed[1]) if len(packed) == 2 else packed[0] if packed else None
    loaded: dict[str, dict[str, object]] = {name: {} for name in LOADERS}
    if objects:
        saved = F.col("artifact").isin(*LOADERS) & F.col("folder").isNotNull()
        for row in held.where(saved).toLocalIterator():
            loaded[row["artifact"]][row["symbol"]] = LOADERS[row["artifact"]](row["folder"])
    tables = {name: at(artifact, artifact) for artifact, name in TABLES.items()}
    return Trained(**tables, nodes=nodes, **loaded)
