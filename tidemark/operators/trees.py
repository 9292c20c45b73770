"""Scoring with tree ensembles kept as tables.

Each ensemble is one row of packed arrays by (symbol, artifact). Rows meet the
ensembles of their symbol once, and a group's rows walk all trees of an ensemble
together, a level at a step. The plan has one branch for any number of symbols.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema, to_arrow_type

from tidemark.schema import MODEL_INPUTS

#: ``value`` and ``other``: shares of class 1 and 0 at a node, or the margin and 0.
PACKED = (
    "symbol STRING, artifact STRING, margins BOOLEAN, roots ARRAY<INT>, weights ARRAY<DOUBLE>, "
    "feature ARRAY<INT>, threshold ARRAY<DOUBLE>, left ARRAY<INT>, right ARRAY<INT>, "
    "value ARRAY<DOUBLE>, other ARRAY<DOUBLE>"
)
SCORES = {
    "prediction": T.IntegerType(),
    "confidence": T.DoubleType(),
    "prob_up": T.DoubleType(),
    "prob_down": T.DoubleType(),
}


def pack_saved(spark: SparkSession, entries: DataFrame) -> DataFrame:
    """Packed rows of ensembles that were saved in folders of their own.

    ``entries``: symbol, artifact, ``margins`` (trees add to a margin, as in
    boosting, instead of voting by class shares) and ``folder``, which ends in a
    number that no other entry has. All folders are read in one scan.
    """
    folders = [row["folder"] for row in entries.select("folder").collect()]
    numbered = entries.withColumn("entry", F.element_at(F.split("folder", "/"), -1))

    def saved(part: str) -> DataFrame:
        """That part of every saved ensemble, with the number of its folder."""
        rows = spark.read.parquet(*[f"{f}/{part}" for f in folders])
        return rows.withColumn("entry", F.regexp_extract("_metadata.file_path", rf"/(\d+)/{part}/", 1))

    stats = F.expr("nodeData.impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)

    def share(i: int):
        return F.coalesce(F.try_divide(F.get(stats, F.lit(i)), total), F.lit(0.0))

    split = F.col("nodeData.split")
    nodes = saved("data").join(F.broadcast(numbered), "entry").select(
        "symbol",
        "artifact",
        "margins",
        F.col("treeID").alias("tree"),
        F.struct(
            F.col("treeID").alias("tree"),
            F.col("nodeData.id").alias("id"),
            split["featureIndex"].alias("feature"),
            F.when(split["numCategories"] >= 0, F.raise_error(F.lit("inputs are numbers, not categories")).cast("double"))
            .otherwise(F.coalesce(F.get(split["leftCategoriesOrThreshold"], F.lit(0)), F.lit(0.0)))
            .alias("threshold"),
            F.col("nodeData.leftChild").alias("left"),
            F.col("nodeData.rightChild").alias("right"),
            F.when(F.col("margins"), F.col("nodeData.prediction")).otherwise(share(1)).alias("value"),
            F.when(F.col("margins"), F.lit(0.0)).otherwise(share(0)).alias("other"),
        ).alias("node"),
    )
    # ids count from 0 within each tree; trees lie one behind the other
    packed = nodes.groupBy("symbol", "artifact", "margins").agg(
        F.array_sort(F.collect_list("node")).alias("nodes")
    )
    weights = saved("treesMetadata").join(F.broadcast(numbered), "entry").groupBy("symbol", "artifact").agg(
        F.expr("transform(array_sort(collect_list(struct(_1 AS tree, _3 AS weight))), t -> t.weight)").alias("weights")
    )
    starts = "filter(sequence(0, size(nodes) - 1), i -> nodes[i].id = 0)"
    out = packed.join(weights, ["symbol", "artifact"]).withColumn("roots", F.expr(starts))
    base = "roots[nodes[i].tree]"
    moved = "transform(sequence(0, size(nodes) - 1), i -> int({}))"
    return out.select(
        "symbol",
        "artifact",
        "margins",
        "roots",
        "weights",
        F.expr("nodes.feature").alias("feature"),
        F.expr("nodes.threshold").alias("threshold"),
        *[
            F.expr(moved.format(f"IF(nodes[i].{side} < 0, i, nodes[i].{side} + {base})")).alias(side)
            for side in ("left", "right")
        ],
        F.expr("nodes.value").alias("value"),
        F.expr("nodes.other").alias("other"),
    )


def _walk(model: dict, inputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over an ensemble's trees for each row: for class 1 and for class 0."""
    feature, threshold, left, right, value, other, roots, weights = (
        np.asarray(model[k])
        for k in ("feature", "threshold", "left", "right", "value", "other", "roots", "weights")
    )
    at = np.broadcast_to(roots, (len(inputs), len(roots)))
    rows = np.arange(len(inputs))[:, None]
    inner = feature[at] >= 0
    while inner.any():
        goes_left = inputs[rows, np.maximum(feature[at], 0)] <= threshold[at]
        at = np.where(goes_left, left[at], right[at])
        inner = feature[at] >= 0
    return np.cumsum(value[at] * weights, 1)[:, -1], np.cumsum(other[at] * weights, 1)[:, -1]


def _scores(model: dict, inputs: np.ndarray) -> list[pa.Array]:
    up, down = _walk(model, inputs)
    chosen = (up > (0 if model["margins"] else down)).astype(np.int32)
    chance = 1 / (1 + np.exp(-2 * up)) if model["margins"] else up / (up + down)
    confidence = np.where(chosen == 1, chance, 1 - chance)
    return [pa.array(chosen), pa.array(confidence), pa.array(chance), pa.array(1 - chance)]


def score_trees(
    rows: DataFrame,
    packed: DataFrame,
    prefixes: Mapping[str, str],
    cols: Sequence[str] = MODEL_INPUTS,
    parts: int = 1,
) -> DataFrame:
    """Class, confidence and chances by each artifact in ``prefixes``, under its prefix.

    A symbol without one of the artifacts has NULL there; rows of symbols
    without any are left out. A missing input goes right at every split. ``parts``
    deals each symbol's rows to as many tasks; its ensembles go to each of them.
    """
    added = [T.StructField(f"{p}_{name}", kind) for p in prefixes.values() for name, kind in SCORES.items()]
    schema = T.StructType([*rows.schema.fields, *added])
    packed = packed.where(F.col("artifact").isin(*prefixes))

    def run(given: pa.Table, models: pa.Table) -> pa.Table:
        if not models.num_rows or not given.num_rows:
            return to_arrow_schema(schema).empty_table()
        given = given.drop_columns(["_part"])
        inputs = np.column_stack(
            [given.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in cols]
        )
        found = {m["artifact"]: m for m in models.to_pylist()}
        columns = list(given.columns)
        for artifact in prefixes:
            if artifact in found:
                columns += _scores(found[artifact], inputs)
            else:
                columns += [pa.nulls(given.num_rows, to_arrow_type(kind)) for kind in SCORES.values()]
        return pa.table(dict(zip(schema.names, columns, strict=True)))

    dealt = rows.withColumn("_part", F.pmod(F.xxhash64(*cols), F.lit(parts)).cast("int"))
    copies = packed.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    keys = ["symbol", "_part"]
    return dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(run, schema)
