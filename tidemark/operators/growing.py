"""Tree ensembles of all symbols, grown together from histograms.

Inputs are cut into bins at each symbol's quantiles, and rows are stored as column
blocks of one symbol each. A level of all trees of all symbols is one job: every
block adds up its rows by (tree, node, input, bin), the sums are combined by Spark,
and the best cut of each node is found from running sums over its bins. The number
of jobs depends on depth and rounds, never on the number of symbols, and a symbol
with a third of all rows is many blocks.

Nodes are numbered as in a heap: the root is 1, node ``i`` has children ``2i`` and
``2i + 1``. Every level is a stored table, so a lost executor repeats one level.

Defined cases: rows without a symbol or label are left out; a missing input (null or
NaN) goes right at every cut; a symbol with one class or with equal inputs gets trees
of a single leaf; columns named like working columns do no harm.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.trees import PACKED
from tidemark.schema import DIRECTION_TARGET, MODEL_INPUTS

BINS = 32
#: Rows of a block; its columns are a few megabytes.
BLOCK_ROWS = 65_536
BLOCK = (
    "symbol STRING, part INT, parts INT, bins BINARY, keys BINARY, label BINARY, "
    "target BINARY, margin BINARY"
)
SUMS = "symbol STRING, tree INT, node INT, feature INT, bin INT, n DOUBLE, s DOUBLE"
NODES = (
    "symbol STRING, tree INT, node INT, n DOUBLE, s DOUBLE, feature INT, bin INT, "
    "n_left DOUBLE, s_left DOUBLE, gain DOUBLE"
)
#: A cut must lower the squared error by more than this for each row of its node.
LEAST_GAIN = 1e-10


@dataclass(frozen=True)
class Binned:
    """Stored blocks of rows and the cut points of each symbol's inputs."""

    blocks: DataFrame
    cuts: DataFrame
    cols: tuple[str, ...]


@dataclass(frozen=True)
class Level:
    """What decides the histograms of one level."""

    depth: int
    trees: tuple[int, ...]
    inputs: int
    tried: int
    seed: int
    bagged: bool


def _stored(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bin_rows(
    rows: DataFrame,
    table: str,
    cols: Sequence[str] = MODEL_INPUTS,
    label: str = DIRECTION_TARGET,
    block_rows: int = BLOCK_ROWS,
) -> Binned:
    """Cut the inputs of labelled rows into bins; blocks and cuts go below ``table``.

    A block takes the rows of its symbol whose hash falls to it, about
    ``block_rows`` of them. Bagging draws by that hash as well, so rows that are
    equal in all columns are drawn together.
    """
    named = [f"x{i}" for i in range(len(cols))]
    given = rows.where(F.col("symbol").isNotNull() & F.col(label).isNotNull()).select(
        "symbol",
        F.col(label).cast("double").alias("label"),
        *[F.col(c).cast("double").alias(n) for c, n in zip(cols, named, strict=True)],
        # last: the planner keeps a variant of it for each alias that follows
        F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).alias("key"),
    )
    places = [i / BINS for i in range(1, BINS)]
    number = [F.when(~F.isnan(n), F.col(n)) for n in named]
    cuts = _stored(
        given.groupBy("symbol").agg(
            F.ceil(F.count("*") / block_rows).cast("int").alias("parts"),
            F.array(
                *[
                    F.coalesce(F.percentile_approx(x, places), F.array().cast("array<double>"))
                    for x in number
                ]
            ).alias("cuts"),
        ),
        f"{table}/cuts",
    )
    inputs = len(cols)

    def run(part: pa.Table, cut: pa.Table) -> pa.Table:
        n = part.num_rows
        if not n or not cut.num_rows:
            return pa.table({f.name: pa.array([], f.type) for f in _BLOCK_TYPES}, schema=_BLOCK_TYPES)
        first = cut.slice(0, 1).to_pylist()[0]
        bins = np.empty((n, inputs), np.uint8)
        for i, points in enumerate(first["cuts"]):
            values = part.column(f"x{i}").to_numpy(zero_copy_only=False).astype(float)
            bins[:, i] = np.searchsorted(np.unique(points), values)
        y = part.column("label").to_numpy(zero_copy_only=False).astype(float)
        keys = part.column("key").to_numpy(zero_copy_only=False).astype(np.int64)
        found = [
            first["symbol"], first["part"], first["parts"], bins.tobytes(), keys.tobytes(),
            y.tobytes(), y.tobytes(), np.zeros(n).tobytes(),
        ]
        return pa.table(
            [pa.array([v], f.type) for v, f in zip(found, _BLOCK_TYPES, strict=True)],
            schema=_BLOCK_TYPES,
        )

    parts = cuts.select("symbol", "parts")
    dealt = given.join(parts, "symbol").withColumn("part", F.pmod("key", F.col("parts")).cast("int"))
    copies = cuts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    keys = ["symbol", "part"]
    blocks = dealt.drop("parts").groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(run, BLOCK)
    return Binned(_stored(blocks, f"{table}/blocks"), cuts, tuple(cols))


_BLOCK_TYPES = pa.schema(
    [("symbol", pa.string()), ("part", pa.int32()), ("parts", pa.int32())]
    + [(c, pa.binary()) for c in ("bins", "keys", "label", "target", "margin")]
)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers from any 64-bit numbers."""
    x = x.astype(np.uint64)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    return x ^ (x >> np.uint64(31))


def _drawn(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson counts of mean one."""
    salt = _mixed(np.array([tree * 1_000_003 + seed]))
    chance = (_mixed(keys.view(np.uint64) ^ salt) >> np.uint64(11)).astype(float) / 2.0**53
    shares = np.exp(-1.0) / np.cumprod(np.maximum(1.0, np.arange(16)))
    return np.searchsorted(np.cumsum(shares), chance, side="right").astype(float)


def _tried(nodes: np.ndarray, tree: int, level: Level) -> np.ndarray:
    """The inputs that each node may cut, by least hashes."""
    every = np.arange(level.inputs, dtype=np.uint64)
    if level.tried >= level.inputs:
        return np.broadcast_to(every.astype(int), (len(nodes), level.inputs))
    salt = _mixed(np.array([tree * 7_919 + level.seed]))
    rank = _mixed((_mixed(nodes ^ salt)[:, None] + every[None, :] * np.uint64(0x9E3779B97F4A7C15)))
    return np.argsort(rank, axis=1, kind="stable")[:, : level.tried]


def _nodes_of(bins: np.ndarray, cuts: dict, tree: int, depth: int) -> np.ndarray:
    """The node of each row after up to ``depth`` cuts of a tree."""
    feature, bound = np.full(1 << depth, -1), np.zeros(1 << depth, int)
    own = (cuts["tree"] == tree) & (cuts["node"] < (1 << depth))
    feature[cuts["node"][own]], bound[cuts["node"][own]] = cuts["feature"][own], cuts["bin"][own]
    node, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        at = np.minimum(node, (1 << depth) - 1)
        cut = (feature[at] >= 0) & (node < (1 << depth))
        right = bins[rows, np.maximum(feature[at], 0)] > bound[at]
        node = np.where(cut, 2 * node + right, node)
    return node


def _columns(records: list[dict] | None, names: Sequence[str]) -> dict:
    return {c: np.array([r[c] for r in records or []]) for c in names}


def _histograms(block: dict, level: Level) -> Iterator[tuple]:
    """Sums of a block for each tree: node, input, bin, rows and targets."""
    bins = np.frombuffer(block["bins"], np.uint8).reshape(-1, level.inputs)
    keys, target = np.frombuffer(block["keys"], np.int64), np.frombuffer(block["target"])
    cuts = _columns(block["cut_nodes"], ("tree", "node", "feature", "bin"))
    cuts = {c: v.astype(int) for c, v in cuts.items()}
    for tree in level.trees:
        node = _nodes_of(bins, cuts, tree, level.depth)
        weight = _drawn(keys, tree, level.seed) if level.bagged else np.ones(len(keys))
        live = np.flatnonzero((node >= (1 << level.depth)) & (weight > 0))
        if not len(live):
            continue
        nodes, at = np.unique(node[live], return_inverse=True)
        tried = _tried(nodes.astype(np.uint64), tree, level)[at]
        cell = (at[:, None] * level.inputs + tried) * BINS + bins[live[:, None], tried]
        size = len(nodes) * level.inputs * BINS
        flat, wide = cell.ravel(), tried.shape[1]
        n = np.bincount(flat, np.repeat(weight[live], wide), size)
        s = np.bincount(flat, np.repeat(weight[live] * target[live], wide), size)
        held = np.flatnonzero(n)
        rest, bin_ = np.divmod(held, BINS)
        place, feature = np.divmod(rest, level.inputs)
        yield tree, nodes[place], feature, bin_, n[held], s[held]


def _with_cuts(blocks: DataFrame, grown: DataFrame | None) -> DataFrame:
    """Each block with the cuts found so far for its symbol.

    A symbol's cuts are bounded by trees and depth; copies of them meet the blocks
    by (symbol, part), so that no task gets all blocks of one symbol.
    """
    if grown is None:
        return blocks.withColumn(
            "cut_nodes", F.lit(None).cast("array<struct<tree:int,node:int,feature:int,bin:int>>")
        )
    packed = (
        grown.where("feature >= 0")
        .groupBy("symbol")
        .agg(F.collect_list(F.struct("tree", "node", "feature", "bin")).alias("cut_nodes"))
    )
    keys = blocks.select("symbol", "part")
    return blocks.join(keys.join(packed, "symbol"), ["symbol", "part"], "left")


def _best_cuts(sums: DataFrame, min_rows: int) -> DataFrame:
    """The best cut of each node; ``feature`` is -1 where none lowers the error."""
    node = ["symbol", "tree", "node"]
    whole = Window.partitionBy(*node, "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = sums.select(
        *node,
        "feature",
        "bin",
        F.sum("n").over(upto).alias("n_left"),
        F.sum("s").over(upto).alias("s_left"),
        F.sum("n").over(whole).alias("n"),
        F.sum("s").over(whole).alias("s"),
    )
    fits = F.expr(f"n_left >= {min_rows} AND n - n_left >= {min_rows}")
    gain = F.expr("s_left * s_left / n_left + (s - s_left) * (s - s_left) / (n - n_left) - s * s / n")
    run = run.withColumn("gain", F.when(fits, gain))
    good = F.when(F.col("gain") > LEAST_GAIN * F.col("n"), F.struct(
        "gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "n_left", "s_left"
    ))
    best = run.groupBy(*node).agg(
        F.max(F.struct((-F.col("feature")).alias("f"), "n", "s")).alias("all"), F.max(good).alias("cut")
    )
    return best.select(
        *node,
        "all.n",
        "all.s",
        F.coalesce(-F.col("cut.f"), F.lit(-1)).cast("int").alias("feature"),
        (-F.col("cut.b")).cast("int").alias("bin"),
        "cut.n_left",
        "cut.s_left",
        "cut.gain",
    )


def _level(blocks: DataFrame, grown: DataFrame | None, level: Level, min_rows: int) -> DataFrame:
    types = [pa.string(), *[pa.int32()] * 4, *[pa.float64()] * 2]
    names = [c.split()[0] for c in SUMS.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.slice(row, 1).to_pylist()[0]
                for tree, *columns in _histograms(block, level):
                    size = len(columns[0])
                    first = [[block["symbol"]] * size, np.full(size, tree)]
                    arrays = [pa.array(c, t) for c, t in zip([*first, *columns], types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

    given = _with_cuts(blocks.select("symbol", "part", "bins", "keys", "target"), grown)
    sums = (
        given.mapInArrow(run, SUMS)
        .groupBy("symbol", "tree", "node", "feature", "bin")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    )
    return _best_cuts(sums, min_rows)


def _grow(
    blocks: DataFrame, table: str, trees: Sequence[int], depth: int, min_rows: int, tried: int,
    inputs: int, seed: int, bagged: bool,
) -> list[str]:
    """Grow the given trees level by level; the stored tables of their nodes."""
    spark, paths, grown = blocks.sparkSession, [], None
    for d in range(depth):
        level = Level(d, tuple(trees), inputs, tried, seed, bagged)
        found = _stored(_level(blocks, grown, level, min_rows), f"{table}/level{d}")
        paths.append(f"{table}/level{d}")
        grown = spark.read.schema(NODES).parquet(*paths)
        if found.where("feature >= 0").isEmpty():
            break
    return paths


def grow_forest(
    binned: Binned,
    table: str,
    trees: int = 100,
    depth: int = 10,
    min_rows: int = 5,
    tried: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Nodes of a random forest for every symbol.

    Rows are drawn with Poisson counts, a node may cut the square root of the inputs
    (rounded up) unless ``tried`` says otherwise; ``min_rows`` counts drawn rows.
    Labels are 0 and 1, so the squared error that cuts lower is half the Gini sum.
    """
    inputs = len(binned.cols)
    tried = int(np.ceil(np.sqrt(inputs))) if tried is None else tried
    paths = _grow(binned.blocks, table, range(trees), depth, min_rows, tried, inputs, seed, True)
    return binned.blocks.sparkSession.read.schema(NODES).parquet(*paths)


def leaf_values(nodes: DataFrame) -> DataFrame:
    """(symbol, tree, node, n, s) of all nodes, those below the last cuts included."""
    cut = nodes.where("feature >= 0")
    below = cut.select("symbol", "tree", F.explode(F.expr("""array(
        struct(2 * node AS node, n_left AS n, s_left AS s),
        struct(2 * node + 1 AS node, n - n_left AS n, s - s_left AS s))""")).alias("c"))  # fmt: skip
    root = nodes.where("node = 1").select("symbol", "tree", "node", "n", "s")
    return root.unionByName(below.select("symbol", "tree", "c.*"))


def _advance(blocks: DataFrame, nodes: DataFrame, tree: int, depth: int, weight: float, inputs: int) -> DataFrame:
    """Blocks with margins raised by a tree and the targets of the next one."""
    values = leaf_values(nodes).groupBy("symbol").agg(
        F.collect_list(F.struct("node", (F.col("s") / F.col("n")).alias("value"))).alias("values")
    )
    keys = blocks.select("symbol", "part").join(values, "symbol")
    given = _with_cuts(blocks, nodes).join(keys, ["symbol", "part"], "left")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.slice(row, 1).to_pylist()[0]
                bins = np.frombuffer(block["bins"], np.uint8).reshape(-1, inputs)
                cuts = _columns(block["cut_nodes"], ("tree", "node", "feature", "bin"))
                cuts = {c: v.astype(int) for c, v in cuts.items()}
                worth = np.zeros(2 << depth)
                for v in block["values"]:
                    worth[v["node"]] = v["value"]
                margin = np.frombuffer(block["margin"]) + weight * worth[_nodes_of(bins, cuts, tree, depth)]
                y = 2 * np.frombuffer(block["label"]) - 1
                block["margin"] = margin.tobytes()
                block["target"] = (4 * y / (1 + np.exp(2 * y * margin))).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block[f.name]], f.type) for f in _BLOCK_TYPES], schema=_BLOCK_TYPES
                )

    return given.mapInArrow(run, BLOCK)


def _tree_weight(tree: int, rate: float) -> float:
    return 1.0 if tree == 0 else rate


def grow_boosting(
    binned: Binned, table: str, rounds: int = 100, depth: int = 5, rate: float = 0.1, min_rows: int = 1
) -> DataFrame:
    """Nodes of gradient boosting with log loss for every symbol.

    The first tree is fitted to the labels as -1 and 1, each later one to the slope
    of the loss at the margins so far, which are stored with the blocks from round
    to round (two tables that take turns).
    """
    spark, inputs, blocks = binned.blocks.sparkSession, len(binned.cols), binned.blocks
    blocks = _stored(blocks.mapInArrow(_signed, BLOCK), f"{table}/margins1")
    paths = []
    for tree in range(rounds):
        own = _grow(blocks, f"{table}/round{tree}", [tree], depth, min_rows, inputs, inputs, 0, False)
        paths += own
        if tree + 1 < rounds:
            nodes = spark.read.schema(NODES).parquet(*own)
            moved = _advance(blocks, nodes, tree, depth, _tree_weight(tree, rate), inputs)
            blocks = _stored(moved, f"{table}/margins{tree % 2}")
    return spark.read.schema(NODES).parquet(*paths)


def _signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        target = [(2 * np.frombuffer(y.as_py()) - 1).tobytes() for y in batch.column("label")]
        at = batch.schema.names.index("target")
        yield batch.set_column(at, "target", pa.array(target, pa.binary()))


def pack_grown(
    nodes: DataFrame, binned: Binned, artifact: str, margins: bool = False, rate: float = 0.1
) -> DataFrame:
    """Grown trees as packed rows for ``score_trees``, one for each symbol."""
    full = leaf_values(nodes).join(
        nodes.where("feature >= 0").select("symbol", "tree", "node", "feature", "bin"),
        ["symbol", "tree", "node"], "left",
    )
    names = [c.split()[0] for c in PACKED.split(", ")]
    kinds = [
        pa.string(), pa.string(), pa.bool_(), pa.list_(pa.int32()), pa.list_(pa.float64()),
        pa.list_(pa.int32()), pa.list_(pa.float64()), *[pa.list_(pa.int32())] * 2,
        *[pa.list_(pa.float64())] * 2,
    ]
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(given: pa.Table, cuts: pa.Table) -> pa.Table:
        if not given.num_rows or not cuts.num_rows:
            return schema.empty_table()
        rows = given.to_pandas().sort_values(["tree", "node"], ignore_index=True)
        points = [np.unique(p) for p in cuts.slice(0, 1).to_pylist()[0]["cuts"]]
        place = {key: i for i, key in enumerate(zip(rows["tree"], rows["node"], strict=True))}
        feature = rows["feature"].fillna(-1).astype(int)
        threshold, left, right = [], [], []
        for i, (tree, node, f, b) in enumerate(
            zip(rows["tree"], rows["node"], feature, rows["bin"], strict=True)
        ):
            threshold.append(float(points[f][int(b)]) if f >= 0 else 0.0)
            left.append(place[tree, 2 * node] if f >= 0 else i)
            right.append(place[tree, 2 * node + 1] if f >= 0 else i)
        roots = np.flatnonzero(rows["node"] == 1)
        trees = rows["tree"].iloc[roots]
        share = rows["s"] / rows["n"]
        found = [
            given.column("symbol")[0].as_py(), artifact, margins, roots.tolist(),
            [_tree_weight(t, rate) if margins else 1.0 for t in trees],
            feature.tolist(), threshold, left, right, share.tolist(),
            [0.0] * len(rows) if margins else (1 - share).tolist(),
        ]
        arrays = [pa.array([v], t) for v, t in zip(found, kinds, strict=True)]
        return pa.table(arrays, schema=schema)

    return full.groupBy("symbol").cogroup(binned.cuts.groupBy("symbol")).applyInArrow(run, PACKED)


def grown_importance(nodes: DataFrame, cols: Sequence[str] = MODEL_INPUTS) -> DataFrame:
    """Importance per symbol and input: shares of each tree's gain, averaged over its trees.

    Inputs that no tree cuts have 0; a symbol without any cut has 0 throughout.
    """
    cut = nodes.where("feature >= 0").groupBy("symbol", "tree", "feature").agg(F.sum("gain").alias("gain"))
    share = F.col("gain") / F.sum("gain").over(Window.partitionBy("symbol", "tree"))
    by_input = cut.withColumn("share", share).groupBy("symbol", "feature").agg(F.sum("share").alias("share"))
    total = F.sum("share").over(Window.partitionBy("symbol"))
    by_input = by_input.select("symbol", "feature", (F.col("share") / total).alias("importance"))
    named = F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("feature", "name")
    every = nodes.select("symbol").distinct().select("symbol", named)
    out = every.join(by_input, ["symbol", "feature"], "left")
    return out.select("symbol", F.col("name").alias("feature"), F.coalesce("importance", F.lit(0.0)).alias("importance"))
