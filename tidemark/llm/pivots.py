"""Near-duplicate vectors through a pivot-permutation index.

Reference points (pivots) are drawn from the vectors. A vector is described by its
``NEAR`` nearest pivots in order; near vectors have most of them in common. Each
vector is entered into the inverted list of every three pivots among its nearest,
so that what meets in a list has a shared-pivot count of at least three; there the
cosine is computed exactly. A pair that meets in several lists counts in the one of
its three lowest shared pivots.

The number of pivots grows with the cube root of the number of vectors (up to
``MOST_PIVOTS``), which keeps lists short; long lists, as large groups of near
vectors make them, are compared block by block, and tasks return counts and a
spanning forest instead of pairs.

Defined cases: vectors of one value and label form a class, which is compared once;
vectors that are null, empty, zero, or hold null or non-finite components, and
those without label, link with nothing; vectors of each length have an index of their
own, as vectors of different lengths have no cosine. A row with a null id is returned without links. Scaled
copies count as near. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.stage import store

NEAR, SHARED = 8, 3
LIST_ROWS = 4  # rows of a list to aim at
LEAST_PIVOTS, MOST_PIVOTS = 32, 4096
BLOCK = 512
TRIPLES = np.array(list(combinations(range(NEAR), SHARED)))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, safe against overflow."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def pivot_number(n: int) -> int:
    """Pivots for ``n`` vectors, so that a list of three holds a few."""
    count = LEAST_PIVOTS
    while count < MOST_PIVOTS and n * len(TRIPLES) > LIST_ROWS * count**3 / 6:
        count *= 2
    return count


def lists_of(vectors: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest pivots of each row in order, and the keys of its lists."""
    near = min(NEAR, len(pivots))
    closeness = vectors @ pivots.T
    part = np.argpartition(-closeness, near - 1, axis=1)[:, :near]
    order = np.argsort(-np.take_along_axis(closeness, part, 1), axis=1, kind="stable")
    ordered = np.take_along_axis(part, order, 1)
    low = np.sort(ordered, axis=1).astype(np.int64)
    triples = np.array(list(combinations(range(near), min(SHARED, near))))
    keys = np.zeros((len(low), len(triples)), np.int64)
    for column in triples.T:
        keys = keys * MOST_PIVOTS + low[:, column]
    return ordered, keys


def _matrix(column: pa.Array, dtype: type = np.float64) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def _classes(vectors: DataFrame) -> DataFrame:
    """One row for each label and value: least id, number of rows."""
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("v", lambda x: x != 0)
    usable = F.coalesce(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & fine & some, F.lit(False)
    )
    return vectors.where(usable).groupBy("label", "v").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n")
    )


def _compare(batch_rows: dict, threshold: float) -> tuple[list, list]:
    """Counts and forest of one list, or of two blocks of a long one."""
    v, near, rep, n, side = (batch_rows[k] for k in ("v", "near", "rep", "n", "side"))
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    close = v[left] @ v[right].T >= threshold
    if len(left) == len(right) and (left == right).all():
        close = np.triu(close, 1)
    i, j = np.nonzero(close)
    if not len(i):
        return [], []
    a, b = left[i], right[j]
    counts = np.zeros(len(rep), np.int64)
    for at in range(0, len(a), 1 << 16):
        x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
        # the three lowest shared pivots tell the list in which the pair counts
        shared = (near[x][:, :, None] == near[y][:, None, :]).any(axis=2)
        rank = np.where(shared & (np.cumsum(shared, axis=1) <= SHARED), near[x], 0)
        key = np.zeros(len(x), np.int64)
        place = np.cumsum(shared, axis=1)
        for s in range(1, min(SHARED, near.shape[1]) + 1):
            here = shared & (place == s)
            key = key * MOST_PIVOTS + np.where(here, rank, 0).sum(axis=1)
        counted = key == batch_rows["key"]
        np.add.at(counts, x[counted], n[y[counted]])
        np.add.at(counts, y[counted], n[x[counted]])
    # least place reachable, by repeated exchange over the links
    label = np.arange(len(rep))[np.argsort(np.argsort(rep, kind="stable"), kind="stable")]
    while True:
        old = label.copy()
        np.minimum.at(label, a, old[b])
        np.minimum.at(label, b, old[a])
        if (label == old).all():
            break
    by_rank = np.sort(rep)
    root = by_rank[label]
    moved = np.flatnonzero(root != rep)
    seen = np.flatnonzero(counts)
    return (
        [(int(rep[k]), int(counts[k]), None) for k in seen],
        [(int(rep[k]), 0, int(root[k])) for k in moved],
    )


def near_duplicates(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """Links and component of every row of ``vec_id``, ``embedding``, ``label``."""
    rows = vectors.select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("v")
    )
    classes = store(_classes(rows), "classes")
    # one row for each length in use
    lengths = classes.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).where("n > 1")
    ids = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    members = ids.join(
        classes.select(F.col("label").alias("l"), F.col("v").alias("w"), "rep", "n"),
        (F.col("label") == F.col("l")) & (F.col("v") == F.col("w")) & F.col("vec_id").isNotNull(),
        "left",
    ).select("vec_id", "rep", "n")
    found = None
    for row in lengths.orderBy("w").collect():
        links = _links(classes, row["n"], row["w"], threshold)
        found = found.unionByName(links) if found else links
    if found is None:
        counts = classes.select("rep", F.lit(0).cast("long").alias("others")).limit(0)
        groups = classes.select(F.col("rep").alias("id"), F.col("rep").alias("component")).limit(0)
    else:
        counts = found.where("root IS NULL").groupBy("rep").agg(F.sum("links").alias("others"))
        groups = components(
            found.where("root IS NOT NULL").select(F.col("rep").alias("a"), F.col("root").alias("b"))
        )
    return (
        members.join(counts.withColumnRenamed("rep", "c_rep"), F.col("rep") == F.col("c_rep"), "left")
        .join(groups, F.col("rep") == F.col("id"), "left")
        .select(
            "vec_id",
            (F.coalesce("others", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0)))
            .cast("long")
            .alias("n_links"),
            F.coalesce("component", "rep", "vec_id").cast("long").alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id") == F.col("component_id"))
    )


def _links(classes: DataFrame, size: int, width: int, threshold: float) -> DataFrame:
    """Link counts (``root`` null) and links to a lower member, by class of one length."""
    number = pivot_number(size)
    usual = classes.where(F.size("v") == width)
    drawn = usual.orderBy(F.xxhash64("rep"), "rep").limit(number).toArrow()
    pivots = unit(_matrix(drawn["v"].combine_chunks()))

    def enter(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            vectors = unit(_matrix(batch.column(2)))
            ordered, keys = lists_of(vectors, pivots)
            near = np.sort(ordered, axis=1).astype(np.int32)

            def listed(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
                flat = pa.array(rows.ravel(), kind)
                stops = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
                return pa.ListArray.from_arrays(pa.array(stops), flat)

            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    listed(vectors, pa.float64()),
                    batch.column(3),
                    listed(near, pa.int32()),
                    listed(keys, pa.int64()),
                ],
                ["label", "rep", "v", "n", "near", "keys"],
            )

    label = classes.schema["label"].dataType.simpleString()
    entered = store(
        usual.select("label", "rep", "v", "n").mapInArrow(
            enter,
            f"label {label}, rep bigint, v array<double>, n bigint, near array<int>, "
            "keys array<bigint>",
        ),
        "entered",
    )
    postings = entered.select("label", "rep", F.explode("keys").alias("key"))
    lists = postings.groupBy("label", "key").agg(F.count("*").alias("size")).where("size > 1")
    lists = lists.select(F.col("label").alias("l"), F.col("key").alias("k"), "size")
    met = postings.join(lists, (F.col("label") == F.col("l")) & (F.col("key") == F.col("k")))
    # long lists become pairs of blocks; a row goes to every pair with its block
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    met = (
        met.withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            F.xxhash64("label", "key").alias("list"),
            "key",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            F.when(F.col("own") == F.col("other"), 2)
            .when(F.col("own") < F.col("other"), 0)
            .otherwise(1)
            .alias("side"),
            F.col("rep").alias("r"),
        )
    )
    placed = (
        met.join(entered.select("rep", "v", "n", "near"), F.col("r") == F.col("rep"))
        .select("list", "key", "i", "j", "side", "rep", "v", "n", "near")
        .repartition("list", "i", "j")
        .sortWithinPartitions("list", "key", "i", "j")
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        mark = None

        def done() -> tuple[list, list]:
            whole = {k: np.concatenate([h[k] for h in held]) for k in held[0] if k != "key"}
            return _compare(whole | {"key": mark[1]}, threshold)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            a, b, c = zip(*rows, strict=True) if rows else ((), (), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.int64()) for x in (a, b, c)], ["rep", "links", "root"]
            )

        for batch in batches:
            if not len(batch):
                continue
            head = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)], 1)
            data = {
                "side": batch.column(4).to_numpy(zero_copy_only=False),
                "rep": batch.column(5).to_numpy(zero_copy_only=False),
                "v": _matrix(batch.column(6)),
                "n": batch.column(7).to_numpy(zero_copy_only=False),
                "near": _matrix(batch.column(8), np.int64),
            }
            cuts = np.flatnonzero((head[1:] != head[:-1]).any(axis=1)) + 1
            out: list[tuple] = []
            for start, end in zip([0, *cuts], [*cuts, len(head)], strict=True):
                if held and tuple(head[start]) != mark:
                    for part in done():
                        out += part
                    held = []
                mark = tuple(head[start])
                held.append({k: x[start:end] for k, x in data.items()})
            yield batch_of(out)
        if held:
            yield batch_of([x for part in done() for x in part])

    return store(placed.mapInArrow(compare, "rep bigint, links bigint, root bigint"), "links")
