"""Linear models fitted for all keys at once from additive sums.

Each task adds up small cross-product matrices for the rows it reads, the
matrices are summed per key and cell, and each key's system is solved on its
own row. No key's rows meet in one place, and the number of passes does not
depend on the number of keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import spread_join
from tidemark.schema import DIRECTION_TARGET, MODEL_INPUTS, RETURN_TARGET
from tidemark.session import allow_checkpoints

HELD_KEYS = 2000


#: Keys still being fitted that are named in a pass's filter.
LISTED = 1000


def _additive(
    df: DataFrame, used: Sequence[str], key: str, measure: Callable[[np.ndarray], np.ndarray]
) -> DataFrame:
    """Sums of ``measure`` over the rows of each key, as rows (key, cell, total).

    ``measure`` maps a block of rows to a flat array of sums over the block.
    """
    used = list(used)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict = {}

        def flush():
            return pd.DataFrame({key: list(held), "cells": list(held.values())})

        for pdf in batches:
            for k, rows in pdf.groupby(key, sort=False):
                held[k] = held.get(k, 0.0) + measure(rows[used].to_numpy(dtype=float))
            if len(held) > HELD_KEYS:
                yield flush()
                held.clear()
        if held:
            yield flush()

    kind = df.schema[key].dataType.simpleString()
    sums = df.select(key, *[F.col(c).cast("double").alias(c) for c in used]).mapInPandas(
        add_up, f"{key} {kind}, cells array<double>"
    )
    return (
        sums.select(key, F.posexplode("cells").alias("cell", "v"))
        .groupBy(key, "cell")
        .agg(F.sum("v").alias("total"))
    )


def _squares() -> Callable[[np.ndarray], np.ndarray]:
    # made inside a function so that it is sent to the workers by value
    return lambda rows: (rows.T @ rows).ravel()


def gram(
    df: DataFrame, cols: Sequence[str], target: str, key: str = "symbol"
) -> DataFrame:
    """Cross products of (1, cols, target) per key, one row per pair of names."""
    names = ["one", *cols, target]
    size = len(names)
    cells = _additive(df.withColumn("one", F.lit(1.0)), names, key, _squares())
    label = F.array(*[F.lit(n) for n in names])
    return cells.select(
        key,
        label[F.expr(f"cell div {size}")].alias("left_name"),
        label[F.expr(f"cell % {size}")].alias("right_name"),
        "total",
    )


def _as_arrays(cells: DataFrame, key: str) -> DataFrame:
    """One array per key; its length is fixed by the number of columns."""
    ordered = F.array_sort(F.collect_list(F.struct("cell", "total")))
    return cells.groupBy(key).agg(F.transform(ordered, lambda e: e["total"]).alias("cells"))


def fit_ridge(
    train: DataFrame,
    cols: Sequence[str] = MODEL_INPUTS,
    target: str = RETURN_TARGET,
    alpha: float = 1.0,
    key: str = "symbol",
) -> DataFrame:
    """Ridge regression with a free intercept: one row of coefficients per key."""
    width = len(cols) + 2

    @F.pandas_udf("struct<intercept: double, coefficients: array<double>>")
    def solve(cells: pd.Series) -> pd.DataFrame:
        rows = []
        for flat in cells:
            m = np.asarray(flat).reshape(width, width)
            n, mean = m[0, 0], m[0] / m[0, 0]
            centred = m - n * np.outer(mean, mean)
            inner = centred[1:-1, 1:-1] + alpha * np.eye(width - 2)
            b = np.linalg.solve(inner, centred[1:-1, -1])
            rows.append((mean[-1] - mean[1:-1] @ b, b))
        return pd.DataFrame(rows, columns=["intercept", "coefficients"])

    labelled = train.where(F.col(target).isNotNull()).withColumn("one", F.lit(1.0))
    cells = _additive(labelled, ["one", *cols, target], key, _squares())
    return _as_arrays(cells, key).select(key, solve("cells").alias("_m")).select(key, "_m.*")


def margin(cols: Sequence[str]) -> Column:
    """Intercept plus dot product with the joined coefficients."""
    terms = [f"`{c}` * coefficients[{i}]" for i, c in enumerate(cols)]
    return F.expr(" + ".join(["intercept", *terms]))


def predict_linear(
    df: DataFrame,
    model: DataFrame,
    cols: Sequence[str] = MODEL_INPUTS,
    out: str = "prediction",
    key: str = "symbol",
) -> DataFrame:
    joined = spread_join(df, model.select(key, "intercept", "coefficients"), [key])
    return joined.withColumn(out, margin(cols)).drop("intercept", "coefficients")


def predict_logistic(
    df: DataFrame,
    model: DataFrame,
    cols: Sequence[str] = MODEL_INPUTS,
    key: str = "symbol",
) -> DataFrame:
    """Add ``prob_up``, ``prediction`` and ``confidence``."""
    scored = predict_linear(df, model, cols, "_z", key)
    up = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_z")))
    return (
        scored.withColumn("prob_up", up)
        .withColumn("prediction", F.when(F.col("_z") > 0, 1).otherwise(0))
        .withColumn("confidence", F.greatest(F.col("prob_up"), F.lit(1.0) - F.col("prob_up")))
        .drop("_z")
    )


def fit_logistic(
    train: DataFrame,
    cols: Sequence[str] = MODEL_INPUTS,
    target: str = DIRECTION_TARGET,
    c: float = 1.0,
    key: str = "symbol",
    max_iter: int = 50,
    tolerance: float = 1e-6,
) -> DataFrame:
    """L2-regularised logistic regression of every key by Newton steps.

    Minimises ``|w|^2 / 2 + c * log loss`` with a free intercept. A step that
    raises a key's objective is halved for that key. Steps shrink quadratically,
    so after one below ``tolerance`` the rest is below double precision.

    A key that has settled leaves: its rows are not read in later passes, so one slow
    key costs the others nothing. ``converged`` and ``passes`` tell how each key
    ended. A key with one class only has no finite optimum; it takes no
    pass and gets the smoothed log odds of its class as intercept, no weights and
    ``converged`` false. So does, after its first pass, a key whose sums are not
    finite. Separable classes have an optimum, as the weights are penalised.
    The coefficients are the only state between passes and are checkpointed.
    """
    allow_checkpoints(train.sparkSession)
    k = len(cols) + 1
    kind = train.schema[key].dataType.simpleString()
    state_type = (
        f"`{key}` {kind}, at array<double>, held array<double>, objective double, "
        "odds double, active boolean, converged boolean, passes int"
    )
    labelled = train.where(F.col(target).isNotNull()).withColumn("one", F.lit(1.0))
    inputs = ["one", *cols]
    zeros = F.array_repeat(F.lit(0.0), k)
    ups, n = F.sum(F.col(target).cast("double")), F.count(F.lit(1))
    both = (ups > 0) & (ups < n)
    odds = F.log((ups + 0.5) / (n - ups + 0.5))
    start = F.when(both, zeros).otherwise(F.concat(F.array(odds), F.slice(zeros, 2, k - 1)))
    state = labelled.groupBy(key).agg(
        start.alias("at"),
        zeros.alias("held"),
        F.lit(float("inf")).alias("objective"),
        odds.alias("odds"),
        both.alias("active"),
        F.lit(False).alias("converged"),
        F.lit(0).alias("passes"),
    ).checkpoint()

    def measure(rows: np.ndarray) -> np.ndarray:
        """Curvature, slope and loss at the margin in the last column."""
        x, y, z = rows[:, :k], rows[:, k], rows[:, k + 1]
        p = np.where(z >= 0, 1.0, np.exp(-np.abs(z))) / (1.0 + np.exp(-np.abs(z)))
        curvature = x.T @ (x * (p * (1.0 - p))[:, None])
        loss = np.sum(np.logaddexp(0.0, z) - y * z)
        return np.concatenate([curvature.ravel(), x.T @ (p - y), [loss]])

    def advance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        penalty = np.r_[0.0, np.ones(k - 1)]
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                at, held, sums = (np.asarray(v) for v in (row.at, row.held, row.cells))
                objective = c * sums[-1] + 0.5 * float(penalty @ (at * at))
                if not np.isfinite(sums).all():
                    alone = np.r_[row.odds, np.zeros(k - 1)]
                    rows.append((row[0], alone, held, row.objective, row.odds, False, False, row.passes + 1))
                    continue
                if objective > row.objective * (1 + 1e-12):
                    step, objective = (held - at) / 2, row.objective
                else:
                    curvature = c * sums[: k * k].reshape(k, k) + np.diag(penalty)
                    slope = c * sums[k * k : -1] + penalty * at
                    step, held = -np.linalg.lstsq(curvature, slope, rcond=None)[0], at
                settled = bool(np.abs(step).max() <= tolerance)
                rows.append((row[0], at + step, held, objective, row.odds, not settled, settled, row.passes + 1))
            yield pd.DataFrame(
                rows, columns=[key, "at", "held", "objective", "odds", "active", "converged", "passes"]
            )

    for _ in range(max_iter):
        active = state.where("active")
        names = [row[0] for row in active.select(key).limit(LISTED + 1).collect()]
        if not names:
            break
        # few keys are named, which prunes files and row groups; many meet in the join
        rows = labelled.where(F.col(key).isin(names)) if len(names) <= LISTED else labelled
        coefficients = active.select(
            key, F.col("at")[0].alias("intercept"),
            F.slice("at", 2, k - 1).alias("coefficients"),
        )
        seen = spread_join(rows, coefficients, [key]).withColumn("_z", margin(cols))
        sums = _as_arrays(_additive(seen, [*inputs, target, "_z"], key, measure), key)
        moved = active.join(sums, key).mapInPandas(advance, state_type)
        state = state.where("NOT active").unionByName(moved).checkpoint()
    return state.select(
        key,
        F.col("at")[0].alias("intercept"),
        F.slice("at", 2, k - 1).alias("coefficients"),
        "converged",
        "passes",
    )
