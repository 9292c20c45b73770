"""Training preparation per symbol: impute, split by time, standardise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import number_rows
from tidemark.operators.skew import spread_join
from tidemark.schema import MODEL_INPUTS


def assemble(df: DataFrame, cols: Sequence[str] = MODEL_INPUTS, out: str = "features") -> DataFrame:
    """Gather the model inputs into one vector column."""
    doubles = df.withColumns({c: F.col(c).cast("double") for c in cols})
    return VectorAssembler(inputCols=list(cols), outputCol=out).transform(doubles)


def group_medians(df: DataFrame, cols: Sequence[str], key: str = "symbol") -> DataFrame:
    """Exact median of every column per key; columns keep their names.

    A mergeable sketch first brackets each median between its 49.95% and 50.05%
    quantiles; the sketch is off by 0.01% at most. Values under the bracket are
    only counted and those above it are left out, so the exact ranking sees
    about a thousandth of a group.
    """
    near = F.array(F.lit(0.4995), F.lit(0.5005))
    value = {c: F.col(c).cast("double") for c in cols}
    brackets = df.groupBy(key).agg(
        *[F.percentile_approx(value[c], near, 10000).alias(f"_q_{c}") for c in cols],
        *[F.count(c).alias(f"_n_{c}") for c in cols],
    )
    quantiles = [
        F.struct(
            F.lit(c).alias("col"), F.col(f"_q_{c}")[0].alias("low"),
            F.col(f"_q_{c}")[1].alias("high"), F.col(f"_n_{c}").alias("n"),
        )
        for c in cols
    ]
    wide = brackets.select(key, F.array(*quantiles).alias("_q"))
    paired = spread_join(
        df.select(key, F.array(*[value[c] for c in cols]).alias("_v")), wide, [key]
    )
    # below the bracket: counted under a NULL value
    relevant = F.filter(
        F.arrays_zip("_v", "_q"), lambda e: e["_v"].isNotNull() & (e["_v"] <= e["_q"]["high"])
    )
    counted = (
        paired.select(key, F.explode(relevant).alias("_e"))
        .select(
            key,
            F.col("_e._q.col").alias("_col"),
            F.col("_e._q.n").alias("_n"),
            F.when(F.col("_e._v") >= F.col("_e._q.low"), F.col("_e._v")).alias("_value"),
        )
        .groupBy(key, "_col", "_n", "_value")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    w = Window.partitionBy(key, "_col").orderBy(F.asc_nulls_first("_value"))
    ranked = counted.withColumn(
        "_upto", F.sum("_copies").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    lower, upper = F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")
    middle = ranked.groupBy(key, "_col").agg(
        (
            (
                F.min(F.when(F.col("_upto") >= lower, F.col("_value")))
                + F.min(F.when(F.col("_upto") >= upper, F.col("_value")))
            )
            / 2.0
        ).alias("_median")
    )
    return middle.groupBy(key).agg(
        *[F.max(F.when(F.col("_col") == c, F.col("_median"))).alias(c) for c in cols]
    )


def impute_median(
    df: DataFrame,
    cols: Sequence[str] = MODEL_INPUTS,
    key: str = "symbol",
    fit_on: DataFrame | None = None,
    all_missing: float | None = None,
) -> DataFrame:
    """Fill missing values with the key's median over ``fit_on`` or all rows.

    An input without any value for a key becomes ``all_missing``; a number there is
    the same for all its rows, so that it is 0 after scaling and tells a model nothing.
    """
    medians = group_medians(df if fit_on is None else fit_on, cols, key)
    medians = medians.select(key, *[F.col(c).alias(f"_median_{c}") for c in cols])
    last = F.lit(all_missing).cast("double")
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col(f"_median_{c}"), last) for c in cols}
    joined = spread_join(df, medians, [key], "left")
    return joined.withColumns(filled).drop(*[f"_median_{c}" for c in cols])


def time_split(
    df: DataFrame,
    train: float = 0.70,
    validation: float = 0.85,
    key: str = "symbol",
    time: str = "timestamp",
    min_rows: int = 0,
) -> DataFrame:
    """Add ``split``: oldest rows train, then validation, then test.

    Keys with fewer than ``min_rows`` rows are left out.
    """
    numbered = number_rows(df, key, time).where(F.col("_total") >= min_rows)
    total, row = F.col("_total").cast("double"), F.col("_row")
    part = (
        F.when(row <= F.floor(total * F.lit(train)), "train")
        .when(row <= F.floor(total * F.lit(validation)), "validation")
        .otherwise("test")
    )
    return numbered.withColumn("split", part).drop("_row", "_total")


def fit_scaler(
    train: DataFrame, cols: Sequence[str] = MODEL_INPUTS, key: str = "symbol"
) -> DataFrame:
    """Mean and sample deviation per key; a zero deviation is stored as 1."""
    stats = []
    for c in cols:
        spread = F.stddev_samp(c)
        stats.append(F.avg(c).alias(f"{c}__mean"))
        stats.append(F.when(spread == 0, F.lit(1.0)).otherwise(spread).alias(f"{c}__std"))
    return train.groupBy(key).agg(*stats)


def apply_scaler(
    df: DataFrame, params: DataFrame, cols: Sequence[str] = MODEL_INPUTS, key: str = "symbol"
) -> DataFrame:
    """Standardise columns by name; keys without parameters are left out."""
    names = [f"{c}__{part}" for c in cols for part in ("mean", "std")]
    scaled = {c: (F.col(c) - F.col(f"{c}__mean")) / F.col(f"{c}__std") for c in cols}
    joined = spread_join(df, params.select(key, *names), [key])
    return joined.withColumns(scaled).drop(*names)
