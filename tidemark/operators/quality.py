"""Data-quality checks over time series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.indicators import lagged
from tidemark.operators.series import bucket_of, over_series
from tidemark.session import before, moment, seconds_between
from tidemark.sources.scans import since


def _recent(df: DataFrame, as_of, window: str, time: str, closed: bool = False) -> DataFrame:
    """Rows of the trailing window; tables stored by date are pruned."""
    return since(df, before(as_of, window), strict=not closed, time=time)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def stale(
    df: DataFrame,
    as_of,
    older_than: str = "30 minutes",
    key: str = "symbol",
    time: str = "timestamp",
) -> DataFrame:
    """Series whose newest row is older than the limit."""
    newest = df.groupBy(key).agg(F.max(time).alias("last_update"))
    return newest.where(F.col("last_update") < before(as_of, older_than))


def null_count(
    df: DataFrame, col: str, as_of, window: str = "1 hour", time: str = "timestamp"
) -> DataFrame:
    """One row: missing values of ``col`` in the trailing window."""
    recent = _recent(df, as_of, window, time)
    return recent.agg(F.count_if(F.col(col).isNull()).alias("null_count"))


def jumps(
    df: DataFrame,
    col: str,
    threshold: float,
    as_of,
    window: str,
    key: str = "symbol",
    time: str = "timestamp",
    closed: bool = False,
) -> DataFrame:
    """Rows whose value moved by more than ``threshold`` since the row before.

    The window is applied first, so its first row has no row before.
    """
    recent = _recent(df, as_of, window, time, closed).select(key, time, col)
    moved = over_series(
        recent,
        lambda w: {f"prev_{col}": lagged(col, 1, w)},
        back=1,
        key=key,
        time=time,
    )
    prev = F.col(f"prev_{col}")
    change = F.abs((F.col(col) - prev) / F.nullif(prev, F.lit(0.0)))
    return moved.withColumn("pct_change", change).where(F.col("pct_change") > threshold)


def jump_counts(
    df: DataFrame,
    col: str = "close",
    threshold: float = 0.10,
    as_of=None,
    window: str = "7 days",
    key: str = "symbol",
    time: str = "timestamp",
) -> DataFrame:
    """Number of jumps per series, for series that have any."""
    found = jumps(df, col, threshold, as_of, window, key, time, closed=True)
    return found.groupBy(key).agg(F.count(F.lit(1)).alias("outlier_count"))


def validate(
    df: DataFrame,
    as_of,
    col: str = "price_usd",
    stale_after: str = "30 minutes",
    null_window: str = "1 hour",
    jump_window: str = "2 hours",
    threshold: float = 0.5,
    key: str = "symbol",
    time: str = "timestamp",
) -> DataFrame:
    """One row: stale series, missing values and jumps, from one scan.

    Rows meet by series and day: a day gives its newest time, its missing values, the
    jumps inside it, and its first and last value, and days are then compared with
    the day before. So the scan is shuffled once, and no task holds a series.
    """
    recent = F.col(time) > before(as_of, jump_window)
    w = f"PARTITION BY `{key}`, _day ORDER BY `{time}`"
    rows = df.select(key, time, col, bucket_of(time).alias("_day"))
    rows = rows.withColumn("_value", F.when(recent, F.col(col))).withColumn(
        "_prev", F.expr(f"lag(_value) OVER ({w})")
    )
    jumped = F.abs((F.col("_value") - F.col("_prev")) / F.nullif("_prev", F.lit(0.0))) > threshold
    since = F.when(recent, F.col(time))
    days = rows.groupBy(key, "_day").agg(
        F.max(time).alias("_newest"),
        F.count_if(F.col(col).isNull() & (F.col(time) > before(as_of, null_window))).alias("_missing"),
        F.count_if(jumped).alias("_jumps"),
        F.min_by("_value", since).alias("_first"),
        F.max_by("_value", since).alias("_last"),
    )
    # a day without recent rows has no last value, and the days before it neither
    days = days.withColumn("_before", F.expr(f"lag(_last) OVER (PARTITION BY `{key}` ORDER BY _day)"))
    across = F.abs((F.col("_first") - F.col("_before")) / F.nullif("_before", F.lit(0.0))) > threshold
    series = days.groupBy(key).agg(
        F.max("_newest").alias("_newest"),
        F.sum("_missing").alias("_missing"),
        (F.sum("_jumps") + F.count_if(across)).alias("_jumps"),
    )
    return series.agg(
        F.count_if(F.col("_newest") < before(as_of, stale_after)).alias("stale_data_count"),
        F.coalesce(F.sum("_missing"), F.lit(0)).alias("null_price_count"),
        F.coalesce(F.sum("_jumps"), F.lit(0)).alias("outlier_count"),
    ).withColumn("validation_timestamp", moment(as_of))


def freshness(tables: Mapping[str, DataFrame], as_of, time: str = "timestamp") -> DataFrame:
    """Newest row of every table and its age in minutes."""
    parts = [
        df.agg(F.max(time).alias("last_update")).select(
            F.lit(name).alias("table_name"),
            "last_update",
            (seconds_between(F.col("last_update"), moment(as_of)) / 60.0).alias("minutes_old"),
        )
        for name, df in tables.items()
    ]
    return _union(parts)


def completeness(
    features: DataFrame,
    cols: Mapping[str, str],
    as_of,
    window: str = "7 days",
    key: str = "symbol",
    time: str = "timestamp",
) -> DataFrame:
    """Missing values per column and the percentage present, per series.

    ``cols`` maps output names to columns. NULL and NaN both count as missing.
    """

    def missing(c):
        gone = F.col(c).isNull()
        kind = features.schema[c].dataType.typeName()
        return gone | F.isnan(c) if kind in ("double", "float") else gone

    counted = (
        _recent(features, as_of, window, time, closed=True)
        .groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            *[F.count_if(missing(c)).alias(out) for out, c in cols.items()],
        )
    )
    gone = reduce(lambda a, b: a + b, [F.col(out) for out in cols])
    share = gone / (F.col("total_records") * F.lit(len(cols)))
    return counted.withColumn("completeness_pct", (F.lit(1.0) - share) * 100.0)


def record_counts(
    tables: Mapping[str, tuple[DataFrame, str]], as_of, window: str = "7 days"
) -> DataFrame:
    """One row with the recent row count of every (table, time column)."""
    parts = [
        _recent(df, as_of, window, time, closed=True)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("name"), "n")
        for name, (df, time) in tables.items()
    ]
    counts = [F.sum(F.when(F.col("name") == n, F.col("n"))).alias(f"{n}_count") for n in tables]
    return _union(parts).agg(*counts)


def coverage(df: DataFrame, key: str = "symbol", time: str = "timestamp") -> DataFrame:
    """Row count, first and last time and the span in days, per series."""
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("total_records"),
            F.min(time).alias("earliest"),
            F.max(time).alias("latest"),
        )
        .withColumn(
            "days_span", seconds_between(F.col("earliest"), F.col("latest")) / F.lit(86400.0)
        )
    )


def require_rows(df: DataFrame, n: int, by: str | None = None) -> DataFrame:
    """Row counts, overall or per ``by``, with whether they reach ``n``."""
    grouped = df.groupBy(by) if by else df
    counted = grouped.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.withColumn("enough", F.col("row_count") >= n)


class NotEnoughRows(ValueError):
    """A volume gate did not pass."""


def assert_enough(gate: DataFrame) -> None:
    """Raise unless there is a row and every row of a gate passes."""
    verdict = gate.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("enough")).alias("short")
    ).first()
    if verdict["n"] == 0 or verdict["short"]:
        raise NotEnoughRows(f"{verdict['short']} of {verdict['n']} groups are short of rows")


def status(value: Column, good: float, warn: float, below: bool = False) -> Column:
    """Three-way band: ``success``, ``warning`` or ``danger``.

    With ``below`` smaller values are better. Missing values are ``danger``.
    """
    first, second = (value < good, value < warn) if below else (value > good, value > warn)
    return F.when(first, "success").when(second, "warning").otherwise("danger")
