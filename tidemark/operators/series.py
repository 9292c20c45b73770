"""Ordered work on long series, split so that no task holds a whole series.

A series is the rows of one key in time order. Its rows are counted per time
bucket, which gives a small table with one row per (key, bucket). Running counts
over that table place every bucket in the series, so rows can be

* numbered within their series (``number_rows``), and
* cut into chunks of about ``rows`` rows, each with the neighbouring rows a
  row-based frame needs (``chunk_series``).

Windows then run per (key, chunk). A key that holds a third of all rows is
spread over as many tasks as it has chunks, and results equal those of one
window per key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.indicators import add

CHUNK_ROWS = 1024
BUCKET = "1 day"
Stage = Callable[[str], Mapping[str, str]]


def bucket_of(time: str, bucket: str = BUCKET) -> Column:
    return F.window(F.col(time), bucket)["start"]


def bucket_counts(
    df: DataFrame,
    key: str = "symbol",
    time: str = "timestamp",
    bucket: str = BUCKET,
    carry: str | None = None,
) -> DataFrame:
    """One row per (key, bucket): rows in it, before it and in the series.

    With ``carry`` also the last known value of that column before the bucket.
    """
    aggs = [F.count(F.lit(1)).alias("_count")]
    if carry:
        known_at = F.when(F.col(carry).isNotNull(), F.col(time))
        aggs.append(F.max_by(carry, known_at).alias("_last"))
    counts = (
        df.withColumn("_bucket", bucket_of(time, bucket)).groupBy(key, "_bucket").agg(*aggs)
    )
    w = Window.partitionBy(key).orderBy("_bucket")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = {
        "_before": F.coalesce(F.sum("_count").over(earlier), F.lit(0)),
        "_total": F.sum("_count").over(whole),
    }
    if carry:
        placed["_carry"] = F.last("_last", ignorenulls=True).over(earlier)
    out = counts.withColumns(placed)
    return out.drop("_last") if carry else out


def number_rows(
    df: DataFrame,
    key: str = "symbol",
    time: str = "timestamp",
    bucket: str = BUCKET,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """Add ``_row`` (1-based, oldest first) and ``_total`` per series."""
    places = bucket_counts(df, key, time, bucket).drop("_count")
    w = Window.partitionBy(key, "_bucket").orderBy(time, *ties)
    return (
        df.withColumn("_bucket", bucket_of(time, bucket))
        .join(places, [key, "_bucket"])
        .withColumn("_row", F.col("_before") + F.row_number().over(w))
        .drop("_bucket", "_before")
    )


def tail_per_group(
    df: DataFrame,
    n: int,
    key: str = "symbol",
    time: str = "timestamp",
    bucket: str = BUCKET,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """The newest ``n`` rows of every series.

    Buckets wholly older than the tail are dropped by the join with the bucket
    table, before any row is sorted.
    """
    places = bucket_counts(df, key, time, bucket).withColumn(
        "_after", F.col("_total") - F.col("_before") - F.col("_count")
    )
    needed = places.where(F.col("_after") < n).select(key, "_bucket", "_after")
    newest = Window.partitionBy(key, "_bucket").orderBy(
        F.desc(time), *[F.desc(t) for t in ties]
    )
    return (
        df.withColumn("_bucket", bucket_of(time, bucket))
        .join(needed, [key, "_bucket"])
        .withColumn("_back", F.col("_after") + F.row_number().over(newest))
        .where(F.col("_back") <= n)
        .drop("_bucket", "_after", "_back")
    )


def chunk_series(
    df: DataFrame,
    back: int,
    ahead: int = 0,
    key: str = "symbol",
    time: str = "timestamp",
    rows: int = CHUNK_ROWS,
    bucket: str = BUCKET,
    carry: str | None = None,
    enrich: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Tag rows with the chunks that need them.

    Adds ``_chunk``, ``_core`` (true in the one chunk a row belongs to),
    ``_before`` (rows before the row's bucket), ``_total`` and, with ``carry``,
    ``_carry``. A bucket joins a later chunk if one of its rows is within
    ``back`` rows of that chunk's start, and an earlier one if within ``ahead``
    rows of its end. Every bucket has a row, so looking ``back`` buckets on and
    ``ahead`` buckets back finds all of them, gaps or not.
    """
    places = bucket_counts(df, key, time, bucket, carry)
    if enrich:
        places = enrich(places)
    w = f"PARTITION BY `{key}` ORDER BY _bucket"
    near = "collect_list(struct(_own AS own, _before AS start, _end AS stop))"
    places = add(
        places, {"_own": f"_before div {rows}", "_end": "_before + _count"}
    )
    frames, others = {}, []
    if back:
        frames["_following"] = f"{near} OVER ({w} ROWS BETWEEN 1 FOLLOWING AND {back} FOLLOWING)"
        others.append(f"transform(filter(_following, b -> b.start < _end + {back}), b -> b.own)")
    if ahead:
        frames["_preceding"] = f"{near} OVER ({w} ROWS BETWEEN {ahead} PRECEDING AND 1 PRECEDING)"
        others.append(f"transform(filter(_preceding, b -> b.stop + {ahead} > _before), b -> b.own)")
    chunks = f"array_distinct(concat({', '.join(['array(_own)', *others])}))"
    places = add(add(places, frames), {"_chunks": chunks}).drop(*frames, "_end", "_count")
    joined = df.withColumn("_bucket", bucket_of(time, bucket)).join(places, [key, "_bucket"])
    spread = add(joined, {"_chunk": "explode(_chunks)"})
    return add(spread, {"_core": "_chunk = _own"}).drop("_chunks", "_own", "_bucket")


def chunk_window(key: str = "symbol", time: str = "timestamp") -> str:
    """Window clause over one chunk, for use without a frame or with one added."""
    return f"PARTITION BY `{key}`, _chunk ORDER BY `{time}`"


def place_in_series(w: str) -> str:
    """1-based place of a row in its whole series, from inside its chunk.

    A chunk holds whole buckets, so its first row opens a bucket.
    """
    first = f"first(_before) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return f"{first} + row_number() OVER ({w})"


def over_series(
    df: DataFrame,
    *stages: Stage,
    back: int,
    ahead: int = 0,
    key: str = "symbol",
    time: str = "timestamp",
    rows: int = CHUNK_ROWS,
    bucket: str = BUCKET,
    carry: str | None = None,
) -> DataFrame:
    """Add window columns to every row of every series.

    Each stage maps the window clause to named SQL expressions and may use the
    columns of the stages before it. ``back`` and ``ahead`` are the rows that all stages
    together reach back and ahead. What was added under a name that starts with
    an underscore is dropped at the end; such columns of ``df`` stay.
    """
    w = chunk_window(key, time)
    out = chunk_series(df, back, ahead, key, time, rows, bucket, carry)
    for stage in stages:
        out = add(out, stage(w))
    out = out.where("_core")
    return out.drop(*[c for c in out.columns if c.startswith("_") and c not in df.columns])
