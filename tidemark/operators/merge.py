"""Merging new rows into a table by key, and conforming rows to a schema.

Key columns are the target's unique key, so no key has more than one stored
row. New rows are reduced to one per key first where they may repeat.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedupe_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` for every key.

    Copies of a key are reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def upsert(
    target: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Replace stored rows by new rows of the same key and add the others.

    With ``update_cols`` only those columns of a stored row change. ``new`` is
    unique by ``keys``.
    """
    if update_cols is None:
        return target.join(new.select(*keys), list(keys), "left_anti").unionByName(new)
    rest = [c for c in target.columns if c not in keys]
    stored = target.select(*keys, F.struct(*rest).alias("_old"))
    given = new.select(*keys, F.struct(*rest).alias("_new"))
    both = stored.join(given, list(keys), "full")

    def pick(c):
        old, now = F.col(f"_old.{c}"), F.col(f"_new.{c}")
        takes_new = F.col("_old").isNull()
        if c in update_cols:
            takes_new = takes_new | F.col("_new").isNotNull()
        return F.when(takes_new, now).otherwise(old).alias(c)

    return both.select(*keys, *[pick(c) for c in rest]).select(*target.columns)


def insert_new(target: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add new rows whose key is not stored yet."""
    return target.unionByName(new.join(target.select(*keys), list(keys), "left_anti"))


def _casts(df: DataFrame, schema: T.StructType):
    present = set(df.columns)
    for field in schema:
        source = F.col(field.name) if field.name in present else F.lit(None)
        yield field, source, source.try_cast(field.dataType)


def split_valid(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, cast to it, and rows that do not.

    A row is rejected if a value does not survive its cast or a required column
    is missing. Rejected rows keep their values and name the columns in
    ``rejected_columns``.
    """
    marks, cast = [], []
    for field, source, value in _casts(df, schema):
        bad = source.isNotNull() & value.isNull()
        if not field.nullable:
            bad = bad | source.isNull()
        marks.append(F.when(bad, F.lit(field.name)))
        cast.append(value.alias(field.name))
    checked = df.withColumn("rejected_columns", F.array_compact(F.array(*marks)))
    good = checked.where(F.size("rejected_columns") == 0).select(*cast)
    return good, checked.where(F.size("rejected_columns") > 0)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All rows as the declared columns and types; unfit values become NULL."""
    return df.select(*[value.alias(field.name) for field, _, value in _casts(df, schema)])


def check_rows(
    df: DataFrame, schema: T.StructType, keys: Sequence[str] = (), order: Sequence[str] = ()
) -> DataFrame:
    """Rows as the declared columns and types, with the rules that each one breaks.

    ``violations`` lists, in one pass over the rows: ``required(c)`` where a
    required column is missing, ``type(c)`` where a value does not survive its
    cast (a decimal too large for its digits included), and ``unique(keys)`` on
    every row of a key but the first by ``order``. A key with a null equals no other.
    Unfit values become NULL. ``order`` names columns of ``df``.
    """
    marks, cast = [], []
    for field, source, value in _casts(df, schema):
        marks.append(F.when(source.isNotNull() & value.isNull(), F.lit(f"type({field.name})")))
        if not field.nullable:
            marks.append(F.when(source.isNull(), F.lit(f"required({field.name})")))
        cast.append(value.alias(field.name))
    place = [F.col(c).alias(f"_order{i}") for i, c in enumerate(order)]
    out = df.select(*cast, *place, F.array_compact(F.array(*marks)).alias("violations"))
    if keys:
        whole = F.lit(True)
        for c in keys:
            whole = whole & F.col(c).isNotNull()
        # rows without a whole key need no company, so they are dealt out
        lone = F.when(~whole, F.monotonically_increasing_id())
        w = Window.partitionBy(*keys, "_lone").orderBy(*([f"_order{i}" for i in range(len(order))] or list(keys)))
        out = out.withColumn("_lone", lone).withColumn("_place", F.row_number().over(w))
        repeated = F.when(F.col("_place") > 1, F.array(F.lit(f"unique({','.join(keys)})")))
        out = out.withColumn("violations", F.concat("violations", F.coalesce(repeated, F.array())))
    return out.select(*schema.names, "violations")


def good_rows(checked: DataFrame) -> DataFrame:
    """Rows of ``check_rows`` that break no rule."""
    return checked.where(F.size("violations") == 0).drop("violations")


def violations(checked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row for each broken rule: the row's key and ``rule``."""
    return checked.select(*keys, F.explode("violations").alias("rule"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys stored more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where(F.col("copies") > 1)
