"""Joins whose large side may hold one very frequent key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def spread_join(
    large: DataFrame,
    small: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join ``small``, unique by ``keys``, to ``large`` without a hot partition.

    Rows of one key in ``large`` go to ``salts`` partitions by a hash of their
    values, so that filters above the join still reach the scan; each row of
    ``small``, of which a key has one, is sent to all of them. Where ``small`` is below the broadcast threshold Spark
    broadcasts it instead and nothing of ``large`` moves.
    """
    # maps have no hash
    plain = [f.name for f in large.schema if "map<" not in f.dataType.simpleString()]
    value = F.xxhash64(*[F.col(f"`{c}`") for c in plain])
    salted = large.withColumn("_salt", F.pmod(value, F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
