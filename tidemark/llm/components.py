"""Connected components of a graph that no machine holds whole.

Alternating large and small stars: every vertex hands its neighbours to the least
vertex it knows, until nothing changes. Each step groups and joins by vertex, and
is written to the shared folder.

Defined cases: self-links and repeated or reversed links change nothing; links with
a null end are left out; without links the result is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stage import store


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (least reachable id) of each end of a link.

    ``links`` has the columns ``a`` and ``b``.
    """
    edges = store(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .distinct(),
        "links",
    )
    before = None
    while True:
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first()
        if mark == before or not mark[0]:
            break
        before = mark
        edges = store(_small_star(_large_star(edges)), "links")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each vertex links its greater neighbours to its least neighbour or itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return (
        both.where("v > u")
        .join(least, F.col("u") == F.col("w"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Each vertex links itself and its lesser neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
    return (
        joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )
