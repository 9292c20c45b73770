"""Mixing sources to target weights by Pfair scheduling.

Each source takes ``a`` of every ``q`` slots, both whole numbers: its weight and
the sum of all weights, without their common divisor and never rounded. Its block
``i`` (from 1) is released at ``floor((i - 1) q / a)`` and due at
``ceil(i q / a)``; every slot goes to the released block with the earliest deadline.
All shares together fill every slot, so no deadline is missed and after any number
of slots a source is less than one block from its weight. As this repeats after
``q`` slots, one period is scheduled, no further than the last deadline of the
corpus, and every block gets its slot by arithmetic and one join.

Scheduling takes ``q`` times the number of sources steps in one task; it goes in
stretches that hand on how many blocks each source has had. With the default weights
``q`` is the sum of the roots of the sources' sizes.

A source that runs out leaves its slots empty and the others keep their
proportions. No row is dropped or repeated.

Defined cases: a null source is a source of its own; null ids rank as an empty
text and equal rows take neighbouring places in either order; an empty table
gives an empty result. Columns named like the added ones are overwritten.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 4096
#: Slots that are scheduled before their list is put aside.
STRETCH = 1000
ADDED = ("block", "release", "deadline", "slot")


def shares(
    docs: DataFrame, weights: Mapping[str, int] | None = None, source: str = "source"
) -> DataFrame:
    """Slots ``a`` of each source in a period of ``q``; a row for each source.

    Without ``weights`` they are the square roots of the row counts, as whole
    numbers. A source without a weight, or with one below 1, has weight 1.
    """
    counts = docs.groupBy(F.col(source).alias("src")).agg(F.count("*").alias("n"))
    if weights is None:
        weight = F.round(F.sqrt("n")).cast("long")
    else:
        pairs = [F.lit(x) for pair in weights.items() for x in pair]
        table = F.create_map(*pairs) if pairs else F.expr("map('', 0L)")
        weight = F.coalesce(F.try_element_at(table, F.coalesce("src", F.lit(""))), F.lit(1))
        weight = weight.cast("long")
    whole = Window.partitionBy()  # a row for each source
    # Euclid: the larger of two numbers at least halves in two steps
    divisor = """
        aggregate(weights, 0L, (g, w) -> aggregate(
          sequence(1, 96), named_struct('x', w, 'y', g),
          (p, i) -> if(p.y = 0, p, named_struct('x', p.y, 'y', p.x % p.y))).x)
        """
    return (
        counts.withColumn("weight", F.greatest(F.lit(1).cast("long"), weight))
        .withColumn("weights", F.collect_set("weight").over(whole))
        .withColumn("a", F.expr(f"weight div ({divisor})"))
        .withColumn("q", F.sum("a").over(whole))
        .withColumn("place", F.row_number().over(whole.orderBy(F.col("src").asc_nulls_first())))
        .drop("weight", "weights")
    )


def timetable(shared: DataFrame, block_rows: int = 1) -> DataFrame:
    """One period: for the ``k``-th block of a source (from 0) its slot.

    Slots from the last deadline of the corpus on are left out.
    """
    last = F.expr(f"((n + {block_rows - 1}L) div {block_rows}L * q + a - 1L) div a")
    listed = shared.agg(
        F.array_sort(F.collect_list(F.struct("place", "a"))).alias("s"),
        F.max("q").alias("q"),
        F.least(F.max("q"), F.max(last)).alias("h"),
    ).where("q IS NOT NULL")
    # state: blocks placed so far by source, and the place chosen for each slot
    picked = listed.select(
        F.expr(
            f"""
            aggregate(
              sequence(0L, (h - 1L) div {STRETCH}L),
              named_struct(
                'got', transform(s, x -> 0L),
                'took', cast(array() AS array<array<int>>)),
              (done, c) -> transform(
                array(aggregate(
                  sequence(c * {STRETCH}L, least(h, (c + 1L) * {STRETCH}L) - 1L),
                  named_struct('got', done.got, 'took', cast(array() AS array<int>)),
                  (st, t) -> transform(
                    array(array_min(filter(
                      transform(s, (x, j) -> named_struct(
                        'due', ((st.got[j] + 1L) * q + x.a - 1L) div x.a,
                        'j', j,
                        'free', (st.got[j] * q) div x.a <= t)),
                      c -> c.free)).j),
                    w -> named_struct(
                      'got', transform(st.got, (g, j) -> if(j = w, g + 1L, g)),
                      'took', array_append(st.took, w)))[0])),
                r -> named_struct('got', r.got, 'took', array_append(done.took, r.took)))[0]
            ).took
            """
        ).alias("took")
    )
    slots = picked.select(F.posexplode("took").alias("stretch", "js")).select(
        "stretch", F.posexplode("js").alias("at", "j")
    )
    slots = slots.select("j", F.expr(f"stretch * {STRETCH}L + at").alias("slot_of"))
    order = Window.partitionBy("j").orderBy("slot_of")
    return slots.select(
        (F.col("j") + 1).alias("place"),
        (F.row_number().over(order) - 1).cast("long").alias("k"),
        "slot_of",
    )


def _placed(
    docs: DataFrame,
    weights: Mapping[str, int] | None,
    block_rows: int,
    source: str,
    doc_id: str,
) -> DataFrame:
    shared = shares(docs, weights, source)
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    parts = F.ceil(F.col("n") / BUCKET_ROWS).cast("long")
    head = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    same = F.col(source).eqNullSafe(F.col("src"))
    dealt = (
        docs.join(shared, same)
        .withColumn("digest", digest)
        .withColumn("part", F.shiftright(head * parts, 32))
    )
    sizes = (
        docs.select(source, doc_id)
        .join(shared, same)
        .groupBy("place", F.shiftright(head * parts, 32).alias("part"))
        .agg(F.count("*").alias("size"))
    )
    running = Window.partitionBy("place").orderBy("part")
    sizes = sizes.select(
        F.col("place").alias("b_place"),
        F.col("part").alias("b_part"),
        (F.sum("size").over(running) - F.col("size")).alias("before"),
    )
    inside = Window.partitionBy("place", "part").orderBy("digest", doc_id)
    ranked = dealt.withColumn("at", F.row_number().over(inside)).join(
        sizes, (F.col("place") == F.col("b_place")) & (F.col("part") == F.col("b_part"))
    )
    ranked = ranked.withColumn("block", F.expr(f"(before + at - 1) div {block_rows}L + 1"))
    ranked = ranked.withColumn("k", F.expr("(block - 1) % a"))
    table = timetable(shared, block_rows).withColumnRenamed("place", "t_place").withColumnRenamed("k", "t_k")
    placed = ranked.join(table, (F.col("place") == F.col("t_place")) & (F.col("k") == F.col("t_k")))
    return placed.select(
        *docs.columns,
        "block",
        F.expr("((block - 1) * q) div a").alias("release"),
        F.expr("(block * q + a - 1) div a").alias("deadline"),
        (F.expr("((block - 1) div a) * q") + F.col("slot_of")).alias("slot"),
    )


def mix(
    docs: DataFrame,
    weights: Mapping[str, int] | None = None,
    block_rows: int = 1,
    source: str = "source",
    doc_id: str = "doc_id",
) -> DataFrame:
    """``docs`` with block, release, deadline and slot of each row.

    Within a source rows follow the digest of their id. Places are counted in
    parts of about 4,096 rows with running totals over the parts, so that a
    source with a third of all rows is many small tasks.
    """
    names = [c for c in docs.columns if c not in ADDED]
    inner = {c: f"own{i}" for i, c in enumerate(names)}  # no clash with working columns
    plain = docs.select(*[F.col(f"`{c}`").alias(v) for c, v in inner.items()])
    placed = _placed(plain, weights, block_rows, inner[source], inner[doc_id])
    return placed.select(*[F.col(v).alias(c) for c, v in inner.items()], *ADDED)


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, in mixed order, with their own columns.

    Written out, the files and the rows inside them follow the slots. Columns
    named like the added ones keep their values.
    """
    inner = {c: f"row{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(v) for c, v in inner.items()])
    for role, default in (("source", "source"), ("doc_id", "doc_id")):
        options[role] = inner[options.get(role, default)]
    placed = mix(plain, **options)
    ordered = placed.repartitionByRange("slot", options["doc_id"]).sortWithinPartitions("slot")
    return ordered.select(*[F.col(v).alias(c) for c, v in inner.items()])
