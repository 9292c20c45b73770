"""Near-duplicate documents through an LSH forest over MinHash signatures.

Each tree of the forest is one order of the documents by a signature of its own:
documents that agree on a longer prefix stand closer together. Candidates are the
neighbours with the longest common prefix in each tree. How deep a prefix bounds a
region depends on how many documents share it, so a region stays small; what not
even the full depth can part is cut into blocks, each tied to the region's first
document. Candidates whose signatures agree too little are dropped by an estimate
more than four deviations below the threshold; the rest is confirmed on full
shingle sets, built where both texts of a pair meet. Documents with equal sets form a
class that is compared once.

Candidates inside a component that earlier links have joined already are not
compared again, as they cannot change it.

The forest joins most of what belongs together; a set-similarity join over all
classes finds the rest, so that no result depends on windows, regions or blocks.
Classes that are alike enough share a shingle among the first quarter of each, in an
order that is the same for all (prefix filter). Shingles go from rare to common by a
sample; the sample bears on the cost alone. Lists of a shingle whose classes are one
component are done: a first pass over (shingle, component) alone finds the others and
marks them in a bitmap of fixed size, so that only what it lets pass travels with its
place, size and class. In these lists each class meets the most linked class of the list,
then whatever is still in another component and passes the length and positional
filters; of these pairs, those whose signatures agree so little that a link is out of
the question (a chance near 1e-12) are not compared in full. The lists of common shingles are dealt to as many tasks as they need.

Defined cases: null, empty and blank texts have no shingles and link with nothing;
a text of fewer than five words is one shingle; a row with a null id gets its size
and a null component; rows of one id share its component. Texts of any length are
hashed piece by piece. An empty table gives an empty result. Only the named
columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.stage import discard, store
from tidemark.llm.text import shingle_set

TREES, DEPTH, WINDOW = 16, 8, 8
HASHES = TREES * DEPTH
LEAST_AGREEING = 74  # of 128; a pair at 0.75 falls below with a chance near 1e-5
SURE = 108  # of 128; almost certainly alike
REGION = 4096
DEPTHS = (2, 4, DEPTH)  # prefixes that bound a region, as it grows
WORDS, PERCENT = 5, 75
SLOTS, SHINGLE_SLOTS = 1 << 23, 1 << 25  # bits of the two bitmaps
EVER = 56  # of 128; a pair at 0.75 falls below with a chance near 1e-12
EVERY, COMMON = 8, 2  # one text in so many has its shingles counted, and counts that matter
MOST_COMMON = 1 << 20  # shingles whose counts are handed to all tasks
LIST = 4096  # members of a shingle's list that one task meets with all others

_MULTIPLIERS = (
    np.random.default_rng(20).integers(0, 2**32, HASHES, np.uint64).astype(np.uint32) | np.uint32(1)
)
_ADDENDS = np.random.default_rng(21).integers(0, 2**32, HASHES, np.uint64).astype(np.uint32)


def signature(shingles: np.ndarray, piece: int = 1024) -> np.ndarray:
    """Least of each of the hash functions over the shingles."""
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    whole = np.empty((HASHES, min(piece, len(short))), np.uint32)
    for at in range(0, len(short), piece):
        part = short[at : at + piece]
        hashed = np.multiply(_MULTIPLIERS[:, None], part[None, :], out=whole[:, : len(part)])
        hashed += _ADDENDS[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    return least


def signed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Set size, digest of the set and signature of each document.

    ``sig`` holds the labels of the trees one after another, the low 16 bits of each
    hash in the byte order in which they sort; ``brief`` the low 8 bits, for estimates.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, sigs, briefs = [], [], [], []
            for value in batch.column(1).cast(pa.large_binary()):
                found = shingle_set(value.as_py() or b"", WORDS)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest())
                least = signature(found) if len(found) else np.zeros(0, np.uint32)
                sigs.append(least.astype(np.uint16).astype(">u2").tobytes())
                briefs.append(least.astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sigs, pa.binary()),
                    pa.array(briefs, pa.binary()),
                ],
                ["doc_id", "n_shingles", "digest", "sig", "brief"],
            )

    return docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text").mapInArrow(
        run, f"doc_id {kind}, n_shingles bigint, digest binary, sig binary, brief binary"
    )


def _counted(rows: DataFrame, prefix: Column) -> DataFrame:
    """``rows`` that share a prefix in their tree with others, with its size."""
    counts = (
        rows.groupBy(F.col("tree").alias("t"), prefix.alias("p"))
        .agg(F.count("*").alias("size"), F.min("rep").alias("first"))
        .where("size > 1")
    )
    held = rows.join(counts, (F.col("tree") == F.col("t")) & (prefix == F.col("p")))
    return held.drop("t").withColumnRenamed("p", "region")


def _regions(classes: DataFrame) -> DataFrame:
    """A row for each document and tree in which it has company, with its region.

    Most documents are alone with even the first hashes of a tree, so labels and what
    estimates need are fetched only for those that are not.
    """
    label = F.expr(f"substring(sig, tree * {2 * DEPTH} + 1, {2 * DEPTH})")
    trees = classes.select(
        "rep", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    )
    alone = trees.select("tree", "rep", F.substring(label, 1, 2 * DEPTHS[0]).alias("start"))
    held = _counted(alone, F.col("start")).drop("start")
    signatures = classes.select(F.col("rep").alias("own"), "sig", "brief")
    held = held.join(signatures, F.col("rep") == F.col("own")).withColumn("label", label)
    held = held.drop("own", "sig")
    whole = held.where(F.col("size") <= REGION)
    for depth in DEPTHS[1:]:
        rest = held.where(F.col("size") > REGION).drop("size", "first", "region")
        held = _counted(rest, F.substring("label", 1, 2 * depth))
        done = held if depth == DEPTHS[-1] else held.where(F.col("size") <= REGION)
        whole = whole.unionByName(done)
    block = F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / REGION).cast("long"))
    return whole.select(
        "tree", "region", block.alias("block"), "label", "rep", "brief", "size", "first"
    )


def candidates(classes: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` with their agreement, from neighbours in all trees."""
    ordered = (
        _regions(classes)
        .repartition("tree", "region", "block")
        .sortWithinPartitions("tree", "region", "block", "label", "rep")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        for batch in batches:
            if not len(batch):
                continue
            tree = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            block = batch.column(2).to_numpy(zero_copy_only=False)
            region = batch.column(1).to_pylist()
            change = np.array([x != y for x, y in zip(region[1:], region, strict=False)], bool)
            change |= (tree[1:] != tree[:-1]) | (block[1:] != block[:-1])
            group = np.concatenate([[0], np.cumsum(change)])
            rep = batch.column(4).to_numpy(zero_copy_only=False)
            sig = np.frombuffer(b"".join(batch.column(5).to_pylist()), np.uint8).reshape(-1, HASHES)
            mark = (int(tree[0]), region[0], int(block[0]))
            last = (int(tree[-1]), region[-1], int(block[-1]))
            fresh = 0
            if before and before[0] == mark:  # the end of the last batch belongs here too
                fresh = len(before[1])
                rep = np.concatenate([before[1], rep])
                sig = np.concatenate([before[2], sig])
                group = np.concatenate([np.zeros(fresh, group.dtype), group])
            found = []
            for step in range(1, WINDOW + 1):
                near = np.flatnonzero(group[step:] == group[:-step])
                near = near[near + step >= fresh]
                for at in range(0, len(near), 8192):
                    i = near[at : at + 8192]
                    agree = (sig[i] == sig[i + step]).sum(axis=1)
                    keep = agree >= LEAST_AGREEING
                    a, b = rep[i[keep]], rep[i[keep] + step]
                    found.append(np.stack([np.minimum(a, b), np.maximum(a, b), agree[keep]]))
            # blocks of a region that no depth parts hang together by its first document
            size, first = (batch.column(k).to_numpy(zero_copy_only=False) for k in (6, 7))
            own = rep[fresh:]
            tied = (size > REGION) & (own != first)
            a, b = own[tied], first[tied]
            found.append(np.stack([np.minimum(a, b), np.maximum(a, b), np.full(len(a), HASHES)]))
            tail = np.flatnonzero(group == group[-1])[-WINDOW:]
            before = (last, rep[tail], sig[tail])
            pairs = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x.astype(np.int64)) for x in pairs], ["a", "b", "agree"]
            )

    near = ordered.mapInArrow(run, "a bigint, b bigint, agree bigint")
    return near.groupBy("a", "b").agg(F.max("agree").alias("agree"))


def _slot(name: str) -> Column:
    return F.xxhash64(name).bitwiseAND(F.lit(SLOTS - 1)).alias("slot")


def _bitmap(slots: DataFrame, size: int) -> np.ndarray:
    """The slots in use, 64 to a number: ``size`` bits, however many there are."""
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(size // 64, np.int64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets are alike enough.

    ``docs`` has ``rep`` and ``text``. Only texts travel whose id passes a bitmap of the
    hashes of all ids in pairs; the joins leave out those that pass by chance. Texts
    shrink on their way, which sets of hashes do not, so sets are built at the end of it.
    """
    ends = [pairs.select(F.col(side).alias("need")).distinct() for side in ("a", "b")]
    needed = _bitmap(ends[0].unionByName(ends[1]).select(_slot("need")), SLOTS)
    bits = docs.sparkSession.sparkContext.broadcast(needed)

    def wanted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(2).to_numpy(zero_copy_only=False)
            here = pa.array((bits.value[slot >> 6] >> (slot & 63)) & 1 == 1)
            yield batch.select(["rep", "text"]).filter(here)

    texts = (
        docs.where("rep IS NOT NULL")
        .select(F.col("rep").cast("long"), F.col("text").cast("binary"), _slot("rep"))
        .mapInArrow(wanted, "rep bigint, text binary")
    )
    met = (
        pairs.select("a", "b")
        .join(texts.select(F.col("rep").alias("ra"), F.col("text").alias("ta")), F.col("a") == F.col("ra"))
        .join(texts.select(F.col("rep").alias("rb"), F.col("text").alias("tb")), F.col("b") == F.col("rb"))
        .select("a", "b", "ta", "tb")
    )

    def check(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list[tuple[bytes, np.ndarray]] = [(b"", shingle_set(b"", WORDS))] * 2

        def built(side: int, value: pa.Scalar) -> np.ndarray:
            text = value.as_py() or b""
            if text != last[side][0]:  # the join leaves rows of one end together
                last[side] = (text, shingle_set(text, WORDS))
            return last[side][1]

        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x, y = built(0, left), built(1, right)
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(check, "a bigint, b bigint")


def _common(texts: DataFrame) -> np.ndarray:
    """Shingles that several sampled texts hold, and how many, in the order of shingles."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0).cast(pa.large_binary()):
                found = shingle_set(value.as_py() or b"", WORDS)
                for at in range(0, len(found), 65536):
                    part = found[at : at + 65536].view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(part)], ["shingle"])

    sampled = texts.where(F.pmod(F.xxhash64("rep", F.lit(7)), F.lit(EVERY)) == 0)
    counted = (
        sampled.select("text")
        .mapInArrow(run, "shingle bigint")
        .groupBy("shingle")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= COMMON)
        .orderBy(F.desc("n"), "shingle")
        .limit(MOST_COMMON)
    ).toArrow()
    found = np.stack([counted["shingle"].to_numpy(), counted["n"].to_numpy()])
    return found[:, np.argsort(found[0])]


def prefixes(texts: DataFrame, common: Broadcast, moved: Broadcast) -> DataFrame:
    """Set size of each text and the shingles that the prefix filter asks for.

    ``told`` where the bitmap of moved ids holds ``rep``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts = common.value
        for batch in batches:
            sizes, firsts = [], [np.zeros(0, np.int64)]
            for value in batch.column(1).cast(pa.large_binary()):
                found = shingle_set(value.as_py() or b"", WORDS).view(np.int64)
                level = np.zeros(len(found), np.int64)
                if len(names) and len(found):
                    at = np.minimum(np.searchsorted(names, found), len(names) - 1)
                    level = np.where(names[at] == found, counts[at], 0)
                least = -(-PERCENT * len(found) // 100)
                # the set is sorted, so only what is common moves
                first = found[np.argsort(level, kind="stable")[: len(found) - least + 1]]
                sizes.append(len(found))
                firsts.append(first if len(found) else found)
            ends = np.cumsum([len(x) for x in firsts]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(firsts)))
            slot = batch.column(2).to_numpy(zero_copy_only=False)
            told = pa.array((moved.value[slot >> 6] >> (slot & 63)) & 1 == 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), lists, told],
                ["rep", "n", "first", "told"],
            )

    named = texts.select(F.col("rep").cast("long").alias("rep"), "text")
    return named.select("rep", "text", _slot("rep")).mapInArrow(
        run, "rep bigint, n bigint, first array<bigint>, told boolean"
    )


def _passing(firsts: DataFrame, marked: Broadcast) -> DataFrame:
    """What the bitmap lets pass of each list, with its place in the whole list."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            size = lists.value_lengths().to_numpy(zero_copy_only=False)
            shingle = lists.flatten().to_numpy()
            place = (np.arange(len(shingle)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
            slot = shingle & (SHINGLE_SLOTS - 1)
            here = (marked.value[slot >> 6] >> (slot & 63)) & 1 == 1
            before = np.concatenate([[0], np.cumsum(here)])
            ends = pa.array(before[np.concatenate([[0], np.cumsum(size)])].astype(np.int32))
            kept = [pa.ListArray.from_arrays(ends, pa.array(x[here])) for x in (shingle, place)]
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *kept, batch.column(3)],
                ["rep", "n", "first", "place", "told"],
            )
            yield out.filter(pa.array(np.diff(ends.to_numpy()) > 0))

    return firsts.select("rep", "n", "first", "told").mapInArrow(
        run, "rep bigint, n bigint, first array<bigint>, place array<int>, told boolean"
    )


def _placed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` of classes with their component and number of links.

    Where ``rows`` say so, only those travel that a bitmap has ``told``; each of the others
    is a class that stands alone.
    """
    if "told" not in rows.columns:
        return rows.join(parts, F.col("rep") == F.col("own")).drop("own")
    met = rows.where("told").join(parts, F.col("rep") == F.col("own")).drop("own")
    alone = rows.where("NOT told")
    alone = alone.withColumns({"part": F.col("rep"), "degree": F.lit(0).cast("long")})
    return met.unionByName(alone).drop("told")


def _plausible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose signatures agree often enough for anything near the threshold."""
    briefs = classes.select(F.col("rep").alias("own"), "brief")
    met = (
        pairs.join(briefs.select(F.col("own").alias("ra"), F.col("brief").alias("sa")), F.col("a") == F.col("ra"))
        .join(briefs.select(F.col("own").alias("rb"), F.col("brief").alias("sb")), F.col("b") == F.col("rb"))
        .select("a", "b", "sa", "sb")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, HASHES)
                for k in (2, 3)
            )
            keep = (x == y).sum(axis=1) >= EVER
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return met.mapInArrow(run, "a bigint, b bigint")


def _marked(firsts: DataFrame, parts: DataFrame) -> np.ndarray:
    """Bitmap of the shingles that several components hold among their first."""
    several = (
        _placed(firsts, parts).select("part", F.explode("first").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("part").alias("p"), F.max("part").alias("q"))
        .where("p <> q")
    )
    slot = F.col("shingle").bitwiseAND(F.lit(SHINGLE_SLOTS - 1)).alias("slot")
    return _bitmap(several.select(slot), SHINGLE_SLOTS)


def _open(posts: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of shingles whose lists hold several components, with the list's size
    and its most linked class."""
    placed = _placed(posts, parts)
    if "first" in posts.columns:
        placed = placed.select(
            "rep", "n", "part", "degree", F.explode(F.arrays_zip("first", "place")).alias("x")
        ).select("rep", "n", "part", "degree", F.col("x.first").alias("shingle"), F.col("x.place").alias("at"))
    lists = (
        placed.groupBy(F.col("shingle").alias("s"))
        .agg(
            F.count("*").alias("size"),
            F.min("part").alias("p"),
            F.max("part").alias("q"),
            F.max(F.struct("degree", (-F.col("rep")).alias("back"), "n")).alias("hub"),
        )
        .where("p <> q")
        .select("s", "size", (-F.col("hub.back")).alias("hub"), F.col("hub.n").alias("hub_n"))
    )
    return placed.join(lists, F.col("shingle") == F.col("s")).drop("s")


def _parts(reps: DataFrame, links: DataFrame, grouped: DataFrame) -> DataFrame:
    """Component and number of links of each class."""
    degrees = links.select(F.explode(F.array("a", "b")).alias("e")).groupBy("e").count()
    return (
        reps.join(grouped, F.col("own") == F.col("id"), "left")
        .join(degrees, F.col("own") == F.col("e"), "left")
        .select(
            "own",
            F.coalesce("component", "own").alias("part"),
            F.coalesce("count", F.lit(0)).alias("degree"),
        )
    )


def _with_hubs(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs of each class and the most linked class of its lists."""
    pairs = (
        rows.where("hub <> rep")
        .where(f"100 * least(n, hub_n) >= {PERCENT} * greatest(n, hub_n)")
        .select("rep", "part", "hub")
        .distinct()
        .join(parts.select("own", F.col("part").alias("theirs")), F.col("hub") == F.col("own"))
        .where("part <> theirs")
    )
    return pairs.select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()


def _across(rows: DataFrame) -> DataFrame:
    """Pairs from different components that the prefix filters let pass."""
    tasks = F.ceil(F.col("size") / LIST).cast("int")
    left = rows.select(
        "shingle", "rep", "n", "at", "part", F.pmod(F.hash("rep"), tasks).alias("task")
    )
    right = rows.select(
        F.col("shingle").alias("shingle2"),
        F.col("rep").alias("rep2"),
        F.col("n").alias("n2"),
        F.col("at").alias("at2"),
        F.col("part").alias("part2"),
        F.explode(F.sequence(F.lit(0), tasks - 1)).alias("task2"),
    )
    return (
        left.join(
            right,
            (F.col("shingle") == F.col("shingle2"))
            & (F.col("task") == F.col("task2"))
            & (F.col("rep") < F.col("rep2"))
            & (F.col("part") != F.col("part2"))
            & F.expr(f"100 * least(n, n2) >= {PERCENT} * greatest(n, n2)")
            & F.expr(f"least(n - at, n2 - at2) * {100 + PERCENT} >= {PERCENT} * (n + n2)"),
        )
        .select(F.col("rep").alias("a"), F.col("rep2").alias("b"))
        .distinct()
    )


def _completed(
    classes: DataFrame,
    texts: DataFrame,
    links: DataFrame,
    grouped: DataFrame,
    met: DataFrame,
    copies: DataFrame,
) -> DataFrame:
    """Components after the links that the forest missed; ``met`` was compared before.

    ``copies`` are the ids of texts whose class another id stands for.
    """
    share = classes.sparkSession.sparkContext.broadcast
    reps = classes.select(F.col("rep").alias("own")).distinct()
    known = texts.where("rep IS NOT NULL")
    parts = store(_parts(reps, links, grouped), "parts")
    # texts that have no class of their own, and classes that do not stand alone
    moved = grouped.select(F.col("id").cast("long").alias("id")).unionByName(copies)
    moved = share(_bitmap(moved.select(_slot("id")), SLOTS))
    firsts = store(prefixes(known, share(_common(known)), moved), "firsts")
    rows = store(_open(_passing(firsts, share(_marked(firsts, parts))), parts), "open")
    discard(firsts)
    for step in (_with_hubs, None):
        pairs = (step(rows, parts) if step else _across(rows)).join(met, ["a", "b"], "left_anti")
        pairs = store(_plausible(pairs, classes), "pairs")
        if pairs.take(1):
            links = store(links.unionByName(confirmed(pairs, texts)), "links")
            grouped = store(components(links), "grouped")
            if step:
                met = met.unionByName(pairs)
                parts = store(_parts(reps, links, grouped), "parts")
                before, kept = rows, ["rep", "n", "at", "shingle"]
                rows = store(_open(rows.select(*kept), parts), "open")
                discard(before)
    discard(rows)
    return grouped


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Set size, component and whether it stays, for every row of ``docs``."""
    rows = store(signed(docs), "signed")
    classes = store(
        rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("brief").alias("brief")),
        "classes",
    )
    pairs = store(candidates(classes), "pairs")
    texts = docs.select(F.col("doc_id").alias("rep"), "text")
    # first one neighbour of each document, which joins most of a group: the earliest of
    # those that are surely alike, else the closest
    both = pairs.select("a", "b", "agree", F.explode(F.array("a", "b")).alias("end"))
    other = F.when(F.col("end") == F.col("a"), F.col("b")).otherwise(F.col("a"))
    sure = F.col("agree") >= SURE
    rank = F.struct(sure, F.when(sure, F.lit(0)).otherwise(F.col("agree")), -other)
    best = both.groupBy("end").agg(F.max_by(F.struct("a", "b"), rank).alias("p"))
    chosen = store(best.select("p.a", "p.b").distinct(), "chosen")
    links = store(confirmed(chosen, texts), "links")
    grouped = store(components(links), "grouped")
    # then what may still join two groups
    of_a = grouped.select(F.col("id").alias("ia"), F.col("component").alias("ca"))
    of_b = grouped.select(F.col("id").alias("ib"), F.col("component").alias("cb"))
    open_pairs = (
        pairs.select("a", "b")
        .join(of_a, F.col("a") == F.col("ia"), "left")
        .join(of_b, F.col("b") == F.col("ib"), "left")
        .where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
        .select("a", "b")
        .join(chosen, ["a", "b"], "left_anti")
    )
    open_pairs = store(open_pairs, "open")
    if open_pairs.take(1):
        links = store(links.unionByName(confirmed(open_pairs, texts)), "links")
        grouped = store(components(links), "grouped")
    copies = (
        rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .join(classes.select("digest", "rep"), "digest")
        .where("doc_id <> rep")
        .select(F.col("doc_id").cast("long").alias("id"))
    )
    grouped = _completed(classes, texts, links, grouped, pairs.select("a", "b"), copies)
    discard(pairs, chosen, open_pairs)
    members = classes.select(F.col("digest").alias("d"), "rep")
    placed = rows.select("doc_id", "n_shingles", "digest").join(
        members, (F.col("digest") == F.col("d")) & F.col("doc_id").isNotNull(), "left"
    )
    return (
        placed.join(grouped, F.col("rep") == F.col("id"), "left")
        .select(
            "doc_id",
            "n_shingles",
            F.coalesce("component", "rep", "doc_id").cast("long").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id") == F.col("component_id"))
    )
