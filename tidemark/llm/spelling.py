"""Spelling variants: words one edit apart, found by a frontier in a distributed trie.

Words lie in two tries, one over their code points and one over the reversed
words. States (word, position, node, edits) start at the node of a word's first half
without edits and go down level by level: each level is one join of the
frontier with that level's edges. A state without edits takes the edge of the next
code point, or spends its edit on a greater edge, or on any edge without moving on
(one less is one more of the other word); a state with its edit spent takes the one
edge that fits. A path that ends is a link of both words.
An edit lies in a word's second half or, read backwards, in the second half of
the reversed word, so starting at the halves loses nothing and keeps the frontier
away from the crowded top.

An edge to a node with a single word below it names that word, and a state
that takes it ends there as a candidate; candidates are confirmed by their edit
distance. So the frontier lives only as deep as words share their beginnings.
Once its edit is spent, the rest of what a state looks for is known, and an edge
tells by bits which lengths, ends and next code points lie below it: a state
takes an edge only if what it looks for may be there.

Words of ``LONG`` code points or more, whose tries would be as deep as they are
long, meet by the hashes of all their one-deletion forms instead and are confirmed
in the same way; words of exactly ``LONG - 1`` take part in both.

Defined cases: null and empty texts have no words; a null id counts as an empty
one; repeated rows count each; other columns are ignored. An empty table, or one
without frequent words, gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stage import store

RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LONG = 48


def counted_words(
    docs: DataFrame, least_length: int = 7, least_count: int = 2, typo_every: int = 31
) -> DataFrame:
    """``word`` and ``n`` of the runs of letters in ``docs``, A-Z lowered.

    A run whose crc32 with its document's id is divisible by ``typo_every`` loses
    one code point.
    """
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        # a shorter run cannot become a word
        F.explode(F.regexp_extract_all("text", F.lit(f"{RUN}{{{least_length},}}"), F.lit(0))).alias("run"),
    )
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    typo = F.expr("concat(substr(run, 1, int(h % length(run))), substr(run, int(h % length(run)) + 2))")
    words = runs.select(F.when(F.col("h") % typo_every == 0, typo).otherwise(F.col("run")).alias("word"))
    return (
        words.where(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= least_count)
    )


def _both_ways(words: DataFrame) -> DataFrame:
    """``w`` and its reverse with a number, and the depth at which its search starts."""
    size = F.length("word")
    ahead = words.select(
        F.lit(False).alias("back"), F.col("word").alias("w"), F.floor(size / 2).cast("int").alias("h")
    )
    back = words.select(F.lit(True), F.reverse("word"), F.ceil(size / 2).cast("int"))
    return ahead.unionAll(back.toDF("back", "w", "h")).withColumn("id", F.monotonically_increasing_id())


def _sign(size, word):
    """A number below 256 of a word's length and last two code points."""
    return F.pmod(F.xxhash64(size, F.right(word, F.lit(2))), F.lit(256)).cast("int")


def _edges(sides: DataFrame) -> DataFrame:
    """One row for each node with several words below: its edges.

    ``depth``, ``back``, ``node``; ``edges``: code point, number of words below,
    the least of their ids, and what these words look like in bits: ``nx`` of the code
    points after the edge, ``signs`` of lengths and last two code points. A word's
    end is the edge of the empty string. Nodes lie no higher than a neighbour's
    search can start.
    """
    size = F.length("w")
    top = F.when(F.col("back"), F.floor(size / 2)).otherwise(F.floor((size - 1) / 2)).cast("int")
    steps = sides.select(
        "back", "w", "id", _sign(size, F.col("w")).alias("sign"), F.explode(F.sequence(top, size)).alias("depth")
    ).select(
        "back",
        "depth",
        F.expr("left(w, depth)").alias("node"),
        F.expr("substr(w, depth + 1, 1)").alias("c"),
        "id",
        F.expr("shiftleft(1L, ascii(substr(w, depth + 2, 1)) % 64)").alias("nx"),
        *[F.expr(f"IF(sign DIV 64 = {i}, shiftleft(1L, sign % 64), 0L)").alias(f"s{i}") for i in range(4)],
    )
    edges = steps.groupBy("back", "depth", "node", "c").agg(
        F.count("*").alias("below"),
        F.min("id").alias("one"),
        *[F.bit_or(x).alias(x) for x in ("nx", "s0", "s1", "s2", "s3")],
    )
    entry = F.struct("c", "below", "one", "nx", F.array("s0", "s1", "s2", "s3").alias("signs"))
    return (
        edges.groupBy("back", "depth", "node")
        .agg(F.sum("below").alias("all"), F.collect_list(entry).alias("edges"))
        .where("all > 1")
        .drop("all")
    )


def _advance(states: DataFrame, edges: DataFrame) -> DataFrame:
    """All states one level down from ``states``; ``found`` where a path ends.

    ``pos``: code points of the word that are used up; ``sign``: of the word that a
    state with its edit spent leads to, null where its last two code points are
    not those of ``w``. An edge is not taken where no word below it looks like that.

    Of two near words of one length the one with the lesser code point looks for
    the other, else the shorter one for the longer.
    """
    size = F.length("w")

    def sign_of(change: int):
        """Sign of what an edit at ``pos`` leads to, if two code points follow it."""
        after = size - F.col("pos") - (1 - change)
        return F.when(after >= 2, _sign(size + change, F.col("w")))

    letters = [F.expr(f"substr(w, pos + {i}, 1)").alias(f"c{i}") for i in (1, 2)]
    signs = {"own": F.col("sign"), "same": sign_of(0), "more": sign_of(1)}
    met = states.select(
        "back", "w", "pos", "node", (F.col("edits") == 1).alias("spent"), *letters, *[v.alias(k) for k, v in signs.items()]
    )
    bits = {f"{k}_bit": f"IF({k} IS NULL, 0L, shiftleft(1L, {k} % 64))" for k in signs}
    bits |= {f"{k}_at": f"coalesce({k} DIV 64, 0)" for k in signs}
    bits |= {f"next{i}": f"shiftleft(1L, ascii(c{i}) % 64)" for i in (1, 2)}
    met = met.withColumns({k: F.expr(v) for k, v in bits.items()}).join(edges, ["back", "node"])
    met = met.select(
        "back", "w", "pos", "spent", "node", "c1", *signs, *bits,
        # with the edit spent no other edge can fit
        F.expr("inline(IF(spent, filter(edges, e -> e.c = c1), edges))").alias("c", "below", "one", "nx", "signs"),
    )

    def seen(k: str, i: int) -> str:
        """Whether a word below goes on with the code point i and has this sign."""
        return f"(nx & next{i}) <> 0 AND ({k}_bit = 0 OR (signs[{k}_at] & {k}_bit) <> 0)"

    ways = [
        # the edge of the next code point, before and after the edit
        ("NOT spent AND c = c1 AND c <> ''", 1, 0, "own"),
        (f"spent AND c <> '' AND {seen('own', 2)}", 1, 1, "own"),
        # another code point; one more, put behind its equals
        (f"NOT spent AND c > c1 AND c1 <> '' AND {seen('same', 2)}", 1, 1, "same"),
        (f"NOT spent AND c <> c1 AND c <> '' AND {seen('more', 1)}", 0, 1, "more"),
        # both end here
        ("spent AND c = ''", 0, 1, "own"),
    ]
    taken = [
        f"IF({on}, struct(pos + {by} AS pos, {edits} AS edits, {sign} AS sign), NULL)"
        for on, by, edits, sign in ways
    ]
    return met.where(" OR ".join(f"({on})" for on, *_ in ways)).select(
        "back",
        "w",
        F.concat("node", "c").alias("node"),
        F.when((F.col("below") == 1) | (F.col("c") == ""), F.col("one")).alias("found"),
        F.inline(F.expr(f"array_compact(array({', '.join(taken)}))")),
    )


_NEAR = "(abs(length(w) - length(found)) <= 1 AND levenshtein(w, found, 1) = 1)"


def _near_short(words: DataFrame) -> DataFrame:
    """Pairs by the frontier, level by level."""
    sides = store(_both_ways(words), "spelling-sides")
    edges = _edges(sides).repartition("node").sortWithinPartitions("depth")
    edges = store(edges, "spelling-edges")
    levels = [r["depth"] for r in edges.select("depth").distinct().orderBy("depth").collect()]
    starts = sides.select(
        "back",
        "w",
        F.col("h").alias("pos"),
        F.lit(0).alias("edits"),
        F.lit(None).cast("int").alias("sign"),
        F.expr("left(w, h)").alias("node"),
    )
    ended = starts.limit(0).select("w", F.lit(0).cast("long").alias("id"))
    frontier = None
    for level in levels:
        states = starts.where(F.col("pos") == level)
        if frontier is not None:
            states = states.unionByName(frontier)
        here = edges.where(F.col("depth") == level).drop("depth")
        reached = store(_advance(states, here), "spelling-states")
        ended = ended.unionByName(
            reached.where("found IS NOT NULL AND edits = 1").select("w", F.col("found").alias("id"))
        )
        frontier = reached.where("found IS NULL").drop("found")
    met = ended.distinct().join(sides.select("id", "back", F.col("w").alias("found")), "id").where(_NEAR)
    word, near = [F.when(F.col("back"), F.reverse(x)).otherwise(F.col(x)) for x in ("w", "found")]
    found = met.select(word.alias("word"), near.alias("near"))
    return found.unionByName(found.select(F.col("near").alias("word"), F.col("word").alias("near")))


def _near_long(words: DataFrame) -> DataFrame:
    """Pairs of long words that share a one-deletion form, or are one of it."""
    forms = words.select(
        "word",
        F.explode(
            F.expr(
                "transform(sequence(0, length(word)), "
                "i -> xxhash64(concat(left(word, i), substr(word, i + 2))))"
            )
        ).alias("form"),
    ).distinct()
    other = forms.select(F.col("word").alias("near"), "form")
    met = forms.join(other, "form").where("word <> near").select("word", "near").distinct()
    return met.toDF("w", "found").where(_NEAR).toDF("word", "near")


def near_words(words: DataFrame) -> DataFrame:
    """``word`` and ``near``: each ordered pair of words one edit apart, once."""
    long = words.where(F.length("word") >= LONG - 1)
    short = words.where(F.length("word") < LONG)
    return _near_long(long).unionByName(_near_short(short)).distinct()


def grouped(words: DataFrame, ratio: int = 10) -> DataFrame:
    """Each of ``words`` (``word``, ``n``) with its form and root.

    ``form``: its most frequent near word, ties to the smaller, if that occurs at
    least ``ratio`` times as often; ``root``: where the forms lead to from it.
    """
    words = store(words, "spelling-words")
    pairs = near_words(words.select("word"))
    sized = pairs.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    # the largest n first, then the smaller word, as one comparison
    best = sized.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    joined = words.join(best, "word", "left")
    holds = -F.col("best.less") >= F.col("n") * ratio
    table = store(
        joined.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(holds, F.col("best.near")).alias("form"),
            F.when(holds, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(table.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return table.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")
    )


def _roots(steps: DataFrame) -> DataFrame:
    """Where the steps from each word end; each round doubles what is skipped.

    Counts grow tenfold along a path, so that there are few rounds.
    """
    steps = store(steps, "spelling-roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = store(
            steps.join(on, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "spelling-roots",
        )
        steps = further.drop("moved")
        if further.where("moved").isEmpty():
            return steps


def variants(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of all ``docs``."""
    return grouped(counted_words(docs.select("doc_id", "text")))
