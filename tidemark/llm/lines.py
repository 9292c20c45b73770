"""Line de-duplication by an exact set-similarity join, in DataFrame expressions.

A line is the set of its words. Two lines match if the Jaccard similarity of their
sets is ``PERCENT`` hundredths or more; a line goes if an earlier one matches it.
Earlier is by document id, then the hash of the text, then the place in the text.

The words of a line are ordered by rarity, counted over all words of all documents
in 1,048,576 slots by hash (half a megabyte, whatever the corpus), then by hash. Matching lines share
two words among the first of each (prefix filter), are of like sizes (length filter),
have enough words left behind these (positional filter) and differ in few bits of a
parity of their words, each of which turns one bit (bitmap filter): no more bits
differ than words, so no match is lost. The parity has 64 bits, or 128 for pairs of long
lines, for which 64 would let nearly all pass. What passes is verified on the words
themselves; only lines travel for it whose place a bitmap of the asked ones lets pass.
Lines of equal sets form a class that is compared once; a class that many lines belong
to enters the join by its first line only.

One earlier match is enough for a class. Each is first held against the earliest that
shares three of its least or greatest hashes (MinHash of groups of words); classes that
match there are covered, and the join leaves out pairs whose later class is covered, as far
as the steps tell that cut the order of the documents. So what a group of near copies costs
grows with its size times the few that stay open.

Defined cases: words are what spaces and tabs part; lines without words neither
match nor go (``LEAST_WORDS`` can ask for more words), nor do empty texts; null texts
count as empty and null ids come last; equal rows are one document, of which no row
loses a line to the other. Tables without rows give none. Working columns are apart
from those of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.stage import store

PERCENT = 75
LEAST_WORDS = 1
#: Words that matching lines share in prefixes that are longer by as many less one.
SHARED = 2
SLOTS, PACKED = 1 << 20, 16
#: Bits of the bitmaps of lines whose words are verified and of covered classes.
ASKED = 1 << 23
#: Lines of so many words have a parity of 128 bits.
LONG = 80
#: Steps that the order of the documents is cut into.
STEPS = 1 << 15
#: Hashes that name an early class.
TOLD = 3
#: The highest of each four bits.
TURNED = -0x7777777777777778
#: A class with more than this share of all lines enters the join by one line, so
#: that at most as many classes are broadcast as this goes into 1.
HOT_SHARE = 1 / 5000


def _words(line: Column) -> Column:
    parted = F.split(F.replace(line, F.lit("\t"), F.lit(" ")), " ")
    return F.array_distinct(F.filter(parted, lambda w: w != ""))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def rarity(docs: DataFrame, text: str = "text") -> Column:
    """How often the words of each hash slot occur, in 16 steps of a factor of two.

    The steps begin well below the mean of all slots; sixteen slots share a number,
    so the table has 65,536 numbers whatever the size of the corpus. The low bits of a
    slot name the number, the high ones the four bits in it, of which the first is
    turned, so that they sort as the highest bits of a number with a sign.
    """
    plain = F.replace(F.replace(F.col(text), F.lit("\n"), F.lit(" ")), F.lit("\t"), F.lit(" "))
    words = docs.select(F.explode(F.split(plain, " ")).alias("word"))
    slot = F.xxhash64("word").bitwiseAND(F.lit(SLOTS - 1))
    counted = words.groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))
    counted = store(counted, "rarity")
    total = counted.agg(F.sum("n")).first()[0] or 0
    lowest = max(0, int(total / SLOTS).bit_length() - 3)
    level = F.least(F.greatest(F.ceil(F.log2("n")).cast("int") - lowest, F.lit(0)), F.lit(15))
    packed = counted.select("slot", level.cast("long").alias("level")).groupBy(
        F.expr(f"slot % {SLOTS // PACKED}").cast("int").alias("word")
    )
    bits = F.expr(f"shiftleft(level, CAST(4 * (slot div {SLOTS // PACKED}) AS INT))")
    return _numbers(packed.agg(F.bit_or(bits).alias("bits")), SLOTS // PACKED, TURNED)


def _numbers(rows: DataFrame, size: int, turned: int = 0) -> Column:
    """An array of ``size`` numbers from rows of (word, bits), 0 where there is none.

    A subquery: as a literal it would be spelt out in every plan that the driver keeps.
    """
    places = rows.sparkSession.range(size).select(F.col("id").cast("int").alias("place"))
    bits = F.coalesce("bits", F.lit(0)).bitwiseXOR(F.lit(turned))
    whole = places.join(rows, F.col("place") == F.col("word"), "left").agg(
        F.sort_array(F.collect_list(F.struct("place", bits.alias("bits")))).alias("rows")
    )
    return store(whole.select("rows.bits"), "numbers").scalar()


def _code(table: Column, x: Column) -> Column:
    """Level and hash of a word in one number."""
    number = F.get(table, x.bitwiseAND(F.lit(SLOTS // PACKED - 1)).cast("int"))
    number = F.coalesce(number, F.lit(TURNED))  # without nulls an array sorts as plain numbers
    place = F.shiftright(x, 14).bitwiseAND(F.lit(60)).cast("int")
    level = F.shiftleft(F.call_function("shiftrightunsigned", number, place), 60)
    return level.bitwiseOR(F.shiftrightunsigned(x, 4))


def _bitmap(slots: DataFrame) -> Column:
    """``ASKED`` bits, 1 at each ``slot``."""
    words = slots.groupBy(F.shiftright("slot", 6).cast("int").alias("word"))
    bits = F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))"))
    return _numbers(words.agg(bits.alias("bits")), ASKED // 64)


def _is_set(bitmap: Column, slot: Column) -> Column:
    number = F.get(bitmap, F.shiftright(slot, 6).cast("int"))
    bit = slot.bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftrightunsigned", number, bit).bitwiseAND(F.lit(1)) == 1


def _parity(codes: Column, turns: Callable[[Column], Column] = lambda x: F.lit(1).cast("long")) -> Column:
    """64 bits, each turned by the words whose hashes end in its number."""
    return F.aggregate(
        codes,
        F.lit(0).cast("long"),
        lambda had, x: had.bitwiseXOR(
            F.call_function("shiftleft", turns(x), x.bitwiseAND(F.lit(63)).cast("int"))
        ),
    )


def _half(codes: Column) -> Column:
    """What half of the words turn in the parity; with the other half it makes 128 bits."""
    return _parity(codes, lambda x: F.shiftright(x, 6).bitwiseAND(F.lit(1)))


def line_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every line that can match: its place, class, size, prefix and parity.

    Half of the hash of a word will do in the prefix, as chance meetings are verified.
    """
    table = rarity(docs, text)
    rows = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1)).alias("doc"),
        F.xxhash64(text).alias("h"),
        F.posexplode(_lines(F.col(text))).alias("line", "words"),
    ).where(F.length("words") >= 2 * LEAST_WORDS - 1)
    # a condition on ``n`` alone would hash and sort all words a second time
    rows = rows.where(F.translate("words", " \t", "") != "")
    parted = F.split(F.replace("words", F.lit("\t"), F.lit(" ")), " ")
    hashed = F.array_distinct(F.transform(F.array_remove(parted, ""), lambda w: F.xxhash64(w)))
    rows = rows.select("doc", "h", "line", F.sort_array(hashed).alias("hashed"))
    ordered = F.sort_array(F.transform("hashed", lambda x: _code(F.col("table"), x)))
    rows = rows.withColumn("table", table).select(
        "doc", "h", "line", "hashed", ordered.alias("codes")
    )
    rows = rows.select(
        "doc",
        "h",
        "line",
        "codes",
        F.size("codes").alias("n"),
        "hashed",
        F.sort_array(F.array_append("hashed", F.lit(0).cast("long"))).alias("parted"),
    )
    if LEAST_WORDS > 1:
        rows = rows.where(F.col("n") >= LEAST_WORDS)
    # lines with ceil(n * PERCENT / 100) words in common share SHARED among these
    prefix = F.expr(f"n - (n * {PERCENT} + 99) div 100 + {SHARED}").cast("int")
    # the least and the greatest hashes, and those on either side of 0
    zero = F.array_position("parted", F.lit(0).cast("long")).cast("int")
    keys = [
        F.slice("hashed", F.lit(1), F.lit(TOLD)),
        F.slice("hashed", F.greatest(F.col("n") - TOLD + 1, F.lit(1)), F.lit(TOLD)),
        F.slice("parted", zero + 1, F.lit(TOLD)),
        F.slice("parted", F.greatest(zero - TOLD, F.lit(1)), F.lit(TOLD)),
    ]
    return rows.select(
        "doc",
        "h",
        "line",
        F.xxhash64("codes").alias("class"),
        "n",
        F.transform(
            F.slice("codes", F.lit(1), prefix),
            lambda x: x.bitwiseAND(F.lit(2**31 - 1)).cast("int"),
        ).alias("prefix"),
        _parity(F.col("codes")).alias("parity"),
        F.when(F.col("n") >= LONG, _half(F.col("codes"))).otherwise(F.lit(0)).alias("half"),
        F.array(*[F.hash(k, F.lit(i)) for i, k in enumerate(keys)]).alias("keys"),
    )


def _entering(lines: DataFrame, classes: DataFrame, total: int) -> DataFrame:
    """The lines without repeats of hot classes."""
    hot = classes.where(F.col("lines") > max(2, int(total * HOT_SHARE)))
    hot = hot.select(F.col("class").alias("c"), "first")
    place = F.struct("doc", "h", "line")
    return (
        lines.join(F.broadcast(hot), F.col("class") == F.col("c"), "left")
        .where(F.col("first").isNull() | (place == F.col("first")))
        # sets of one or two words match equal sets only, which are one class already
        .where("n > 2")
    )


def _early(lines: DataFrame, classes: DataFrame, total: int) -> DataFrame:
    """Pairs of a class and the earliest that some of its least or greatest hashes name."""
    told = _entering(lines, classes, total).select("class", "doc", F.explode("keys").alias("key"))
    ahead = Window.partitionBy("key").orderBy("doc", "class")
    return (
        told.select("class", F.first("class").over(ahead).alias("class2"))
        .where("class <> class2")
        .groupBy("class", "class2")
        .agg(F.count("*").alias("shared"))
    )


def _opened(lines: DataFrame, covered: DataFrame) -> DataFrame:
    """``lines`` with ``open``, 0 where the class is one of the ``covered`` (``later``), else 1.

    Only lines that a bitmap of the covered classes lets pass travel to meet these.
    """
    slot = F.col("class").bitwiseAND(F.lit(ASKED - 1))
    named = covered.select(F.col("later").bitwiseAND(F.lit(ASKED - 1)).alias("slot"))
    told = lines.withColumn("told", _is_set(_bitmap(named), slot))
    met = told.where("told").join(covered, F.col("class") == F.col("later"), "left")
    met = met.withColumn("open", F.col("later").isNull().cast("int")).drop("later")
    return told.where("NOT told").withColumn("open", F.lit(1)).unionByName(met)


def _step(lines: DataFrame) -> Column:
    """Which of the ``STEPS`` of equal width a document falls to; never less for a later one."""
    low, high = lines.where(F.col("doc") < 2**63 - 1).agg(F.min("doc"), F.max("doc")).first()
    if low is None:
        return F.lit(0)
    steps = (STEPS - 1) / (float(high) - float(low) + 1)
    step = (F.col("doc").cast("double") - F.lit(float(low))) * F.lit(steps)
    return F.least(step, F.lit(float(STEPS - 1))).cast("int")


def _candidates(
    lines: DataFrame, classes: DataFrame, total: int, covered: DataFrame | None = None
) -> DataFrame:
    """Pairs of classes that the four filters let pass, without those whose later class is
    ``covered`` (``later``), as far as steps tell which one that is."""
    entered = _entering(lines, classes, total)
    if covered is None:
        entered = entered.withColumn("open", F.lit(1))
    else:
        entered = _opened(entered, covered)
    entered = (
        entered.withColumn("step", _step(lines))
        .select("class", "n", "parity", "half", "open", "step", F.posexplode("prefix").alias("at", "code"))
        # size, step, place and whether it is open in one number
        .select(
            "code",
            "class",
            (
                ((F.col("n").cast("long") * STEPS + F.col("step")) * 65536 + F.least("at", F.lit(65535))) * 2
                + F.col("open")
            ).alias("spot"),
            "parity",
            "half",
        )
    )
    # one exchange serves the removal of repeats, which leaves the first step of each class,
    # and both sides of the join
    entered = (
        entered.repartition("code")
        .groupBy("code", "class")
        .agg(F.min("spot").alias("spot"), F.min("parity").alias("parity"), F.min("half").alias("half"))
    )
    other = entered.select(
        F.col("code").alias("code2"),
        F.col("class").alias("class2"),
        F.col("spot").alias("spot2"),
        F.col("parity").alias("parity2"),
        F.col("half").alias("half2"),
    )
    n1, n2 = F.expr("shiftright(spot, 32)"), F.expr("shiftright(spot2, 32)")
    s1, s2 = (F.expr(f"shiftright({x}, 17) & {STEPS - 1}") for x in ("spot", "spot2"))
    p1, p2 = F.expr("shiftright(spot, 1) & 65535"), F.expr("shiftright(spot2, 1) & 65535")
    open1, open2 = F.expr("spot & 1 = 1"), F.expr("spot2 & 1 = 1")
    later_open = ((s1 >= s2) & open1) | ((s1 <= s2) & open2)
    like = (100 * F.least(n1, n2)) >= (PERCENT * F.greatest(n1, n2))
    # overlap that the threshold asks for, against what can still follow the first
    # or second shared word
    left = (SHARED - 1 + F.least(n1 - p1, n2 - p2)) * (100 + PERCENT)
    enough = left >= PERCENT * (n1 + n2)
    long_line = (p1 >= 65535) | (p2 >= 65535)
    # words that are in one of two matching lines only, as many as may be
    differ = F.col("parity").bitwiseXOR(F.col("parity2"))
    halves = F.col("half").bitwiseXOR(F.col("half2"))
    finer = F.bit_count(halves) + F.bit_count(halves.bitwiseXOR(differ))
    apart = F.when(F.least(n1, n2) >= LONG, finer).otherwise(F.bit_count(differ))
    few = (100 + PERCENT) * apart <= (100 - PERCENT) * (n1 + n2)
    return (
        entered.join(
            other,
            (F.col("code") == F.col("code2"))
            & (F.col("class") < F.col("class2"))
            & later_open
            & like
            & few
            & (enough | long_line),
        )
        .groupBy("class", "class2")
        .agg(F.count("*").alias("shared"))
        .where(F.col("shared") >= SHARED)
    )


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs whose words are alike enough."""
    needed = pairs.select(F.explode(F.array("class", "class2")).alias("need")).distinct()
    places = store(
        classes.join(needed, F.col("class") == F.col("need"), "left_semi").select(
            "class", "first.doc", "first.h", "first.line"
        ),
        "places",
    )
    slot = F.xxhash64("doc", "h", "line").bitwiseAND(F.lit(ASKED - 1))
    asked = _bitmap(places.select(slot.alias("slot")))
    lines = (
        docs.select(
            F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"),
            F.xxhash64("text").alias("h"),
            F.posexplode(_lines(F.col("text"))).alias("line", "words"),
        )
        .withColumn("slot", slot)
        .where(_is_set(asked, F.col("slot")))
        .select("doc", "h", "line", "words")
    )
    sets = store(
        lines.join(places, ["doc", "h", "line"]).select("class", _words(F.col("words")).alias("words")),
        "sets",
    )
    if sets.count() > places.count():  # the documents hold equal rows
        sets = store(sets.dropDuplicates(["class"]), "sets")
    a = sets.select(F.col("class").alias("ca"), F.col("words").alias("wa"))
    b = sets.select(F.col("class").alias("cb"), F.col("words").alias("wb"))
    both = F.size(F.array_intersect("wa", "wb"))
    return (
        pairs.join(a, F.col("class") == F.col("ca"))
        .join(b, F.col("class2") == F.col("cb"))
        .withColumn("both", both)
        .where(100 * F.col("both") >= PERCENT * (F.size("wa") + F.size("wb") - F.col("both")))
        .select("class", "class2")
    )


def _directed(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that can match, the class with the later first line named first."""
    a = classes.select(*[F.col(c).alias(f"{c}_a") for c in ("class", "first", "n", "parity")])
    b = classes.select(*[F.col(c).alias(f"{c}_b") for c in ("class", "first", "n", "parity")])
    after = F.col("first_a") > F.col("first_b")
    like = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    apart = F.bit_count(F.col("parity_a").bitwiseXOR(F.col("parity_b")))
    few = (100 + PERCENT) * apart <= (100 - PERCENT) * (F.col("n_a") + F.col("n_b"))
    return (
        pairs.join(a, F.col("class") == F.col("class_a"))
        .join(b, F.col("class2") == F.col("class_b"))
        .where(like & few)
        .select(
            F.when(after, F.col("class_a")).otherwise(F.col("class_b")).alias("class"),
            F.when(after, F.col("class_b")).otherwise(F.col("class_a")).alias("class2"),
            "shared",
        )
    )


def _held(directed: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """The classes (``later``) that match an earlier one of their pairs: first each is held
    against the one that it shares most with, then against all others if these differ."""
    likely = store(
        directed.groupBy("class")
        .agg(F.max(F.struct("shared", "class2")).alias("most"))
        .select("class", F.col("most.class2").alias("class2")),
        "likely",
    )
    found = store(
        _verified(likely, classes, docs).select(F.col("class").alias("later")), "found"
    )
    rest = store(
        directed.select("class", "class2")
        .join(found, F.col("class") == F.col("later"), "left_anti")
        .join(likely, ["class", "class2"], "left_anti"),
        "rest",
    )
    others = _verified(rest, classes, docs).select(F.col("class").alias("later")).distinct()
    return store(found.unionByName(others), "held")


def _covered(lines: DataFrame, classes: DataFrame, total: int, docs: DataFrame) -> DataFrame:
    """The classes (``later``) that match one with an earlier first line.

    One earlier match is enough. So each class is first held against an early one that
    it shares its least or greatest hashes with, as near copies mostly do, and two classes
    that are covered by then are not compared: a group of near copies costs about as many
    comparisons as it has classes.
    """
    early = store(_directed(_early(lines, classes, total), classes), "early")
    found = _held(early, classes, docs)
    pairs = _candidates(lines, classes, total, found)
    directed = store(
        _directed(pairs, classes)
        .join(found, F.col("class") == F.col("later"), "left_anti")
        .join(early, ["class", "class2"], "left_anti"),
        "directed",
    )
    return found.unionByName(_held(directed, classes, docs))


def removed_lines(docs: DataFrame) -> DataFrame:
    """Numbers of the lines (from 0) that go, by document (``doc``, ``h``)."""
    lines = store(line_sets(docs), "lines")
    total = lines.count()
    place = F.struct("doc", "h", "line")
    classes = store(
        lines.groupBy("class")
        .agg(
            # the rest of the first line comes with it
            F.min(F.struct("doc", "h", "line", "n", "parity")).alias("least"),
            F.count("*").alias("lines"),
        )
        .select("class", "least.*", "lines")
        .select("class", place.alias("first"), "lines", "n", "parity"),
        "classes",
    )
    covered = store(_covered(lines, classes, total, docs), "covered")
    # a class whose only line stands alone can lose nothing
    losing = (
        classes.join(covered, F.col("class") == F.col("later"), "left")
        .where("lines > 1 OR later IS NOT NULL")
        .select(F.col("class").alias("c"), "first", F.col("later").isNotNull().alias("whole"))
    )
    return (
        lines.select("doc", "h", "line", "class")
        .join(losing, F.col("class") == F.col("c"))
        .where(F.col("whole") | (place > F.col("first")))
        .groupBy("doc", "h")
        .agg(F.sort_array(F.collect_set("line")).alias("gone"))
    )


def line_report(docs: DataFrame) -> DataFrame:
    """For each document its number of lines and which of them go."""
    gone = removed_lines(docs).withColumnsRenamed({"doc": "doc1", "h": "h1"})
    sizes = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)).alias("doc"),
        F.xxhash64("text").alias("h"),
        F.when(F.coalesce("text", F.lit("")) == "", 0)
        .otherwise(F.size(_lines(F.col("text"))))
        .alias("n_lines"),
    )
    return sizes.join(
        gone, (F.col("doc") == F.col("doc1")) & (F.col("h") == F.col("h1")), "left"
    ).select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("gone", F.expr("cast(array() AS array<int>)")).alias("removed_lines"),
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that go cut from ``text``.

    A document that loses every line it has is a later match as a whole and goes;
    one that was empty before stays.
    """
    gone = removed_lines(docs.select("doc_id", "text")).select(
        F.col("doc").alias("_doc"), F.col("h").alias("_h"), F.col("gone").alias("_gone")
    )
    inner = {c: f"own{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(v) for c, v in inner.items()])
    text = F.col(inner["text"])
    same = (
        F.coalesce(F.col(inner["doc_id"]).cast("long"), F.lit(2**63 - 1)) == F.col("_doc")
    ) & (F.xxhash64(text) == F.col("_h"))
    kept = F.filter(_lines(text), lambda _, i: ~F.array_contains("_gone", i))
    cut = F.when(F.col("_gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    joined = plain.join(gone, same, "left").where(
        F.col("_gone").isNull() | (F.size("_gone") < F.size(_lines(text)))
    )
    values = {inner["text"]: cut}
    if "n_chars" in inner:
        before = F.col(inner["n_chars"])
        values[inner["n_chars"]] = F.when(F.col("_gone").isNull(), before).otherwise(F.length(cut))
    return joined.select(
        *[values.get(v, F.col(v)).cast(docs.schema[c].dataType).alias(c) for c, v in inner.items()]
    )
