"""URL filters: rules by host and path, and a list of URLs behind a Bloom filter.

All of it is DataFrame expressions; nothing runs in Python.

Defined cases: a URL that is null, empty or has no ``://`` has an empty host and
path, fits no rule and is in no list (verdict ``allow``). Repeated pages are
judged each on its own. An empty list lets everything pass; an empty page table
gives an empty result. Only the named columns of the page table are read, so
other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # host, path, verdict

WORDS, PICKS = 4, 6  # a block is four longs; every URL sets six of its 256 bits
BITS_PER_URL = 16


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lowered."""
    host = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Scheme, query, fragment and closing slashes do not tell pages apart."""
    return F.when(host != "", F.concat(host, F.rtrim(path, F.lit("/"))))


def fits(host: Column, path: Column, rule: Rule) -> Column:
    """The rule's host or a subdomain of it, under the rule's path."""
    return ((host == rule[0]) | host.endswith(f".{rule[0]}")) & path.startswith(rule[1])


def ruled(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule as text and its verdict; null where none fits."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]), r)):
        fit = fits(host, path, rule)
        text = F.when(fit, F.lit(rule[0] + rule[1])).otherwise(text)
        verdict = F.when(fit, F.lit(rule[2])).otherwise(verdict)
    return text, verdict


def _spots(url: Column) -> list[Column]:
    """The bits of a URL within its block, each from 0 to 255."""
    bits = F.xxhash64(F.lit(1), url)
    return [F.shiftrightunsigned(bits, 8 * i).bitwiseAND(F.lit(255)) for i in range(PICKS)]


def _masks(url: Column) -> list[Column]:
    """What a URL sets in each long of its block."""
    one = F.lit(1).cast("long")
    spots = _spots(url)

    def word(w: int) -> Column:
        parts = [
            F.when(
                F.shiftright(s, 6) == w,
                F.call_function("shiftleft", one, s.bitwiseAND(F.lit(63)).cast("int")),
            ).otherwise(F.lit(0).cast("long"))
            for s in spots
        ]
        return reduce(lambda a, b: a.bitwiseOR(b), parts)

    return [word(w) for w in range(WORDS)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def bloom_blocks(listed: DataFrame, blocks: int, url: str = "listed_url") -> DataFrame:
    """The filter: a row for each block in use, with its bits as longs."""
    key = F.col(url)
    masked = listed.select(
        _block(key, blocks).alias("block"),
        *[m.alias(f"m{i}") for i, m in enumerate(_masks(key))],
    )
    return masked.groupBy("block").agg(
        *[F.bit_or(f"m{i}").alias(f"bits{i}") for i in range(WORDS)]
    )


def in_list(urls: DataFrame, listed: DataFrame, url: str = "canonical_url") -> DataFrame:
    """``urls`` with a boolean ``listed``: whether its ``url`` is in the list.

    The filter decides for most rows that they are not listed; what passes it
    meets the list itself in an exact hash join, which removes false positives.
    The filter grows with the list (16 bits a URL) and is joined by block, so no
    side has to fit one machine. ``listed`` has one column, ``listed_url``.
    """
    wanted = listed.where(F.col("listed_url").isNotNull()).distinct()
    n = wanted.count()
    blocks = max(1, -(-n * BITS_PER_URL // (64 * WORDS)))
    key = F.col(url)
    probe = urls.withColumn("block", F.coalesce(_block(key, blocks), F.lit(-1))).join(
        bloom_blocks(wanted, blocks), "block", "left"
    )
    passed = reduce(
        lambda a, b: a & b,
        [
            F.coalesce(F.col(f"bits{i}").bitwiseAND(m) == m, F.lit(False))
            for i, m in enumerate(_masks(key))
        ],
    )
    probe = probe.withColumn("possible", F.coalesce(key.isNotNull() & passed, F.lit(False)))
    probe = probe.drop("block", *[f"bits{i}" for i in range(WORDS)])
    surely_not = probe.where(~F.col("possible")).drop("possible")
    exact = (
        probe.where("possible")
        .drop("possible")
        .join(
            wanted.hint("shuffle_hash").withColumn("found", F.lit(True)),
            key == F.col("listed_url"),
            "left",
        )
    )
    return surely_not.withColumn("listed", F.lit(False)).unionByName(
        exact.withColumn("listed", F.coalesce("found", F.lit(False))).drop("found", "listed_url")
    )


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    listed: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Verdict for each page: the longest rule's, else ``block`` if listed.

    ``listed`` has one column, ``listed_url``, of canonical URLs.
    """
    split = pages.select(
        F.col(page_id).alias("page_id"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    text, verdict = ruled(F.col("host"), F.col("path"), rules)
    split = split.select(
        "*",
        canonical(F.col("host"), F.col("path")).alias("canonical_url"),
        text.alias("rule"),
        verdict.alias("rule_verdict"),
    )
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return in_list(split, listed).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", method).alias("verdict"),
        "listed",
    )


def urls_of_labels(pages: DataFrame, labels: Sequence[str], url: str = "url") -> DataFrame:
    """Canonical URLs under hosts that carry one of the given name labels."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    marked = F.arrays_overlap(F.split(host, r"\."), F.array(*[F.lit(x) for x in labels]))
    return pages.where(marked).select(canonical(host, path).alias("listed_url"))
