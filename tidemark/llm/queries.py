"""Registered queries of the training-data operators, and their SQL.

Each query takes (spark, sf_dir), reads the whole table it is meant for and
returns its operator's full result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import alignment, bpe, extraction, forest, lines, mixing, pitman_yor, pivots, quality, spelling, syncmers, tokens, urls
from tidemark.llm.stage import store
from tidemark.session import configure

RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
SPAM_LABELS = ("spam-farm", "cheap-pills", "ads-track", "casino-win", "free-bets", "adult-x")


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Place of every document when sources are mixed by the roots of their sizes."""
    docs = _table(spark, sf, "documents").select("doc_id", "source")
    return mixing.mix(docs)


OP1_SQL = """
WITH RECURSIVE counts AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), shared AS (
  SELECT source, n, CAST(round(sqrt(n)) AS BIGINT) AS a,
    row_number() OVER (ORDER BY source NULLS FIRST) AS place
  FROM counts
), period AS (
  SELECT CAST(sum(a) AS BIGINT) AS q, list(a ORDER BY place) AS a FROM shared
), steps AS (
  SELECT CAST(0 AS BIGINT) AS t, list_transform(a, lambda x: CAST(0 AS BIGINT)) AS got,
    CAST(NULL AS BIGINT) AS j, q, a
  FROM period
  UNION ALL
  SELECT t + 1, list_transform(got, lambda g, i: CASE WHEN i = pick THEN g + 1 ELSE g END),
    pick, q, a
  FROM (
    SELECT *, list_min(list_filter(list_transform(a, lambda x, i:
        CASE WHEN (got[i] * q) // x <= t
          THEN (((got[i] + 1) * q + x - 1) // x) * 1000000 + i END),
        lambda v: v IS NOT NULL)) % 1000000 AS pick
    FROM steps WHERE t < q)
), slots AS (
  SELECT j AS place, t - 1 AS slot_of,
    row_number() OVER (PARTITION BY j ORDER BY t) - 1 AS k
  FROM steps WHERE j IS NOT NULL
), ranked AS (
  SELECT d.doc_id, d.source, s.a, s.place, p.q,
    row_number() OVER (PARTITION BY s.place ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id)
      AS block
  FROM documents d JOIN shared s ON d.source IS NOT DISTINCT FROM s.source, period p
)
SELECT doc_id, source, block, CAST(((block - 1) * q) // a AS BIGINT) AS release,
  CAST((block * q + a - 1) // a AS BIGINT) AS deadline,
  CAST(((block - 1) // a) * q + slot_of AS BIGINT) AS slot
FROM ranked JOIN slots ON ranked.place = slots.place AND slots.k = (block - 1) % a
"""


def op2_near_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Components of near-equal documents, by five-word shingles at 0.75."""
    return forest.near_duplicates(_table(spark, sf, "documents"))


def op3_embedding_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Links and components of all vectors, within labels, at cosine 0.98."""
    return pivots.near_duplicates(_table(spark, sf, "embeddings"))


def op4_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every whole document and the text they decode to, as digests."""
    docs = _table(spark, sf, "documents")
    return bpe.digest_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op5_quality_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Score of every whole document by a network that saw no held-out label."""
    docs = _table(spark, sf, "documents")
    net = quality.train(docs, _table(spark, sf, "labels"))
    return quality.classify(docs.select("doc_id", "text"), net).select(
        "doc_id", quality.held_out("doc_id").alias("held_out"), "score", "predicted"
    )


def op6_language_model(spark: SparkSession, sf: str) -> DataFrame:
    """Score of every document by a model that saw no held-out document."""
    return pitman_yor.score_documents(_table(spark, sf, "documents"))


def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document, counted in flat token files without an index."""
    docs = _table(spark, sf, "documents")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    stream = store(tokens.token_stream(docs, vocabulary), "tokens")
    return tokens.count_documents(stream, bpe.encoder(vocabulary).vocab.special["<|endoftext|>"])


def op8_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    """Anchors of every document, of its edited text, and how alike they are."""
    return syncmers.compare_edited(_table(spark, sf, "documents"))


def op9_line_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Which lines of each document match an earlier line of any document."""
    return lines.line_report(_table(spark, sf, "documents"))


def op10_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Verdict on every page URL by rules, else by the list of spam pages.

    Listed are the canonical URLs of all pages under hosts with a spam label.
    """
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return urls.judge_urls(pages, RULES, urls.urls_of_labels(pages, SPAM_LABELS))


OP10_SQL = r"""
WITH split AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^[\s\S]*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^[\s\S]*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), keyed AS (
  SELECT *, CASE WHEN host <> '' THEN host || rtrim(path, '/') END AS canonical_url,
    list_has_any(string_split(host, '.'), ['spam-farm', 'cheap-pills', 'ads-track',
      'casino-win', 'free-bets', 'adult-x']) AS marked
  FROM split
), listed AS (
  SELECT DISTINCT canonical_url FROM keyed WHERE marked AND canonical_url IS NOT NULL
), rules(h, p, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
    ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitted AS (
  SELECT k.*, r.h || r.p AS rule, r.verdict, l.canonical_url IS NOT NULL AS listed,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r.h || r.p) DESC NULLS LAST) AS rn
  FROM keyed k
  LEFT JOIN rules r ON (k.host = r.h OR ends_with(k.host, '.' || r.h)) AND starts_with(k.path, r.p)
  LEFT JOIN listed l ON k.canonical_url = l.canonical_url
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM fitted WHERE rn = 1
"""

def op11_html_text(spark: SparkSession, sf: str) -> DataFrame:
    """Main text of every page, from its whole markup."""
    return extraction.extract(_table(spark, sf, "pages").select("page_id", "url", "html"))


def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    """Frequent words of all documents with the more frequent words that they vary."""
    return spelling.variants(_table(spark, sf, "documents"))


#: Byte BPE, the same vocabulary as ranks, its pattern, sentence pieces.
ALIGNED_FILES = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
    public_tokenizers.path("piece_bpe_32k.model"),
)


def op13_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Groups and links between the tokens of two vocabularies, for every document."""
    return alignment.align_report(_table(spark, sf, "documents"), ALIGNED_FILES)


QUERIES = [
    op1_mix_sources,
    op2_near_documents,
    op3_embedding_duplicates,
    op4_bpe_round_trip,
    op5_quality_scores,
    op6_language_model,
    op7_token_counts,
    op8_fingerprints,
    op9_line_repeats,
    op10_url_filter,
    op11_html_text,
    op12_spelling_variants,
    op13_token_alignment,
]
SQL = {"op1_mix_sources": OP1_SQL, "op10_url_filter": OP10_SQL}
