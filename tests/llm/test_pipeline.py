import pytest

import corpus_pipeline
from tidemark.llm import queries

SMALL = "/root/testdata/sf0.001"
# the spelling variants have a row for each word instead
NO_SQL = [
    q for q in queries.QUERIES if q.__name__ not in (*queries.SQL, "op12_spelling_variants")
]


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    before = docs.count()
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL).cache()
        assert 0 < out.count() <= before
        if place < 4:
            assert out.columns == docs.columns and out.schema == docs.schema
        docs, before = out, out.count()
    assert docs.where("n_tokens <> size(ids)").count() == 0
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) > 100
    again = corpus_pipeline.run(spark, SMALL)
    assert sorted(r["doc_id"] for r in again.select("doc_id").collect()) == sorted(ids)


def test_rows_under_one_id_are_judged_by_their_texts(spark, docs):
    same = "one two three four five six seven eight nine ten"
    own = "another text that is like no other one in this small table"
    rows = docs([same, same, own, own, None, same], ids=[3, 5, 5, 5, 5, None])
    out = corpus_pipeline.keep_one_of_each(spark, rows, SMALL)
    assert out.columns == rows.columns
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in out.collect())
    assert got == [(0, same), (3, same), (5, ""), (5, own)]


def test_stages_keep_columns_named_like_their_own(spark, docs):
    text = " ".join(f"word{i} and" for i in range(60)) + "."
    rows = docs([text, text + " x", "short"], ids=[1, 2, 3])
    rows = rows.withColumnsRenamed({"n": "score", "block": "gone_id", "lang": "predicted"})
    for stage in (corpus_pipeline.keep_good, corpus_pipeline.drop_repeated_lines, corpus_pipeline.keep_one_of_each):
        out = stage(spark, rows, SMALL)
        assert out.columns == rows.columns
        assert {(r["score"], r["gone_id"], r["predicted"]) for r in out.collect()} <= {(7, "own", "en")}


def test_stages_take_odd_rows(spark, docs):
    rows = docs([None, "", "x", "x", "one two three four five six"] * 2, ids=[1, None, 2, 3, 4] * 2)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows, SMALL).count() >= 5
        assert stage(spark, docs([]), SMALL).count() == 0


@pytest.mark.parametrize("query", NO_SQL, ids=lambda q: q.__name__)
def test_one_row_for_each_input_row(spark, query):
    kinds = {"op3_embedding_duplicates": "embeddings", "op11_html_text": "pages"}
    table = kinds.get(query.__name__, "documents")
    want = spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    assert query(spark, SMALL).count() == want
