import hashlib

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import bpe, tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "   ", "a\tb c\x1cd\x85e", "İstanbul ΣΑΣ", "don't I'LL we'Ve 'S", "école café", "a" * 3000,
    "<|endoftext|> x<|startoftext|>Y<|ENDOFTEXT|>", "0123 1.5e-10", "x\x00y​z", "日本語 🎉🏳️‍🌈",
    "ab" * 400 + " " + "!" * 300, "ﬁ Å ẞ ǅ", "\r\n\r\n", "the the the",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_as_the_library(library, table):
    texts = ODD + [r["text"] for r in table("documents").collect()]
    enc = bpe.Encoder(PATH)
    for text, ids in zip(texts, enc.encode(texts), strict=True):
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert enc.decode(ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(texts):
    library = Tokenizer.from_file(PATH)
    got = bpe.encoder(PATH).encode(texts)
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_small_memory_gives_the_same(monkeypatch, table):
    texts = [r["text"] for r in table("documents").limit(40).collect()]
    whole = bpe.Encoder(PATH).encode(texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    enc = bpe.Encoder(PATH)
    assert [enc.encode([t])[0] for t in texts] == whole


def test_documents(docs, library):
    texts = [None, *ODD, "same", "same"]
    frame = docs(texts)
    out = bpe.encode_documents(frame, PATH)
    assert out.columns == [*frame.columns, *bpe.ADDED]
    for row in out.collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert row["ids"] == ids and row["n_tokens"] == len(ids) and row["block"] == "own"
        joined = " ".join(map(str, ids)).encode()
        assert row["ids_sha256"] == hashlib.sha256(joined).hexdigest()
        text = library.decode(ids, skip_special_tokens=False).encode()
        assert row["decoded_sha256"] == hashlib.sha256(text).hexdigest()
    assert bpe.encode_documents(docs([]), PATH).count() == 0


@pytest.mark.parametrize("block_ids", [3, 64, 1 << 18])
def test_token_counts(docs, library, block_ids):
    texts = [None, "", "a b", "word " * 200, "x", "<|endoftext|> y", "", "same", "same"]
    stream = tokens.token_stream(docs(texts).coalesce(1), PATH, block_ids=block_ids)
    rows = tokens.count_documents(stream, 49407).collect()
    want = {
        i: len(library.encode((t or "").replace("<|endoftext|>", " "), add_special_tokens=False).ids)
        for i, t in enumerate(texts)
    }
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == want


def test_unclosed_and_missing_streams(spark):
    import numpy as np

    def block(values):
        return bytearray(np.array(values, np.uint16).tobytes())

    flat = [5, 5, 9, 9, 5, 5, 5, 5, 9, 5]
    rows = [(0, i, block(flat[2 * i : 2 * i + 2]), None, None) for i in range(5)]
    stream = spark.createDataFrame(rows, tokens.STREAM.format("bigint"))
    found = tokens.count_tokens(stream, 9).orderBy("place").collect()
    assert [r["n_tokens"] for r in found] == [2, 0, 4, 1]
    assert tokens.count_documents(stream.limit(0), 9).count() == 0
