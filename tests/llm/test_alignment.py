import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment, queries

FILES = queries.ALIGNED_FILES


@pytest.fixture(scope="module")
def plain():
    """Tokens of a text as (id, bytes), straight from the libraries."""
    one = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    stand_ins = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    spare = [b for b in range(256) if b not in stand_ins]
    byte_of = {chr(b): b for b in stand_ins} | {chr(256 + i): b for i, b in enumerate(spare)}

    def side_a(text):
        ids = one.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(byte_of[c] for c in one.id_to_token(i))) for i in ids]

    def side_b(text):
        out = []
        for i in other.encode(text):
            piece = other.id_to_piece(i)
            raw = bytes([int(piece[3:5], 16)]) if other.is_byte(i) else piece.replace("▁", " ").encode()
            out.append((i, raw))
        return out

    return side_a, side_b


def brute(rows, plain):
    """Report rows by walking over the bytes of every document."""
    side_a, side_b = plain
    docs, corpus = [], Counter()
    for doc_id, text in rows:
        groups, links, n_a, n_b = [], [], 0, 0
        if text:
            a, b = side_a(text), side_b(text)
            want = (" " + text).encode()
            if b"".join(x for _, x in a) == want and b"".join(x for _, x in b) == want:
                n_a, n_b = len(a), len(b)
                end_a, end_b, at = {}, {}, 0
                for i, x in a:
                    at += len(x)
                    end_a[at] = i
                at = 0
                for i, x in b:
                    at += len(x)
                    end_b[at] = i
                left, right = [], []
                for at in sorted(end_a.keys() | end_b.keys()):
                    left += [end_a[at]] if at in end_a else []
                    right += [end_b[at]] if at in end_b else []
                    if at in end_a and at in end_b:
                        groups.append(f"{','.join(map(str, left))}|{','.join(map(str, right))}")
                        links.append((end_a[at], end_b[at]))
                        left, right = [], []
        corpus.update(links)
        docs.append((doc_id, n_a, n_b, ";".join(groups), len(groups), links))
    top = defaultdict(int)
    for (_, b), n in corpus.items():
        top[b] = max(top[b], n)
    return Counter(
        (
            doc_id, n_a, n_b, n, len(links),
            sum(corpus[x] == top[x[1]] for x in links),
            sum(corpus[x] for x in links),
            hashlib.sha256(text.encode()).hexdigest() if text else "",
        )
        for doc_id, n_a, n_b, text, n, links in docs
    )


def reported(df):
    return Counter(tuple(r) for r in df.collect())


def test_whole_table_as_by_walking(spark, table, plain):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    assert reported(queries.op13_token_alignment(spark, "/root/testdata/sf0.001")) == brute(rows, plain)


def test_odd_texts(docs, plain):
    texts = [
        None, "", " ", "  two  spaces ", "▁ is a space elsewhere", "a▁b", "tab\tand\nline\r\n",
        "<|endoftext|> is text, <s> and </s> too <unk>", "été naïve ß", "é 你好 \U0001f600\U0001f468‍\U0001f469",
        "\x00 \x01 nul", "ﬁ ① Å", "word " * 5000, "x" * 3000, "same", "same", "same",
        "".join(chr(c) for c in range(1, 256)), "​﻿", "it's we'LL 12345 3.14", "<0x41> 0x41",
    ]
    ids = [*range(len(texts) - 2), None, 3]
    got = reported(alignment.align_report(docs(texts, ids=ids), FILES))
    assert got == brute(list(zip(ids, texts, strict=True)), plain)
    assert sum(got.values()) == len(texts)


def test_small_batches_and_random_texts(docs, plain, monkeypatch):
    monkeypatch.setattr(alignment, "BATCH_CHARS", 40)
    rng = random.Random(5)
    parts = ["the", " ", "  ", "ing", "ä", "\n", "12", "'s", "Z", "Ж", "▁", "!?", "\x85", "\xa0"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(0, 30))) for _ in range(300)]
    got = reported(alignment.align_report(docs(texts), FILES))
    assert got == brute(list(enumerate(texts)), plain)


def test_both_readers_of_the_ranks_agree():
    side = alignment._both(FILES)[0]
    rng = random.Random(7)
    texts = ["".join(chr(rng.choice((32, rng.randrange(1, 256)))) for _ in range(60)) for _ in range(500)]
    texts += ["".join(rng.choices("ab ' \n\t\xa0\x85\x1c\xb2\xaa9.", k=40)) for _ in range(500)]
    library = [x.ids for x in side.whole.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
    assert side.encode(texts) == library


def test_spans_and_clashing_columns(docs, plain):
    rows = docs(["one word", None, "héllo  wörld", "a▁b"]).withColumnRenamed("block", "a_ids")
    out = sorted(alignment.align(rows, FILES).collect(), key=lambda r: r["doc_id"])
    assert out[0].asDict().keys() >= {"lang", "a_ids", "b_ids", "a_cuts", "b_cuts", "n"}
    for row in out:
        assert len(row["a_cuts"]) == len(row["b_cuts"])
        for side, cuts, read in (("a_ids", "a_cuts", plain[0]), ("b_ids", "b_cuts", plain[1])):
            if row["doc_id"] in (1, 3):
                assert row[side] == [] == row[cuts]
                continue
            tokens = read(row["text"])
            assert row[side] == [i for i, _ in tokens] and row[cuts][-1] == len(tokens)
        if row["a_cuts"]:
            a, b = plain[0](row["text"]), plain[1](row["text"])
            for i, j in zip(row["a_cuts"], row["b_cuts"], strict=True):
                assert b"".join(x for _, x in a[:i]) == b"".join(x for _, x in b[:j])


def test_empty_table(docs):
    assert alignment.align_report(docs([]), FILES).count() == 0
    assert alignment.align(docs([]), FILES).count() == 0
