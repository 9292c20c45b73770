import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import queries, spelling

TO_LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)


def counted(rows):
    """Words and counts, occurrence by occurrence."""
    seen = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(TO_LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            seen[run[:at] + run[at + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in seen.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute(words):
    """Rows by comparing all pairs of words of like length."""
    by_size, forms, rows = {}, {}, {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    for w, n in words.items():
        near = [x for k in (-1, 0, 1) for x in by_size.get(len(w) + k, ()) if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if near and words[best] >= 10 * n else None
        rows[w] = [n, len(near), forms[w], words.get(forms[w])]
    for w, row in rows.items():
        root = w
        while forms[root]:
            root = forms[root]
        row.append(root)
    return {(w, *row) for w, row in rows.items()}


def found(df):
    rows = [(r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_table_as_all_pairs(spark, table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    want = brute(counted(rows))
    assert sum(r[2] > 0 for r in want) > 50
    assert found(queries.op12_spelling_variants(spark, "/root/testdata/sf0.001")) == want


@pytest.mark.parametrize("seed", range(3))
def test_crowded_tries(spark, seed):
    """Few letters, so that words share long beginnings and ends and many links exist."""
    rng = random.Random(seed)
    words = {"".join(rng.choices("abé", k=rng.randrange(7, 12))) for _ in range(500)}
    sized = {w: rng.choice((2, 3, 20, 30, 300, 4000)) for w in words}
    df = spark.createDataFrame(list(sized.items()), "word string, n long")
    want = brute(sized)
    assert any(r[5] not in (r[0], r[3]) for r in want if r[3])
    assert found(spelling.grouped(df)) == want


def test_long_words(spark):
    rng = random.Random(3)
    base = ["".join(rng.choices("abcdefgh", k=k)) for k in (45, 46, 47, 48, 49, 60, 700)]
    sized = {}
    for w in base:
        sized[w] = 500
        for _ in range(6):
            i = rng.randrange(len(w))
            for other in (w[:i] + w[i + 1 :], w[:i] + "x" + w[i + 1 :], w[:i] + "y" + w[i:]):
                sized[other] = rng.choice((2, 40, 60))
    sized["a" * 48], sized["a" * 47], sized["a" * 49] = 2, 30, 900
    df = spark.createDataFrame(list(sized.items()), "word string, n long")
    assert found(spelling.grouped(df)) == brute(sized)


def test_star_of_variants(spark):
    """Many variants of one word, most of them not near each other."""
    sized = {"wunderbar": 100_000}
    for i in range(9):
        for c in "abcdefghijklmnopqrstuvwxyzäöü":
            sized["wunderbar"[:i] + c + "wunderbar"[i + 1 :]] = 5
            sized["wunderbar"[:i] + c + "wunderbar"[i:]] = 6
    sized["wunderbar"] = 100_000
    df = spark.createDataFrame(list(sized.items()), "word string, n long").repartition(7)
    assert found(spelling.grouped(df)) == brute(sized)


def test_odd_rows(docs):
    texts = [
        None, "", "   \n", "123 !!", "kurz", "Straßenbahn straßenbahn STRASSENBAHN ÉCOLIÈRES écolières",
        "letters×and÷signs letters×and÷signs", "tie-break tiebreak tiebreak tiebreakx tiebreakx",
        "x" * 3000 + " " + "x" * 3000, "repeated repeated", "repeated repeated", "日本語の文章です repeats repeats",
    ]
    ids = [*range(len(texts) - 2), None, 3]
    frame = docs(texts, ids=ids).withColumnRenamed("block", "word").withColumnRenamed("lang", "root")
    assert found(spelling.variants(frame)) == brute(counted(zip(ids, texts)))
    assert spelling.variants(docs([])).count() == 0
    assert spelling.variants(docs([None, "", "short words"])).count() == 0
