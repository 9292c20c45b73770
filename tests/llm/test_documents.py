"""Near documents, repeated lines and the language model, against plain versions."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import forest, lines, pitman_yor
from tidemark.llm.text import shingle_set, word_hashes

LOW = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text):
    return (text or "").encode().translate(LOW).split()


def shingles(text):
    w = words(text)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """Component of each (id, text) by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    part = {i: i for i, _ in rows}

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = root(i), root(j)
                part[max(p, q)] = min(p, q)
    return {i: (len(s), root(i)) for i, s in sets}


def test_words_and_shingles():
    text = " The\tthe\x0bTHE É é\n\n x\x1cy  z ".encode()
    assert len(word_hashes(text)) == len(text.translate(LOW).split())
    assert len(set(word_hashes(text).tolist())) == len(set(text.translate(LOW).split()))
    for t in ("", "  ", "a", "a b c", "a b c d e f a b c d e f"):
        assert len(shingle_set(t.encode())) == len(shingles(t))
    assert shingle_set(b"a b c d e") != shingle_set(b"b a c d e")


def group(rng, n, changes):
    """A text and n copies with some words changed."""
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(changes)):
            copy[rng.randrange(len(copy))] = f"n{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("region", [4096, 8])
def test_near_documents(docs, monkeypatch, region):
    monkeypatch.setattr(forest, "REGION", region)
    rng = random.Random(9)
    texts = [None, "", "  ", "one two", "One  two", "one two three", "x " * 4000]
    for size in (2, 3, 5, 40):
        texts += group(rng, size, 6)
    texts += [" ".join(f"w{rng.randrange(5000)}" for _ in range(80)) for _ in range(30)]
    texts += texts[-3:] * 2
    rows = list(enumerate(texts))
    want = components(rows)
    got = forest.near_duplicates(docs(texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_documents_in_a_star(docs):
    """Every link runs through one text, which meets few of its copies in the forest."""
    rng = random.Random(3)
    base = [f"w{k}" for k in range(300)]
    copies = []
    for c in range(3000):
        copy = list(base)
        for k in rng.sample(range(0, 300, 6), 7):
            copy[k] = f"n{c}x{k}"
        copies.append(" ".join(copy))
    sets = [shingles(c) for c in copies]
    whole = shingles(" ".join(base))
    assert all(100 * len(s & whole) >= 75 * len(s | whole) for s in sets)
    texts = copies[:1500] + [" ".join(base)] + copies[1500:]
    got = forest.near_duplicates(docs(texts)).collect()
    assert {r["component_id"] for r in got} == {0}


@pytest.mark.parametrize("region", [4096, 8])
def test_near_documents_among_sharers_of_a_passage(docs, monkeypatch, region):
    """Pairs near the threshold among many texts that share a passage."""
    monkeypatch.setattr(forest, "REGION", region)
    monkeypatch.setattr(forest, "LIST", 64)
    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(100))
    texts = []
    for c in range(300):
        own = [f"o{c}x{k}" for k in range(60)]
        texts.append(passage + " " + " ".join(own))
        if c % 3 == 0:
            for k in rng.sample(range(2, 58, 8), 4):
                own[k] = f"e{c}x{k}"
            texts.append(passage + " " + " ".join(own))
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = components(rows)
    assert len({part for _, part in want.values()}) == 300
    got = forest.near_duplicates(docs(texts)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_near_documents_that_stand_alone_do_not_travel(docs, monkeypatch):
    told, marked = {}, forest._marked

    def noting(firsts, parts):
        told.update({r["rep"]: r["told"] for r in firsts.collect()})
        return marked(firsts, parts)

    monkeypatch.setattr(forest, "_marked", noting)
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(9999)}" for _ in range(60)) for _ in range(20)]
    texts += [texts[4] + " more", texts[7], None, ""]
    got = {r["doc_id"]: r["component_id"] for r in forest.near_duplicates(docs(texts)).collect()}
    assert got == {i: {20: 4, 21: 7}.get(i, i) for i in range(24)}
    assert {i for i, yes in told.items() if yes} == {4, 20, 21}


def test_near_documents_odd_ids(docs):
    frame = docs(["a b", "a b", "a b", "c"], ids=[None, 2, 2, 1])
    got = sorted((str(r[0]), r[1], str(r[2])) for r in forest.near_duplicates(frame).collect())
    assert got == [("1", 1, "1"), ("2", 1, "2"), ("2", 1, "2"), ("None", 1, "None")]
    assert forest.near_duplicates(docs([])).count() == 0


def test_near_documents_on_the_table(table):
    rows = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    got = forest.near_duplicates(table("documents")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == components(rows)


def gone_lines(rows):
    """Lines that an earlier one matches, by comparing all pairs."""
    seen, gone = [], {}
    for i, text in rows:
        gone[i] = []
        for k, line in enumerate((text or "").split("\n")):
            w = {x for x in line.replace("\t", " ").split(" ") if x}
            if len(w) >= lines.LEAST_WORDS:
                if any(100 * len(w & v) >= 75 * len(w | v) for v in seen):
                    gone[i].append(k)
                seen.append(w)
    return gone


def test_repeated_lines(docs, monkeypatch):
    monkeypatch.setattr(lines, "HOT_SHARE", 1 / 50)
    rng = random.Random(4)
    pool = group(rng, 4, 40) + group(rng, 6, 9) + ["a b c d", "the same five words here", "\t"]
    pool += [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 30))) for _ in range(60)]
    texts = [None, "", "\n\n"]
    texts += ["\n".join(rng.choices(pool, k=rng.randrange(1, 8))) for _ in range(60)]
    rows = list(enumerate(texts))
    want = gone_lines(rows)
    got = lines.line_report(docs(texts)).collect()
    assert {r["doc_id"]: r["removed_lines"] for r in got} == want
    assert all(r["n_removed"] == len(want[r["doc_id"]]) for r in got)
    frame = docs(texts)
    kept = lines.without_repeats(frame)
    assert kept.columns == frame.columns
    cut = {r["doc_id"]: r for r in kept.collect()}
    for i, text in rows:
        split = (text or "").split("\n")
        if want[i] and len(want[i]) == len(split):
            assert i not in cut
        elif want[i]:
            left = "\n".join(x for k, x in enumerate(split) if k not in want[i])
            assert (cut[i]["text"], cut[i]["n_chars"]) == (left, len(left))
        else:
            assert cut[i]["text"] == text and cut[i]["block"] == "own"


def test_lines_that_share_two_rare_words_are_no_candidates(docs):
    often = [" ".join([f"c{k}"] * 64) for k in range(560)]
    apart = ["r1 r2 " + " ".join(f"c{k}" for k in range(i, 560, 20)) for i in range(20)]
    alike = [" ".join(f"a{k}" for k in range(30)), " ".join(f"a{k}" for k in range(4, 30))]
    found = lines.line_sets(docs(often + apart + alike))
    place = lines.F.struct("doc", "h", "line")
    classes = found.groupBy("class").agg(
        lines.F.min(place).alias("first"), lines.F.count("*").alias("lines")
    )
    assert lines._candidates(found, classes, found.count()).count() == 1


def test_near_copies_of_a_line_are_not_compared_pair_by_pair(docs, monkeypatch):
    compared, verified = [], lines._verified

    def counting(pairs, classes, rows):
        compared.append(pairs.count())
        return verified(pairs, classes, rows)

    monkeypatch.setattr(lines, "_verified", counting)
    texts = [" ".join([*(f"b{k}" for k in range(40)), f"own{i}"]) for i in range(60)]
    got = {r["doc_id"]: r["n_removed"] for r in lines.line_report(docs(texts)).collect()}
    assert got == {i: int(i > 0) for i in range(60)}
    assert sum(compared) < 120


def test_near_copies_of_a_line_do_not_meet_in_the_join(docs, monkeypatch):
    met, candidates = [], lines._candidates

    def counting(*args):
        pairs = candidates(*args)
        met.append(pairs.count())
        return pairs

    monkeypatch.setattr(lines, "_candidates", counting)
    texts = [" ".join([*(f"b{k}" for k in range(40)), f"own{i}"]) for i in range(60)]
    got = {r["doc_id"]: r["n_removed"] for r in lines.line_report(docs(texts)).collect()}
    assert got == {i: int(i > 0) for i in range(60)}
    assert sum(met) < 240  # of 1,770 pairs


def line_classes(found):
    place = lines.F.struct("doc", "h", "line")
    return found.groupBy("class").agg(
        lines.F.min(place).alias("first"), lines.F.count("*").alias("lines")
    )


def test_long_lines_that_share_rare_words_are_no_candidates(docs):
    rng = random.Random(8)
    texts = [" ".join(f"w{k}" for k in rng.sample(range(400), 130)) for _ in range(40)]
    alike = [f"a{k}" for k in range(130)]
    found = lines.line_sets(docs([*texts, " ".join(alike), " ".join(alike[9:])]))
    assert lines._candidates(found, line_classes(found), found.count()).count() == 1


def test_pairs_with_a_covered_later_line_do_not_meet(docs):
    base = [f"b{k}" for k in range(40)]
    found = lines.line_sets(docs([" ".join([*base, f"own{i}"]) for i in range(30)]))
    covered = found.where("doc BETWEEN 10 AND 28").select(lines.F.col("class").alias("later"))
    pairs = lines._candidates(found, line_classes(found), found.count(), covered)
    place = {r["class"]: r["doc"] for r in found.collect()}
    met = {tuple(sorted((place[r["class"]], place[r["class2"]]))) for r in pairs.collect()}
    open_ = [*range(10), 29]
    assert met == {(a, b) for b in open_ for a in range(b)}


def test_repeated_long_lines(docs):
    rng = random.Random(9)
    texts = []
    for size in (70, 79, 80, 90, 130, 250):
        for _ in range(3):
            base = [f"w{k}" for k in rng.sample(range(900), size)]
            for _ in range(5):
                kept = rng.sample(base, size - rng.randrange(size // 4 + 1))
                extra = [f"x{rng.randrange(900)}" for _ in range(rng.randrange(size // 8 + 1))]
                texts.append(" ".join([*kept, *extra]))
    rng.shuffle(texts)
    texts += [texts[3], None, texts[0] + "\n" + texts[5]]
    want = gone_lines(list(enumerate(texts)))
    got = lines.line_report(docs(texts)).collect()
    assert {r["doc_id"]: r["removed_lines"] for r in got} == want
    assert 20 < sum(map(len, want.values())) < len(texts)


def test_plans_of_lines_do_not_spell_out_the_rarity_of_words(docs):
    plan = lines.line_sets(docs(["one two three four five"]))._jdf.queryExecution().toString()
    assert len(plan) < 100_000


def test_repeated_short_lines(docs):
    texts = ["Les.\na b\na b c\n\n ", "Les.\nb a\na b c d\n\n ", "Les\na\nd c b x\nLes."]
    got = {r["doc_id"]: r["removed_lines"] for r in lines.line_report(docs(texts)).collect()}
    assert got == {0: [], 1: [0, 1, 2], 2: [3]}


def test_repeated_lines_odd_ids(docs):
    line = "one two three four five six"
    frame = docs([line, line, line, line], ids=[7, 7, None, 9])
    got = {(r["doc_id"], r["n_removed"]) for r in lines.line_report(frame).collect()}
    assert got == {(7, 0), (9, 1), (None, 1)}
    assert lines.line_report(docs([])).count() == 0
    assert lines.without_repeats(docs([])).count() == 0


def test_repeated_lines_on_the_table(table):
    rows = sorted((r["doc_id"], r["text"]) for r in table("documents").collect())
    got = lines.line_report(table("documents")).collect()
    assert {r["doc_id"]: r["removed_lines"] for r in got} == gone_lines(rows)


def base_scores(rows):
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    tokens = {i: [*words(t), None] for i, t in rows}
    seen = Counter(x for i, t in tokens.items() if not held[i] for x in t)
    n, v = sum(seen.values()), len(seen)
    return {
        i: (
            held[i], len(t), sum(seen[x] > 0 for x in t), n,
            sum(math.log10((seen[x] + 1) / (n + v + 1)) for x in t),
        )
        for i, t in tokens.items()
    }


@pytest.mark.parametrize("bucket", [8 << 20, 20_000])
def test_language_model(table, monkeypatch, bucket):
    monkeypatch.setattr(pitman_yor, "BUCKET_CHARS", bucket)
    rows = [(r["doc_id"], r["text"]) for r in table("documents").collect()]
    want = base_scores(rows)
    got = pitman_yor.score_documents(table("documents")).collect()
    assert len(got) == len(rows)
    for r in got:
        held, n, known, total, base = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held, n, known, total,
        )
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
    out = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    assert all(-math.inf < r["score"] < 0 for r in got)


def test_language_model_deals_buckets_to_partitions(docs, monkeypatch):
    monkeypatch.setattr(pitman_yor, "BUCKET_CHARS", 1000)
    frame = docs([" ".join(f"w{i}x{k}" for k in range(100)) for i in range(30)])
    chars = sum(r["n_chars"] for r in frame.collect())
    got = pitman_yor.score_documents(frame)
    plan = got._jdf.queryExecution().toString()
    dealt = re.findall(r"hashpartitioning\(bucket#\d+L?, (\d+)\)", plan)
    assert dealt and set(map(int, dealt)) == {-(-chars // 1000)}
    assert got.count() == 30


def test_language_model_odd_rows(docs):
    frame = docs([None, "", "a A a", "b " * 3000, "same", "same"], ids=[None, 1, 2, 3, 4, 4])
    got = pitman_yor.score_documents(frame).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 2, 2, 4, 3001]
    assert pitman_yor.score_documents(docs([])).count() == 0
    alone = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:1]
    only = pitman_yor.score_documents(docs(["a b"], ids=alone)).first()
    assert only["train_tokens"] == 0 and only["score"] <= 0 and only["base_score"] == 0


@pytest.mark.parametrize("bucket", [8 << 20, 4_000])
def test_every_word_has_its_own_followers(docs, monkeypatch, bucket):
    """Words below the share of frequent ones are told apart as contexts."""
    monkeypatch.setattr(pitman_yor, "SHARE", 0.01)
    monkeypatch.setattr(pitman_yor, "BUCKET_CHARS", bucket)
    held = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 7 == 2]
    fit = [i for i in range(9000) if zlib.crc32(str(i).encode()) % 7 != 2]
    pairs = [(f"a{i}", f"b{i}") for i in range(700)]
    known = [f"{a} {b}" for a, b in pairs * 3]
    asked = known[:300] + [f"{pairs[i][0]} {pairs[i + 1][1]}" for i in range(300)]
    frame = docs(known + asked, ids=fit[: len(known)] + held[: len(asked)])
    got = {r["doc_id"]: r["score"] for r in pitman_yor.score_documents(frame).collect()}
    scores = [got[i] for i in held[: len(asked)]]
    gaps = [x - y for x, y in zip(scores[:300], scores[300:], strict=True)]
    # the follower has (3 - d) / 4 of its own, the other word a share of what is left
    assert min(gaps) > 2.2, sorted(gaps)[:5]


def test_seating_stays_within_bounds():
    rng = np.random.default_rng(1)
    customers = np.array([0, 1, 2, 50, 10**6])
    tables = pitman_yor.seat(customers, np.full(5, 0.5), 0.8, rng)
    assert (tables <= customers).all() and (tables[1:] >= 1).all() and tables[0] == 0
    # expected tables of a Pitman-Yor restaurant grow as a power of its customers
    runs = [pitman_yor.seat(np.full(400, 2000), np.full(400, 1.0), 0.0, rng).mean()]
    assert runs[0] == pytest.approx(sum(1 / (1 + i) for i in range(2000)), rel=0.05)
