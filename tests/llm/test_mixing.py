from collections import Counter

from tidemark.llm import mixing


def test_less_than_one_block_from_share(docs):
    sources = ["a"] * 60 + ["b"] * 30 + ["c"] * 10
    rows = mixing.mix(docs(["x"] * 100, sources=sources), {"a": 6, "b": 3, "c": 1}).collect()
    order = [r["source"] for r in sorted(rows, key=lambda r: r["slot"])]
    assert [r["slot"] for r in sorted(rows, key=lambda r: r["slot"])] == list(range(100))
    for t in range(1, 101):
        got = Counter(order[:t])
        for source, share in (("a", 0.6), ("b", 0.3), ("c", 0.1)):
            assert abs(got[source] - share * t) < 1
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in rows)


def test_deviation_with_many_odd_weights(docs):
    weights = {f"s{i}": w for i, w in enumerate([1, 7, 13, 29, 50])}
    sources = [s for s in weights for _ in range(weights[s])]
    rows = mixing.mix(docs(["x"] * 100, sources=sources), weights).collect()
    order = [r["source"] for r in sorted(rows, key=lambda r: r["slot"])]
    for t in range(1, 101):
        got = Counter(order[:t])
        assert all(abs(got[s] - w * t / 100) < 1 for s, w in weights.items())


def deviation(rows, weights):
    """Most blocks that a source is away from its weight after any slot; none may be empty."""
    order = [r["source"] for r in sorted(rows, key=lambda r: r["slot"])]
    assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
    total, got, worst = sum(weights.values()), Counter(), 0
    for t, taken in enumerate(order, 1):
        got[taken] += 1
        worst = max(worst, *[abs(got[s] * total - w * t) for s, w in weights.items()])
    return worst / total


def test_exact_weights_over_several_stretches(docs):
    weights = {"a": 3331, "b": 313, "c": 89, "d": 2}
    sources = [s for s in weights for _ in range(weights[s])]
    assert deviation(mixing.mix(docs(["x"] * len(sources), sources=sources), weights).collect(), weights) < 1


def test_default_weights_are_not_rounded_to_a_period(docs):
    """One large source among small ones: the roots themselves are met, slot by slot."""
    sizes = {"big": 3600, **{f"s{i}": 1 for i in range(20)}}
    sources = [s for s in sizes for _ in range(sizes[s])]
    rows = mixing.mix(docs(["x"] * len(sources), sources=sources)).collect()
    # 60 of every 80 slots are the large source's, as long as it lasts
    big = sorted(r["slot"] for r in rows if r["source"] == "big")
    assert all(abs((i + 1) - (slot + 1) * 0.75) < 1 for i, slot in enumerate(big))


def test_common_divisor_and_slots_beyond_the_corpus(docs):
    frame = docs(["x"] * 30, sources=["a", "b", "c"] * 10)
    slots = [
        sorted((r["source"], r["block"], r["slot"]) for r in mixing.mix(frame, w).collect())
        for w in ({"a": 3, "b": 2, "c": 1}, {"a": 3 * 10**9, "b": 2 * 10**9, "c": 10**9})
    ]
    assert slots[0] == slots[1]
    # a period of a billion slots is scheduled only as far as 30 rows reach
    prime = {"a": 500_000_003, "b": 400_000_009, "c": 300_000_007}
    rows = mixing.mix(frame, prime).collect()
    assert len(rows) == 30 and all(r["release"] <= r["slot"] < r["deadline"] for r in rows)


def test_nulls_repeats_and_exhausted_sources(docs):
    frame = docs([None, "", "x", "x"], ids=[None, 1, 2, 2], sources=[None, "a", "a", "a"])
    rows = mixing.mix(frame).collect()
    assert len(rows) == 4 and len({r["slot"] for r in rows}) == 4
    assert {r["n"] for r in rows} == {7}


def test_blocks_of_several_rows(docs):
    rows = mixing.mix(docs(["x"] * 10), block_rows=4).collect()
    assert Counter(r["block"] for r in rows) == {1: 4, 2: 4, 3: 2}


def test_rows_keep_columns_and_follow_slots(docs):
    frame = docs(["x"] * 40, sources=["a", "b"] * 20)
    out = mixing.mixed_rows(frame)
    assert out.columns == frame.columns
    rows = out.collect()
    assert {r["block"] for r in rows} == {"own"} and len(rows) == 40
    for t in range(1, 41):
        assert abs(Counter(r["source"] for r in rows[:t])["a"] - t / 2) < 1


def test_empty_table(docs):
    assert mixing.mix(docs([])).count() == 0
    assert mixing.mixed_rows(docs([])).count() == 0
