import numpy as np
import pytest

from tidemark.llm import pivots
from tidemark.llm.components import components

KIND = "vec_id long, embedding array<float>, label int, n long, key string"


def brute(rows, threshold=0.98):
    """Counts and components by comparing all pairs."""
    links, part = {}, {}
    good = []
    for k, (i, v, lab) in enumerate(rows):
        fine = v and lab is not None and i is not None and None not in v
        fine = fine and np.isfinite(v).all() and np.abs(v).max() > 0
        links[k], part[k] = 0, i
        if fine:
            x = np.array(v, np.float32).astype(float)
            good.append((k, x / np.linalg.norm(x), lab, i))
    for k, x, lab, _ in good:
        links[k] = sum(m == lab and len(x) == len(y) and x @ y >= threshold for _, y, m, _ in good) - 1
    while True:
        old = dict(part)
        for k, x, lab, _ in good:
            for j, y, m, _ in good:
                if m == lab and len(x) == len(y) and x @ y >= threshold:
                    part[k] = min(part[k], part[j])
        if part == old:
            return [(i, links[k], part[k]) for k, (i, _, _) in enumerate(rows)]


def found(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "k") for r in rows], KIND)
    out = pivots.near_duplicates(frame).collect()
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out if r["vec_id"] is not None)
    key = lambda r: (r[0] is None, r)
    return sorted([(r["vec_id"], r["n_links"], r["component_id"]) for r in out], key=key)


@pytest.mark.parametrize("block", [512, 8])
def test_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(pivots, "BLOCK", block)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(60, 16))
    near = base[rng.integers(0, 6, 120)] + rng.normal(size=(120, 16)) * 0.12
    values = np.concatenate([base, near, base[:20], base[:10] * 2]).tolist()
    rows = [(i, v, i % 2) for i, v in enumerate(values)]
    got, want = found(spark, rows), sorted(brute(rows))
    assert sum(r[1] for r in got) >= 0.9 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g != w for g, w in zip(got, want, strict=True)) <= 0.1 * len(want)


def test_odd_vectors(spark):
    one = [1.0] + [0.5] * 7
    rows = [
        (1, one, 0), (2, one, 0), (3, one, None), (4, None, 0), (5, [0.0] * 8, 0), (6, [], 0),
        (7, [float("nan")] + one[1:], 0), (8, [float("inf")] + one[1:], 0), (9, [None] + one[1:], 0),
        (10, one, 1), (11, [2 * x for x in one], 0), (12, [1.0, 0.5], 0), (13, [-0.0] * 8, 0),
    ]
    assert found(spark, rows) == sorted(brute(rows))
    assert found(spark, rows[3:6]) == [(4, 0, 4), (5, 0, 5), (6, 0, 6)]
    assert found(spark, [(None, one, 0), (1, one, 0)]) == [(1, 0, 1), (None, 0, None)]
    assert found(spark, []) == []


def test_vectors_of_several_lengths(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=8).tolist(), 0) for i in range(30)]
    for at, width, number in ((100, 6, 2), (200, 2, 1), (300, 3, 3), (400, 5, 12)):
        base = rng.normal(size=width)
        rows += [(at + k, (base + rng.normal(size=width) * 0.01).tolist(), 0) for k in range(number)]
    got = found(spark, rows)
    assert got == sorted(brute(rows))
    assert [r[1] for r in got if 100 <= r[0] < 400] == [1, 1, 0, 2, 2, 2]


def test_recall_on_the_table(table):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in table("embeddings").collect()]
    out = pivots.near_duplicates(table("embeddings"))
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in out.collect())
    want = sorted(brute(rows))
    assert sum(g == w for g, w in zip(got, want, strict=True)) >= 0.9 * len(want)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    star = [(200, i) for i in range(201, 260)]
    out = components(spark.createDataFrame(chain + star, "a long, b long"))
    got = {r["id"]: r["component"] for r in out.collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100} | {
        i: 200 for i in range(200, 260)
    }
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
