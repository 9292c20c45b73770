import numpy as np

from tidemark.llm import quality


def test_chunks_cover_every_byte():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        data = bytes(i % 255 + 1 for i in range(n))
        cut = quality.chunks(data)
        back = b"".join(bytes(c[: quality.STEP]) for c in cut[:-1]) + bytes(cut[-1])
        assert back.rstrip(b"\0") == data


def test_learns_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    net = quality.train(docs, labels)
    scored = quality.classify(docs.select("doc_id", "text"), net)
    met = scored.join(labels, "doc_id").where(quality.held_out("doc_id")).toPandas()
    assert len(met) > 50
    assert (met.predicted == met.quality).mean() > 0.9
    assert met.score.between(0, 1).all()


def test_a_poor_stretch_anywhere_decides():
    rng = np.random.default_rng(1)
    clean = [" ".join(rng.choice(["the", "river", "runs", "by", "stone."], 90)) for _ in range(300)]
    poor = [t + " ### $$$ %%% ###" * 6 for t in clean[:150]]
    labels = np.array([0.0] * 150 + [1.0] * 150)
    net = quality.fit([t.encode() for t in poor + clean[150:]], labels, 0.0)
    long_text = " ".join(clean).encode()
    spoilt = long_text[:60_000] + b" ### $$$ %%% ###" * 20 + long_text[60_000:]
    good, bad = net.score([long_text, spoilt])
    assert good > 0.5 > bad


def test_learns_from_a_stretch_anywhere_in_long_texts():
    rng = np.random.default_rng(2)
    words = ["the", "river", "runs", "by", "stone."]
    texts, labels = [], []
    for k in range(120):
        text = " ".join(rng.choice(words, 2000)).encode()
        at = int(rng.integers(0, len(text)))
        texts.append(text[:at] + b" ### $$$ %%% ###" * 6 + text[at:] if k % 2 else text)
        labels.append(1 - k % 2)
    net = quality.fit(texts[:80], np.array(labels[:80], np.float32), 0.0)
    assert ((net.score(texts[80:]) > 0.5) == np.array(labels[80:], bool)).all()


def test_odd_rows_and_labels(spark, docs):
    frame = docs([None, "", "x", "y" * 5000, "same", "same"], ids=[None, 1, 2, 3, 4, 4])
    kinds = "doc_id long, quality int, toxic int"
    for rows in ([], [(2, None, 0)], [(2, 1, 0), (3, 1, 0)]):
        net = quality.train(frame, spark.createDataFrame(rows, kinds))
        out = quality.classify(frame, net)
        found = out.collect()
        assert len(found) == 6 and {r["block"] for r in found} == {"own"}
        assert {r["score"] for r in found} == {1.0 if len(rows) == 2 else 0.5}
    net = quality.train(frame, spark.createDataFrame([(2, 1, 0), (3, 0, 0), (3, 1, 0)], kinds))
    found = {r["doc_id"]: r["score"] for r in quality.classify(frame, net).collect()}
    assert all(0 <= s <= 1 for s in found.values())
    assert quality.classify(docs([]), net).count() == 0
