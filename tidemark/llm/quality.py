"""Quality classifier: a convolutional network over bytes, in numpy.

A text is cut into overlapping chunks that cover all of it. Learned filters slide
over the bytes of a chunk; the strongest response of each filter and the share of
the chunk that is filled go through a small hidden layer to the chunk's evidence
of poor quality. The strongest chunk decides for the document, and the share of
good labels in training sets the prior.

Fitting uses a bounded sample (``ROWS`` labelled rows of each class, picked by the
hash of their id) and all chunks of these; the strongest is found by a full forward
pass in every step. Scoring covers every byte of every text and is a map over the rows
without any shuffle.

Defined cases: null or empty texts are scored as one empty chunk; null labels are
left out, and of several labels of a document the lowest counts; without labels of
both classes every score is the share of good labels (0.5 without any); a null id
counts as an empty text in the choice of held-out rows. Only the named columns
are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK, STEP, WIDTH, FILTERS, HIDDEN = 512, 448, 5, 24, 16
ROWS, STEPS, BATCH, RATE = 1200, 400, 64, 0.02
THRESHOLD = 0.3


def chunks(data: bytes) -> np.ndarray:
    """Overlapping chunks of ``data``, a row each; bytes 0 fill up the last."""
    n = max(1, -(-(len(data) - (CHUNK - STEP)) // STEP))
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.as_strided(padded, (n, CHUNK), (STEP, 1))


@dataclass
class Network:
    """``table[j, b]`` is what byte ``b`` at offset ``j`` adds to each filter."""

    table: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    prior: float  # log odds of a good label
    constant: float | None = None

    @staticmethod
    def start(prior: float, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        table = normal(WIDTH, 256, FILTERS, scale=0.4)
        table[:, 0] = 0  # filling shows nothing
        return Network(
            table,
            normal(FILTERS + 1, HIDDEN, scale=0.2),
            np.zeros(HIDDEN, np.float32),
            normal(HIDDEN, scale=0.2),
            np.zeros(1, np.float32),
            prior,
        )

    def responses(self, rows: np.ndarray) -> np.ndarray:
        """Every filter at every place of every chunk."""
        places = CHUNK - WIDTH + 1
        total = self.table[0].take(rows[:, :places], axis=0)
        for j in range(1, WIDTH):
            total += self.table[j].take(rows[:, j : j + places], axis=0)
        return total

    def pooled(self, rows: np.ndarray, block: int = 64) -> np.ndarray:
        """The strongest response of each filter, at least 0, and the filled share."""
        out = np.empty((len(rows), FILTERS + 1), np.float32)
        for at in range(0, len(rows), block):
            part = rows[at : at + block]
            out[at : at + block, :FILTERS] = self.responses(part).max(axis=1)
            out[at : at + block, FILTERS] = (part != 0).mean(axis=1)
        return np.maximum(out, 0, out=out)

    def evidence(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hidden layer and evidence of poor quality for each chunk."""
        hidden = np.tanh(pooled @ self.w1 + self.b1)
        return hidden, hidden @ self.w2 + self.b2

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability of a good label for each text."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        cut = [chunks(t) for t in texts]
        starts = np.cumsum([0, *map(len, cut)])[:-1]
        each = np.concatenate([self.pooled(c) for c in _joined(cut)])
        _, evidence = self.evidence(each)
        worst = np.maximum.reduceat(evidence, starts).astype(np.float64)
        return 1 / (1 + np.exp(np.clip(worst - self.prior, -500, 500)))


def _joined(cut: list[np.ndarray], rows: int = 256) -> Iterator[np.ndarray]:
    """Chunks of several texts together, so that short texts share a step."""
    held: list[np.ndarray] = []
    size = 0
    for part in cut:
        held.append(part)
        size += len(part)
        if size >= rows:
            yield np.concatenate(held) if len(held) > 1 else held[0]
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def fit(texts: list[bytes], labels: np.ndarray, prior: float) -> Network:
    """Train on texts with labels 1 (good) and 0, by Adam on the log loss."""
    net = Network.start(prior)
    rng = np.random.default_rng(11)
    data = [chunks(text) for text in texts]
    poor = 1 - labels.astype(np.float32)
    names = ("table", "w1", "b1", "w2", "b2")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    step = 0
    while step < STEPS:
        order = rng.permutation(len(data))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            starts = np.cumsum([0, *(len(data[i]) for i in chosen)])
            rows = np.concatenate([data[i] for i in chosen])
            pooled = np.concatenate([net.pooled(rows[i : i + 64]) for i in range(0, len(rows), 64)])
            hidden, evidence = net.evidence(pooled)
            worst = np.array(
                [a + int(evidence[a:b].argmax()) for a, b in zip(starts, starts[1:], strict=False)]
            )
            error = 1 / (1 + np.exp(-np.clip(evidence[worst], -30, 30))) - poor[chosen]
            error = (error / len(chosen)).astype(np.float32)
            h, x = hidden[worst], pooled[worst]
            back = error[:, None] * net.w2 * (1 - h * h)
            to_filters = (back @ net.w1.T)[:, :FILTERS] * (x[:, :FILTERS] > 0)
            grad = {
                "w2": h.T @ error,
                "b2": error.sum(keepdims=True),
                "w1": x.T @ back,
                "b1": back.sum(0),
                "table": np.zeros_like(net.table),
            }
            spot = net.responses(rows[worst]).argmax(axis=1)
            lane = np.arange(len(worst))[:, None]
            for j in range(WIDTH):
                seen = rows[worst][lane, spot + j]
                np.add.at(grad["table"][j], (seen, np.arange(FILTERS)[None, :]), to_filters)
            grad["table"][:, 0] = 0
            step += 1
            for k in names:
                first[k] += 0.1 * (grad[k] - first[k])
                second[k] += 0.01 * (grad[k] ** 2 - second[k])
                size = np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8
                getattr(net, k)[...] -= RATE * (first[k] / (1 - 0.9**step)) / size
    return net


def held_out(doc_id: str, parts: int = 5, part: int = 0) -> Column:
    """Whether the checksum of the id falls to the part kept from training."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == part


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Network:
    """Fit on up to ``rows`` labelled documents of each class, none held out."""
    known = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    good, bad = counts.get(1, 0), counts.get(0, 0)
    if not good or not bad:
        net = Network.start(0.0)
        net.constant = good / (good + bad) if good + bad else 0.5
        return net
    picks = [
        known.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        for c in (0, 1)
    ]
    picked = picks[0].unionByName(picks[1])  # at most 2 * rows ids, so it may be broadcast
    sample = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(picked), "doc_id")
        .select("doc_id", "quality", F.xxhash64("text").alias("h"), F.col("text").cast("binary").alias("text"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "h")
        .limit(2 * rows)
        .toArrow()
    )
    texts = [x.as_py() for x in sample["text"]]
    truth = np.array(sample["quality"].to_pylist(), np.float32)
    if not texts or truth.min() == truth.max():
        net = Network.start(0.0)
        net.constant = good / (good + bad)
        return net
    return fit(texts, truth, float(np.log(good / bad)))


def classify(
    docs: DataFrame, net: Network, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; other columns as they were."""
    inner = {c: f"own{i}" for i, c in enumerate(docs.columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias(v) for c, v in inner.items()])
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(at).cast(pa.large_binary())
            scores, held, size = [np.empty(0)], [], 0
            for value in column:
                held.append(value.as_py() or b"")
                size += len(held[-1])
                if size >= 1 << 20:
                    scores.append(net.score(held))
                    held, size = [], 0
            if held:
                scores.append(net.score(held))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(scores), pa.float64())],
                [*batch.schema.names, "score"],
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    scored = plain.mapInArrow(run, f"{schema}, score double")
    return scored.select(
        *[F.col(v).alias(c) for c, v in inner.items() if c not in ("score", "predicted")],
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
