"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Every word is drawn from the restaurant of the word before it. All restaurants
share a parent, whose customers are their tables; the parent's own base is uniform
over the known words and one unknown. Totals of the restaurants of frequent words
(at least ``SHARE`` of all training tokens, so there are 1 / SHARE at most) are known
to every task; those of all other words are exchanged by bucket.

Seating (how many tables serve each word in each restaurant) is sampled by Gibbs
sweeps: a sweep empties and refills every restaurant given the current parent, then
the parent given its new customers. Predictive probabilities are averaged over
``SAMPLES`` sweeps after ``BURN_IN``. Totals of the frequent words and their
restaurants, which many tasks contribute to, are summed over all tasks after each of
the first ``SYNCS`` sweeps and then stay. Until the last of these a bucket takes its own
customers for those of a rarer word's restaurant, which hold all its frequent dishes;
then each bucket asks the bucket of that word for the restaurant's customers and tables.

Tokens travel in compact blocks to the bucket of their word (for frequent words: of a
rarer context, or of the word and its frequent context, so that no word fills a
bucket). There pairs are counted over all training documents, seated and scored; each
bucket returns a sum for each document it has seen. Nothing but the totals of frequent
words meets in one place. There are as many partitions as buckets, since a task gets all
rows of a small partition as one batch.

Defined cases: a null or empty text is a single end token; a null id counts as an
empty text in the choice of held-out rows; repeated rows are scored each. Without
training tokens every token has the base's probability. Only the named columns are
read. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stage import store
from tidemark.llm.text import mix, word_hashes

SHARE = 1e-4
SYNCS, BURN_IN, SAMPLES = 2, 2, 3
FAR = 0xFFFF  # stands for a context that is not among the frequent words
STRENGTH = 1.0
BATCH_TOKENS, BATCH_DOCS = 1_000_000, 60_000
BUCKET_CHARS = 8 << 20
END = np.uint64(0x9D5C_0FB7_11A3_62E9)  # hash of the token that ends a text

_ZSTD = pa.Codec("zstd", compression_level=1)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether the checksum of the id leaves 2 when divided by 7."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 7 == 2


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed run of bytes."""
    sizes = np.array([len(a.tobytes()) for a in arrays], np.int64)
    raw = b"".join(a.tobytes() for a in arrays)
    return np.int64(len(raw)).tobytes() + sizes.tobytes() + _ZSTD.compress(raw, asbytes=True)


def _unpacked(data: bytes, *kinds: type) -> list[np.ndarray]:
    sizes = np.frombuffer(data, np.int64, 1 + len(kinds))
    raw = _ZSTD.decompress(data[8 * len(sizes) :], int(sizes[0]), asbytes=True)
    stops = np.cumsum(sizes[1:])
    starts = stops - sizes[1:]
    return [
        np.frombuffer(raw[a:b], kind) for a, b, kind in zip(starts, stops, kinds, strict=True)
    ]


@dataclass
class Batch:
    """Tokens of some documents; training documents come first."""

    ids: list = field(default_factory=list)
    held: list[bool] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    size: int = 0

    def add(self, doc_id: object, held: bool, text: str | None) -> None:
        self.ids.append(doc_id)
        self.held.append(held)
        self.words.append(np.append(word_hashes((text or "").encode("utf-8")), END))
        self.size += len(self.words[-1])

    def full(self) -> bool:
        return self.size >= BATCH_TOKENS or len(self.ids) >= BATCH_DOCS

    def order(self) -> list[int]:
        return sorted(range(len(self.ids)), key=lambda i: self.held[i])


def _batches(source: Iterable[pa.RecordBatch]) -> Iterator[Batch]:
    held = Batch()
    for batch in source:
        for doc_id, out, text in zip(*batch.columns, strict=True):
            held.add(doc_id.as_py(), out.as_py(), text.as_py())
            if held.full():
                yield held
                held = Batch()
    if held.ids:
        yield held


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a mixed hash; grows with the hash."""
    return ((key >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def vocabulary(rows: DataFrame, buckets: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Number of training tokens and of different ones; hashes and counts of the
    frequent words, of which there are at most 1 / SHARE.
    """

    def count(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(source):
            seen = [w for w, out in zip(batch.words, batch.held, strict=True) if not out]
            if not seen:
                continue
            words, counts = np.unique(np.concatenate(seen), return_counts=True)
            place = _bucket(words, buckets)
            stops = np.searchsorted(place, np.arange(buckets + 1))
            filled = np.flatnonzero(np.diff(stops))
            data = [
                _packed(words[stops[b] : stops[b + 1]], counts[stops[b] : stops[b + 1]])
                for b in filled
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(filled, pa.int64()), pa.array(data, pa.binary())], ["bucket", "data"]
            )

    def merge(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        mark = None

        def done() -> pa.RecordBatch:
            parts = [_unpacked(x, np.uint64, np.int64) for x in held]
            words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([p[1] for p in parts])).astype(np.int64)
            top = np.argsort(-counts, kind="stable")[: round(1 / SHARE)]
            columns = [
                pa.array([len(words)], pa.int64()),
                pa.array([int(counts.sum())], pa.int64()),
                pa.array([words[top].view(np.int64).tolist()], pa.list_(pa.int64())),
                pa.array([counts[top].tolist()], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, ["types", "tokens", "words", "counts"])

        for batch in source:
            for bucket, data in zip(*batch.columns, strict=True):
                if held and bucket.as_py() != mark:
                    yield done()
                    held = []
                mark = bucket.as_py()
                held.append(data.as_py())
        if held:
            yield done()

    counted = store(
        rows.mapInArrow(count, "bucket bigint, data binary")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(merge, "types bigint, tokens bigint, words array<bigint>, counts array<bigint>"),
        "vocabulary",
    )
    total = counted.agg(F.sum("types"), F.sum("tokens")).first()
    types, tokens = total[0] or 0, total[1] or 0
    frequent = (
        counted.select(F.explode(F.arrays_zip("words", "counts")).alias("x"))
        .where(F.col("x.counts") >= max(2, SHARE * tokens))
        .select("x.words", "x.counts")
        .toArrow()
    )
    words = frequent["words"].to_numpy().view(np.uint64)
    order = np.argsort(words)
    return types, tokens, words[order], frequent["counts"].to_numpy()[order]


def _blocks(batch: Batch, number: int, frequent: np.ndarray, buckets: int) -> list[tuple]:
    """Rows (bucket, batch, data) of a batch."""
    order = batch.order()
    train = sum(not x for x in batch.held)
    words = np.concatenate([batch.words[i] for i in order])
    sizes = np.array([len(batch.words[i]) for i in order])
    docs = np.repeat(np.arange(len(order), dtype=np.uint16), sizes)
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum(sizes) - sizes] = END

    def numbers(hashes: np.ndarray) -> np.ndarray:
        if not len(frequent):
            return np.full(len(hashes), FAR)
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        return np.where(frequent[at] == hashes, at, FAR)

    own, context = numbers(words), numbers(before)
    known, near = own != FAR, context != FAR
    bounds = np.arange(buckets + 1)

    both = known & near
    pair = (own[both].astype(np.uint64) << np.uint64(16)) | context[both].astype(np.uint64)
    place = _bucket(mix(pair + np.uint64(1)), buckets)
    by = np.argsort((place.astype(np.uint64) << np.uint64(32)) | pair, kind="stable")
    f_stops = np.searchsorted(place[by], bounds)
    f_pair, f_doc = pair[by].astype(np.uint32), docs[both][by]

    def spread(chosen: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
        """Chosen tokens by mixed hashes: places, the hashes and where buckets start."""
        mixed = mix(hashes[chosen])
        by = np.argsort(mixed, kind="stable")
        return np.flatnonzero(chosen)[by], mixed[by], np.searchsorted(_bucket(mixed[by], buckets), bounds)

    g_at, g_hash, g_stops = spread(known & ~near, before)
    r_at, r_hash, r_stops = spread(~known, words)
    rows = []
    for b in np.flatnonzero(np.diff(f_stops) + np.diff(g_stops) + np.diff(r_stops)):
        f, g, r = (slice(x[b], x[b + 1]) for x in (f_stops, g_stops, r_stops))
        mine = r_at[r]
        data = _packed(
            np.array([train], np.int64),
            f_pair[f],
            f_doc[f],
            *_runs(g_hash[g]),
            own[g_at[g]].astype(np.uint16),
            docs[g_at[g]],
            *_runs(r_hash[r]),
            context[mine].astype(np.uint16),
            docs[mine],
            mix(before[mine[~near[mine]]]),
        )
        rows.append((int(b), number, data))
    return rows


def _runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of an ordered array and how often each occurs."""
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])[: len(ordered)])
    return ordered[first], np.diff(np.append(first, len(ordered))).astype(np.uint32)


def seat(customers: np.ndarray, new: np.ndarray, discount: float, rng: np.random.Generator):
    """Tables after all customers of each dish have sat down, one dish a row.

    A customer opens a table with weight ``new`` and joins one with the number of
    those seated less the discount for each table. From the 128th on, customers sit
    down in groups of a 64th of those seated, whose chances differ by little.
    """
    tables = (customers > 0).astype(np.int64)
    active, seated = np.flatnonzero(customers > 1), 1
    while len(active):
        group = max(1, seated // 64)
        weight = new[active]
        chance = weight / (weight + seated - discount * tables[active])
        if group == 1:
            tables[active] += rng.random(len(active)) < chance
        else:
            here = np.minimum(group, customers[active] - seated)
            tables[active] += rng.binomial(here, chance)
        seated += group
        active = active[customers[active] > seated]
    return tables


@dataclass
class Model:
    """What all tasks share: sizes, totals of restaurants, chances of frequent words."""

    types: int
    tokens: int
    frequent_counts: np.ndarray
    customers: np.ndarray  # of each restaurant
    tables: np.ndarray  # of each restaurant
    frequent: np.ndarray  # probability of each frequent word in the parent
    discount: float = 0.75
    parent_discount: float = 0.75
    parent_customers: float = 0.0
    parent_tables: float = 0.0

    def parent(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Probability of words in the parent, from their customers and tables."""
        fresh = (STRENGTH + self.parent_discount * self.parent_tables) / (self.types + 1)
        weight = np.maximum(customers - self.parent_discount * tables, 0) + fresh
        return weight / (STRENGTH + self.parent_customers)

    def parent_fresh(self) -> float:
        return (STRENGTH + self.parent_discount * self.parent_tables) / (self.types + 1)


def _start(types: int, tokens: int, counts: np.ndarray) -> Model:
    """A first guess: as many tables as counts to the power of the discount."""
    customers = counts.astype(float)
    base = tokens + types + 1
    return Model(
        types, tokens, counts, customers, customers**0.75, (counts + 1) / base,
        parent_customers=float(tokens), parent_tables=float(types),
    )


@dataclass
class Pairs:
    """The pairs of a bucket: ``key`` is dish and context, frequent dishes last.

    Contexts are the frequent words and then those of ``far``, ordered mixed hashes.
    """

    key: np.ndarray
    count: np.ndarray
    met: np.ndarray  # occurrences in all documents
    slot: np.ndarray  # their batch (in the bucket) and document, pair by pair
    far: np.ndarray

    def parts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Context, whether the dish is frequent, and the dish's number."""
        context = (self.key & np.uint64(0xFFFF_FFFF)).astype(np.int64)
        dish = (self.key >> np.uint64(32)).astype(np.int64)
        known = dish >= 1 << 31
        return context, known, np.where(known, dish - (1 << 31), dish)

    def guests(self, values: np.ndarray, near: int) -> np.ndarray:
        """Sums of the pairs' values in the restaurants of ``far``."""
        sums = np.bincount(self.parts()[0], values, near + len(self.far))
        return sums[near:].astype(np.int64)


def _gathered(blocks: list[tuple[int, bytes]], near: int) -> tuple[Pairs, list[int]]:
    """Pairs and counts of a bucket from its blocks; the batches in their order."""
    kinds = (np.int64, np.uint32, np.uint16, np.uint64, np.uint32, np.uint16, np.uint16) + (
        np.uint64, np.uint32, np.uint16, np.uint16, np.uint64
    )
    slots, trained, batches, parts = [], [], [], []
    for place, (batch, data) in enumerate(blocks):
        train, *rest = _unpacked(data, *kinds)
        batches.append(batch)
        docs = np.concatenate([rest[1], rest[5], rest[9]]).astype(np.int64)
        slots.append((place << 16) | docs)
        trained.append(docs < train[0])
        parts.append(rest)
    _, dishes = np.unique(np.concatenate([p[6] for p in parts]), return_inverse=True)
    far = np.unique(np.concatenate([x for p in parts for x in (p[2], p[10])]))
    whole, start = [], 0
    frequent_dish = np.uint64(1) << np.uint64(63)
    for f_pair, _, guests, g_runs, g_dish, _, words, r_runs, r_context, _, r_far in parts:
        pair = f_pair.astype(np.uint64)
        whole.append(frequent_dish | (pair >> np.uint64(16) << np.uint64(32)) | (pair & np.uint64(0xFFFF)))
        context = np.repeat(near + np.searchsorted(far, guests), g_runs).astype(np.uint64)
        whole.append(frequent_dish | (g_dish.astype(np.uint64) << np.uint64(32)) | context)
        dish = np.repeat(dishes[start : start + len(words)].astype(np.uint64), r_runs)
        start += len(words)
        context = r_context.astype(np.uint64)
        context[r_context == FAR] = near + np.searchsorted(far, r_far)
        whole.append((dish << np.uint64(32)) | context)
    flat = np.concatenate(whole)
    order = np.argsort(flat, kind="stable")
    flat = flat[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    count = np.add.reduceat(np.concatenate(trained)[order].astype(np.int64), first)
    met = np.diff(np.append(first, len(flat)))
    slot = np.concatenate(slots)[order]
    return Pairs(flat[first], count, met.astype(np.int64), slot.astype(np.int64), far), batches


def _sweep(
    pairs: Pairs, model: Model, far_tables: np.ndarray, parent: np.ndarray, rng: np.random.Generator
) -> tuple:
    """One sweep over a bucket: tables of pairs, customers and tables of rare dishes."""
    context, known, dish = pairs.parts()
    rare = ~known
    held = np.concatenate([model.tables, far_tables])
    weight = (STRENGTH + model.discount * held[context]) * parent
    tables = seat(pairs.count, weight, model.discount, rng)
    dishes = int(dish[rare].max()) + 1 if rare.any() else 0
    customers = np.bincount(dish[rare], tables[rare], dishes).astype(np.int64)
    upper = seat(
        customers, np.full(dishes, model.parent_fresh()), model.parent_discount, rng
    )
    return tables, customers, upper


def _parent_of(pairs: Pairs, model: Model, rare: np.ndarray) -> np.ndarray:
    """Parent's probability of the dish of each pair."""
    _, known, dish = pairs.parts()
    out = np.empty(len(dish))
    out[known] = model.frequent[dish[known]]
    out[~known] = rare[dish[~known]]
    return out


def _rare_counts(pairs: Pairs) -> np.ndarray:
    _, known, dish = pairs.parts()
    rare = ~known
    return np.bincount(dish[rare], pairs.count[rare], int(dish[rare].max()) + 1 if rare.any() else 0)


def _totals(pairs: Pairs, model: Model, seed: int, sweeps: int = 1) -> tuple[list[int], tuple]:
    """What a sweep adds to the shared totals, as a flat list, and the customers and
    tables that it adds to the restaurants of ``far``.
    """
    rng = np.random.default_rng(seed)
    chance = (_rare_counts(pairs) + 1) / (model.tokens + model.types + 1)
    width = len(model.customers)
    guests = pairs.guests(pairs.count, width)
    for _ in range(sweeps):
        parent = _parent_of(pairs, model, chance)
        tables, customers, upper = _sweep(pairs, model, guests**0.75, parent, rng)
        chance = model.parent(customers, upper)
    context, known, dish = pairs.parts()
    totals = np.concatenate(
        [
            np.bincount(context, pairs.count, width)[:width],
            np.bincount(context, tables, width)[:width],
            np.bincount(dish[known], tables[known], len(model.frequent)),
            [customers.sum(), upper.sum()],
            [(pairs.count == 1).sum(), (pairs.count == 2).sum()],
            [(customers == 1).sum(), (customers == 2).sum()],
        ]
    )
    return totals.astype(np.int64).tolist(), (guests, pairs.guests(tables, width))


def _shared(model: Model, totals: np.ndarray) -> Model:
    """The model after the totals of all buckets are known."""
    width, many = len(model.customers), len(model.frequent)
    customers, tables, seats = np.split(totals[: 2 * width + many], [width, 2 * width])
    below, above, once, twice, once_up, twice_up = totals[2 * width + many :]

    def discount(n1: int, n2: int) -> float:
        return float(np.clip(n1 / (n1 + 2 * n2), 0.1, 0.95)) if n1 else 0.75

    out = Model(
        model.types, model.tokens, model.frequent_counts, customers.astype(float),
        tables.astype(float), model.frequent, discount(once, twice), discount(once_up, twice_up),
    )
    out.parent_customers = float(below + seats.sum())
    out.parent_tables = float(above + (seats > 0).sum())
    rng = np.random.default_rng(5)
    upper = seat(seats, np.full(many, out.parent_fresh()), out.parent_discount, rng)
    out.parent_tables = float(above + upper.sum())
    out.frequent = out.parent(seats, upper)
    return out


def _scores(
    pairs: Pairs, model: Model, far: tuple, seed: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base score, score and whether known, for each pair, given the customers and
    tables in the restaurants of ``pairs.far``.
    """
    rng = np.random.default_rng(seed)
    context, known, dish = pairs.parts()
    rare = _rare_counts(pairs)
    seen = np.empty(len(dish))
    seen[known] = model.frequent_counts[dish[known]]
    seen[~known] = rare[dish[~known]]
    base = np.log10((seen + 1) / (model.tokens + model.types + 1))
    parent = _parent_of(pairs, model, (rare + 1) / (model.tokens + model.types + 1))
    total = np.zeros(len(dish))
    held = np.concatenate([model.customers, far[0]])[context]
    kept = np.concatenate([model.tables, far[1]])[context]
    for turn in range(BURN_IN + SAMPLES):
        tables, customers, upper = _sweep(pairs, model, far[1], parent, rng)
        parent = _parent_of(pairs, model, model.parent(customers, upper))
        if turn >= BURN_IN:
            back = (STRENGTH + model.discount * kept) * parent
            own = np.maximum(pairs.count - model.discount * tables, 0)
            total += (own + back) / (STRENGTH + held)
    return base, np.log10(total / SAMPLES), seen > 0


def score_documents(docs: DataFrame) -> DataFrame:
    """Base score and model score of every document, in log10, with its counts."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_CHARS))
    types, tokens, frequent, counts = vocabulary(rows, buckets)
    spark = docs.sparkSession

    def cut(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "batch", "data", "ids", "held", "sizes"]
        part = TaskContext.get().partitionId()
        id_type = None

        def numbered() -> Iterator[pa.RecordBatch]:
            nonlocal id_type
            for batch in source:
                id_type = batch.column(0).type
                yield batch

        for place, batch in enumerate(_batches(numbered())):
            number = (part << 32) | place
            rows = _blocks(batch, number, frequent, buckets)
            order = batch.order()
            lists = [
                pa.array([[batch.ids[i] for i in order]], pa.list_(id_type)),
                pa.array([[batch.held[i] for i in order]], pa.list_(pa.bool_())),
                pa.array([[len(batch.words[i]) for i in order]], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([-1 - number], pa.int64()),
                    pa.array([number], pa.int64()),
                    pa.array([None], pa.binary()),
                    *lists,
                ],
                names,
            )
            bucket, numbers, data = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket, pa.int64()),
                    pa.array(numbers, pa.int64()),
                    pa.array(data, pa.binary()),
                    *[pa.nulls(len(rows), x.type) for x in lists],
                ],
                names,
            )

    lists = f"ids array<{kind}>, held array<boolean>, sizes array<bigint>"
    first = _start(types, tokens, counts)

    def gather(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "batches", "data", "totals", "batch", "ids", "held", "sizes"]
        held: list[tuple[int, bytes]] = []
        mark = None

        def done(kinds: list[pa.DataType]) -> pa.RecordBatch:
            pairs, batches = _gathered(sorted(held), len(frequent))
            data = _packed(
                pairs.key,
                pairs.count,
                pairs.met.astype(np.uint32),
                pairs.slot.astype(np.uint32) if len(batches) < 1 << 16 else pairs.slot,
                pairs.far,
            )
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([mark], pa.int64()),
                    pa.array([batches], pa.list_(pa.int64())),
                    pa.array([data], pa.binary()),
                    pa.array([_totals(pairs, first, mark)[0]], pa.list_(pa.int64())),
                    pa.array([None], pa.int64()),
                    *[pa.nulls(1, k) for k in kinds],
                ],
                names,
            )

        kinds: list[pa.DataType] = []
        for batch in source:
            kinds = [batch.column(k).type for k in (3, 4, 5)]
            for at in range(len(batch)):
                bucket = batch.column(0)[at].as_py()
                if held and bucket != mark:
                    yield done(kinds)
                    held = []
                if bucket < 0:
                    row = batch.slice(at, 1)
                    yield pa.RecordBatch.from_arrays(
                        [
                            row.column(0),
                            pa.nulls(1, pa.list_(pa.int64())),
                            pa.nulls(1, pa.binary()),
                            pa.nulls(1, pa.list_(pa.int64())),
                            row.column(1),
                            *[row.column(k) for k in (3, 4, 5)],
                        ],
                        names,
                    )
                else:
                    mark = bucket
                    held.append((batch.column(1)[at].as_py(), batch.column(2)[at].as_py()))
        if held:
            yield done(kinds)

    gathered = store(
        rows.mapInArrow(cut, f"bucket bigint, batch bigint, data binary, {lists}")
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(
            gather,
            "bucket bigint, batches array<bigint>, data binary, totals array<bigint>, "
            f"batch bigint, {lists}",
        ),
        "pairs",
    )
    filled = gathered.where("data IS NOT NULL")
    width = 3 * len(frequent) + 6  # bounded by 1 / SHARE

    def summed(added: DataFrame) -> np.ndarray:
        sums = (
            added.select(F.posexplode("totals").alias("at", "n"))
            .where("n <> 0")
            .groupBy("at")
            .agg(F.sum("n").alias("n"))
            .toArrow()
        )
        totals = np.zeros(width, np.int64)
        totals[sums["at"].to_numpy()] = sums["n"].to_numpy()
        return totals

    def opened(batch: pa.RecordBatch, at: int) -> tuple[int, list[int], Pairs]:
        batches = batch.column(1)[at].as_py()
        wide = np.uint32 if len(batches) < 1 << 16 else np.int64
        key, count, met, slot, far = _unpacked(
            batch.column(2)[at].as_py(), np.uint64, np.int64, np.uint32, wide, np.uint64
        )
        pairs = Pairs(key, count, met, slot, far)
        return int(batch.column(0)[at].as_py()), batches, pairs

    def again(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Totals of each bucket, and by the restaurant's bucket what it adds there."""
        for batch in source:
            for at in range(len(batch)):
                bucket, _, pairs = opened(batch, at)
                added, far = _totals(pairs, model.value, bucket, sweeps=2)
                stops = np.searchsorted(_bucket(pairs.far, buckets), np.arange(buckets + 1))
                asked = np.flatnonzero(np.diff(stops))
                data = [_packed(*[x[stops[b] : stops[b + 1]] for x in (pairs.far, *far)]) for b in asked]
                size = 1 + len(data)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([None, *asked.tolist()], pa.int64()),
                        pa.array([bucket] * size, pa.int64()),
                        pa.array([None, *data], pa.binary()),
                        pa.array([added] + [None] * len(data), pa.list_(pa.int64())),
                    ],
                    ["place", "bucket", "sums", "totals"],
                )

    shared = _shared(first, summed(filled))
    for _ in range(SYNCS - 1):
        model = spark.sparkContext.broadcast(shared)
        parts = store(
            filled.select("bucket", "batches", "data").mapInArrow(
                again, "place bigint, bucket bigint, sums binary, totals array<bigint>"
            ),
            "seats",
        )
        shared = _shared(shared, summed(parts.where("totals IS NOT NULL")))
    model = spark.sparkContext.broadcast(shared)

    def meet(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Customers and tables of the restaurants of a place, for each bucket that asks."""
        held: list[tuple[int, bytes]] = []
        mark = None

        def done() -> pa.RecordBatch:
            asked = [_unpacked(x, np.uint64, np.int64, np.int64) for _, x in held]
            stops = np.cumsum([0, *[len(x[0]) for x in asked]])
            _, at = np.unique(np.concatenate([x[0] for x in asked]), return_inverse=True)
            sums = [
                np.bincount(at, np.concatenate([x[k] for x in asked])).astype(np.int64)[at]
                for k in (1, 2)
            ]
            data = [_packed(*[x[a:b] for x in sums]) for a, b in zip(stops, stops[1:], strict=False)]
            columns = [
                pa.array([mark] * len(held), pa.int64()),
                pa.array([b for b, _ in held], pa.int64()),
                pa.array(data, pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["place", "bucket", "sums"])

        for batch in source:
            for place, bucket, data in zip(*batch.columns, strict=True):
                if held and place.as_py() != mark:
                    yield done()
                    held = []
                mark = place.as_py()
                held.append((bucket.as_py(), data.as_py()))
        if held:
            yield done()

    answers = (
        parts.where("sums IS NOT NULL")
        .select("place", "bucket", "sums")
        .repartition(buckets, "place")
        .sortWithinPartitions("place")
        .mapInArrow(meet, "place bigint, bucket bigint, sums binary")
    )
    known = (
        filled.select("bucket", "batches", "data")
        .unionByName(answers, allowMissingColumns=True)
        .repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", F.col("data").isNotNull(), "place")
        .select("bucket", "batches", "data", "sums")
    )

    def score(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        far = [(np.zeros(0, np.int64),) * 2]
        for batch in source:
            for at in range(len(batch)):
                if batch.column(3)[at].is_valid:
                    far.append(_unpacked(batch.column(3)[at].as_py(), np.int64, np.int64))
                    continue
                bucket, batches, pairs = opened(batch, at)
                sums = [np.concatenate(x) for x in zip(*far, strict=True)]
                far = far[:1]
                parts = _scores(pairs, model.value, sums, bucket)
                spots, inverse = np.unique(pairs.slot, return_inverse=True)
                each = [np.bincount(inverse, np.repeat(x, pairs.met)) for x in parts]
                number = spots >> 16
                stops = np.searchsorted(number, np.arange(len(batches) + 1))
                columns = [(spots & 0xFFFF).astype(np.uint16), *each[:2], each[2].astype(np.uint32)]
                data = [
                    _packed(*[c[a:b] for c in columns])
                    for a, b in zip(stops, stops[1:], strict=False)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batches, pa.int64()), pa.array(data, pa.binary())],
                    ["batch", "sums"],
                )

    partial = known.mapInArrow(score, "batch bigint, sums binary")
    heads = gathered.where("data IS NULL").select("batch", "ids", "held", "sizes")
    met = heads.unionByName(partial, allowMissingColumns=True)
    ordered = met.repartition("batch").sortWithinPartitions("batch", F.col("ids").isNull())

    def finish(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        head: list | None = None
        sums: list[np.ndarray] = []

        def done() -> pa.RecordBatch:
            n = len(head[0])
            return pa.RecordBatch.from_arrays(
                [
                    *head,
                    pa.array(sums[2].astype(np.int64)),
                    pa.array(np.full(n, tokens), pa.int64()),
                    pa.array(sums[0]),
                    pa.array(sums[1]),
                ],
                names,
            )

        for batch in source:
            for at in range(len(batch)):
                if batch.column(1)[at].is_valid:
                    if head:
                        yield done()
                    head = [batch.column(k)[at].values for k in (1, 2, 3)]
                    sums = [np.zeros(len(head[0])) for _ in range(3)]
                else:
                    kinds = (np.uint16, np.float64, np.float64, np.uint32)
                    docs, *values = _unpacked(batch.column(4)[at].as_py(), *kinds)
                    for total, value in zip(sums, values, strict=True):
                        total[docs] += value  # a document stands once in a list
        if head:
            yield done()

    return ordered.select("batch", "ids", "held", "sizes", "sums").mapInArrow(
        finish,
        f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double",
    )
