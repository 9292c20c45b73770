"""Alignment of two tokenizers over the same texts.

Both tokenizers cut the bytes of a space and the text. Within a batch, one
``merge_asof`` keyed by document finds for each token of one side the token of the
other side that covers its first byte; both directions together are all
overlaps. Overlaps with equal ends are links, and their ends cut the tokens into
groups, the smallest stretches that both sides cover with whole tokens.

How often an id pair is linked is counted over the whole corpus. Texts do not
travel for it: a batch of documents is written as one packed row with its
different pairs; sums come back to a batch by its number, one row for each of its
pairs. A pair that all documents hold has one row a batch.

Defined cases: a text that is null, empty, or whose tokens' joined bytes differ
from space and text on either side has no tokens, zeros in every count and an empty
digest. Repeated rows and ids, and null ids, are documents of their own. Texts of
any length are taken whole; a batch holds one document at least.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.stage import store

BATCH_CHARS = 2_000_000


class ByteSide:
    """Byte-level BPE: ids of a text, and the bytes of each id.

    Letters up to U+00FF have one class in every Unicode version, so such texts
    take the faster reader of the same vocabulary's ranks; all others the library's own.
    """

    def __init__(self, path: str, ranks_path: str, pattern: str):
        self.whole = tokenizers.Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(x): int(n) for x, n in (line.split() for line in file)}
        self.plain = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        size = self.whole.get_vocab_size()
        self.bytes = [b""] * size
        for piece, number in ranks.items():
            self.bytes[number] = piece

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of space and text."""
        out: list[list[int]] = [[]] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            if text.isascii() or max(text) <= "\xff":
                out[i] = self.plain.encode_ordinary(f" {text}")
            else:
                rest.append(i)
        if rest:
            found = self.whole.encode_batch_fast(
                [f" {texts[i]}" for i in rest], add_special_tokens=False
            )
            for i, one in zip(rest, found, strict=True):
                out[i] = one.ids
        return out


class PieceSide:
    """Sentence pieces with byte fallback; the model adds the space itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [
            bytes([int(piece[3:5], 16)])
            if self.model.is_byte(i)
            else piece.replace("▁", " ").encode()
            for i, piece in enumerate(map(self.model.id_to_piece, range(self.model.vocab_size())))
        ]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


class Aligned:
    """Tokens, links and groups of a batch of texts; arrays run over all its documents."""

    def __init__(self, sides: tuple, texts: list[str | None]):
        self.a, self.b = sides
        texts = [t or "" for t in texts]
        held = [i for i, t in enumerate(texts) if t]
        ids = [side.encode([texts[i] for i in held]) for side in sides]
        wanted = [f" {texts[i]}".encode() for i in held]
        for side, found in zip(sides, ids, strict=True):
            piece = side.bytes.__getitem__
            held = [
                i if i is not None and b"".join(map(piece, one)) == want else None
                for i, one, want in zip(held, found, wanted, strict=True)
            ]
        whole = [k for k, i in enumerate(held) if i is not None]
        self.docs = np.array([held[k] for k in whole], np.int64)
        self.size = len(texts)
        self.ids, self.counts, frames = [], [], []
        for side, found in zip(sides, ids, strict=True):
            counts = np.array([len(found[k]) for k in whole], np.int64)
            flat = np.fromiter((x for k in whole for x in found[k]), np.int32, counts.sum())
            ends = np.cumsum(np.array([len(x) for x in side.bytes], np.int64)[flat])
            # bytes of both sides are equal, so one running place serves both
            start = np.concatenate([np.zeros(1, np.int64), ends[:-1]])[: len(ends)]
            frames.append(
                pd.DataFrame(
                    {
                        "doc": np.repeat(np.arange(len(whole), dtype=np.int32), counts),
                        "at": start,
                        "end": ends,
                        "token": np.arange(len(flat)),
                    }
                )
            )
            self.ids.append(flat)
            self.counts.append(counts)
        self.overlaps = _overlaps(*frames)
        links = self.overlaps[self.overlaps.end_a == self.overlaps.end_b].sort_values("token_a")
        self.link_a, self.link_b = links.token_a.to_numpy(), links.token_b.to_numpy()
        self.link_doc = frames[0]["doc"].to_numpy()[self.link_a]

    def pairs(self) -> np.ndarray:
        """The id pair of each link as one number."""
        a, b = self.ids[0][self.link_a], self.ids[1][self.link_b]
        return a.astype(np.int64) * len(self.b.bytes) + b

    def per_doc(self, values: np.ndarray) -> np.ndarray:
        """``values`` of the documents with tokens, zero for the others."""
        out = np.zeros(self.size, np.int64)
        out[self.docs] = values
        return out

    def link_counts(self) -> np.ndarray:
        return self.per_doc(np.bincount(self.link_doc, minlength=len(self.docs)))

    def written(self) -> list[str]:
        """Groups of each document as ``a1,a2|b1;a3|b2,b3``."""
        (ids_a, ids_b), (n_a, n_b) = self.ids, self.counts
        last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
        last_a[self.link_a], last_b[self.link_b] = True, True
        group_a = np.cumsum(last_a) - last_a
        group_b = np.cumsum(last_b) - last_b
        stops_b = np.concatenate([[0], self.link_b + 1])
        signs, size_a, size_b = self._signs(), len(self.a.bytes), len(self.b.bytes)
        code = np.empty(len(ids_a) + len(ids_b), np.int32)
        code[np.arange(len(ids_a)) + stops_b[group_a]] = ids_a + size_a * last_a
        if len(ids_b):
            at = np.arange(len(ids_b)) + self.link_a[group_b] + 1
            code[at] = ids_b + 2 * size_a + size_b * last_b
        stops = np.cumsum(n_a + n_b)
        out = [""] * self.size
        for doc, start, stop in zip(self.docs, stops - n_a - n_b, stops, strict=True):
            out[doc] = "".join(map(signs, code[start:stop].tolist()))[:-1]
        return out

    def _signs(self):
        if not hasattr(self.a, "signs"):
            a, b = range(len(self.a.bytes)), range(len(self.b.bytes))
            self.a.signs = [f"{i}{end}" for side, ends in ((a, ",|"), (b, ",;")) for end in ends for i in side]
        return self.a.signs.__getitem__


def _overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """All pairs of tokens that share a byte, each once."""
    names = {"on": "at", "by": "doc"}
    first = pd.merge_asof(a, b.assign(at_b=b["at"]), **names, suffixes=("_a", "_b"))
    other = pd.merge_asof(b, a.assign(at_a=a["at"]), **names, suffixes=("_b", "_a"))
    # tokens that start together are found from both sides
    other = other[other["at"] != other["at_a"]]
    columns = ["token_a", "token_b", "end_a", "end_b"]
    return pd.concat([first[columns], other[columns]], ignore_index=True)


_sides: dict[tuple, tuple] = {}


def _both(files: tuple[str, str, str, str]) -> tuple:
    """The tokenizers, read once for each task process."""
    if files not in _sides:
        a_path, a_ranks, pattern, b_path = files
        _sides[files] = ByteSide(a_path, a_ranks, pattern), PieceSide(b_path)
    return _sides[files]


def _runs(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Place of the first text and the texts, in runs of about BATCH_CHARS."""
    start, size, run = 0, 0, []
    for i, value in enumerate(texts):
        run.append(value.as_py())
        size += len(run[-1] or "")
        if size >= BATCH_CHARS:
            yield start, run
            start, size, run = i + 1, 0, []
    if run:
        yield start, run


def align(docs: DataFrame, files: tuple[str, str, str, str], text: str = "text") -> DataFrame:
    """``docs`` with both sides' ids and the groups as token counts at each cut.

    Added: ``a_ids``, ``b_ids``; ``a_cuts``, ``b_cuts`` (tokens of each side up to
    the end of each group). Own columns of these names are replaced. ``files``:
    byte BPE file, its ranks, its pattern, sentence-piece file.
    """
    added = ("a_ids", "b_ids", "a_cuts", "b_cuts")
    names = [c for c in docs.columns if c not in added]
    inner = {c: f"own{i}" for i, c in enumerate(names)}
    plain = docs.select(*[F.col(f"`{c}`").alias(v) for c, v in inner.items()])
    at = names.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _both(files)
        for batch in batches:
            for start, texts in _runs(batch.column(at)):
                got = Aligned(sides, texts)
                links = got.link_counts()
                new = []
                for ids, counts in zip(got.ids, got.counts, strict=True):
                    new.append(_lists(got.per_doc(counts), ids))
                for link, counts in zip((got.link_a, got.link_b), got.counts, strict=True):
                    before = np.cumsum(counts) - counts
                    new.append(_lists(links, (link + 1 - before[got.link_doc]).astype(np.int32)))
                own = batch.slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([*own.columns, *new], [*own.schema.names, *added])

    schema = [f"{f.name} {f.dataType.simpleString()}" for f in plain.schema]
    found = plain.mapInArrow(run, ", ".join([*schema, *(f"{c} array<int>" for c in added)]))
    return found.select(*[F.col(v).alias(c) for c, v in inner.items()], *added)


def _lists(counts: np.ndarray, values: np.ndarray) -> pa.ListArray:
    stops = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(stops), pa.array(values))


_PACKED = """batch long, doc_id array<long>, n_a array<long>, n_b array<long>,
    n_links array<long>, groups_sha256 array<string>, held array<int>, place array<int>,
    times array<int>, pair array<long>, links array<long>"""


def _pack(batches: Iterable[pa.RecordBatch], files: tuple) -> Iterator[pa.RecordBatch]:
    """One row for each run of documents.

    ``pair`` and ``links`` list its different pairs; ``held`` counts each
    document's entries in ``place`` (into ``pair``) and ``times``.
    """
    sides, number = _both(files), TaskContext.get().partitionId() << 32
    for batch in batches:
        for start, texts in _runs(batch.column("text")):
            got = Aligned(sides, texts)
            place, pair = pd.factorize(got.pairs())
            width = max(1, len(pair))
            entry, times = np.unique(got.link_doc.astype(np.int64) * width + place, return_counts=True)
            digests = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in got.written()]
            columns = [
                batch.column("doc_id").slice(start, len(texts)),
                got.per_doc(got.counts[0]),
                got.per_doc(got.counts[1]),
                got.link_counts(),
                digests,
                got.per_doc(np.bincount(entry // width, minlength=len(got.docs))).astype(np.int32),
                (entry % width).astype(np.int32),
                times.astype(np.int32),
                pair,
                np.bincount(place, minlength=len(pair)),
            ]
            arrays = [pa.array([number], pa.int64())]
            for column in columns:
                flat = column if isinstance(column, pa.Array) else pa.array(column)
                arrays.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
            names = [part.split()[0] for part in _PACKED.split(",")]
            yield pa.RecordBatch.from_arrays(arrays, names)
            number += 1


_REPORT = """doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long,
    count_sum long, groups_sha256 string"""


def _unpack(packed: pa.Table, sums: pa.Table) -> pa.Table:
    """A row for each document of one batch, from the corpus's sums of its pairs."""
    row = {c: packed.column(c).chunk(0).values for c in packed.column_names if c != "batch"}
    n = np.zeros(len(row["pair"]), np.int64)
    best = np.zeros(len(row["pair"]), np.int64)
    at = sums.column("at").to_numpy()
    n[at] = sums.column("n").to_numpy()
    best[at] = sums.column("best").to_numpy().astype(np.int64)
    place, times = row["place"].to_numpy(), row["times"].to_numpy().astype(np.int64)
    stops = np.concatenate([[0], np.cumsum(row["held"].to_numpy().astype(np.int64))])

    def per_doc(values: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(values)])
        return running[stops[1:]] - running[stops[:-1]]

    links = row["n_links"]
    return pa.table(
        {
            "doc_id": row["doc_id"],
            "n_a": row["n_a"],
            "n_b": row["n_b"],
            "n_groups": links,  # no token is empty, so each cut has one link
            "n_links": links,
            "n_best": per_doc(times * best[place]),
            "count_sum": per_doc(times * n[place]),
            "groups_sha256": row["groups_sha256"],
        }
    )


def pair_counts(packed: DataFrame, width: int) -> DataFrame:
    """``pair``, how many links hold it (``n``), and whether its B id has no better."""
    counts = packed.select(F.inline(F.arrays_zip("pair", "links"))).groupBy("pair")
    counts = store(counts.agg(F.sum("links").alias("n")), "pair-counts")
    top = counts.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("top"))
    return counts.join(top, F.col("pair") % width == F.col("b")).select(
        "pair", "n", (F.col("n") == F.col("top")).alias("best")
    )


def align_report(docs: DataFrame, files: tuple[str, str, str, str]) -> DataFrame:
    """Counts and digest of every document's alignment; see the module's docstring.

    ``n_best``: its links whose pair is the most frequent one of their B id in the
    corpus, ties included; ``count_sum``: the sum of its links' corpus counts.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    packed = store(texts.mapInArrow(lambda batches: _pack(batches, files), _PACKED), "aligned")
    width = sentencepiece.SentencePieceProcessor(model_file=files[3]).vocab_size()
    asked = packed.select(F.col("batch").alias("asked_by"), F.posexplode("pair").alias("at", "pair"))
    sums = asked.join(pair_counts(packed, width), "pair").select("asked_by", "at", "n", "best")
    return packed.groupBy("batch").cogroup(sums.groupBy("asked_by")).applyInArrow(_unpack, _REPORT)
