"""Byte-pair encoding and decoding with a public vocabulary.

A word's adjacent pairs sit at the leaves of a segment tree, each as its merge
rank and its place; the root is the leftmost pair of the lowest rank. A merge
writes two or three leaves and their ancestors, until no pair can merge. Words of
similar length are worked on together, a row of a numpy matrix each.

Encoding goes batch by batch over the documents of a task: the different words
of a batch are encoded once and a bounded number of them is remembered. Nothing
is shuffled.

Defined cases: a null text counts as empty; an empty text, or one of white space
alone, has no ids and decodes to an empty text; the strings of special tokens
stand for their ids as the library has it. Texts and words may have any length.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

REMEMBERED = 150_000  # words a task keeps, each with its ids
BATCH_CHARS = 4_000_000
NEVER = np.int64(2**62)


#: Code points that this Python has no class for; the library may know them.
UNASSIGNED = np.fromiter((unicodedata.category(chr(i)) == "Cn" for i in range(0x110000)), bool)


def _has_unassigned(text: str) -> bool:
    return bool(UNASSIGNED[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].any())


_NORMAL = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])

_byte_char = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte: itself, else the next from 256 on."""
    out, spare = [""] * 256, 256
    for byte in range(256):
        if byte in _byte_char:
            out[byte] = chr(byte)
        else:
            out[byte], spare = chr(spare), spare + 1
    return out


class Vocabulary:
    """Pieces, merges and special tokens of a tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        model = found["model"]
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {x["content"]: x["id"] for x in found["added_tokens"]}
        self.pieces = {i: p for p, i in (self.ids | self.special).items()}
        self.split_special = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        patterns = [
            x["pattern"]["Regex"]
            for x in found["pre_tokenizer"]["pretokenizers"]
            if x["type"] == "Split"
        ]
        self.words = regex.compile(patterns[0], regex.V0)
        self.newer = pre_tokenizers.Split(Regex(patterns[0]), "removed", invert=True)
        chars = _byte_chars()
        self.plain = np.array([self.ids[c] for c in chars], np.int64)
        self.last = np.array([self.ids[c + self.suffix] for c in chars], np.int64)
        size = max(self.pieces) + 1
        self.size = size
        keys, ranks, merged = [], [], []
        for rank, (left, right) in enumerate(model["merges"]):
            keys.append(self.ids[left] * size + self.ids[right])
            ranks.append(rank)
            merged.append(self.ids[left + right])
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        self.pair_keys = np.array(keys, np.int64)[order]
        self.pair_ranks = np.array(ranks, np.int64)[order]
        self.merged = np.array(merged, np.int64)  # by rank

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, or NEVER; ids below 0 pair with nothing."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = (self.pair_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_ranks[at], NEVER)


def _merge_rows(vocab: Vocabulary, ids: np.ndarray) -> np.ndarray:
    """Merge all rows of ``ids`` (padded with -1); merged-away places become -1."""
    rows, width = ids.shape
    leaves = 1 << max(1, (width - 1).bit_length())
    spots = np.arange(width, dtype=np.int64)
    after = np.broadcast_to(spots + 1, ids.shape).copy()
    before = np.broadcast_to(spots - 1, ids.shape).copy()
    # a node holds rank * leaves + place, so its minimum is the leftmost lowest rank
    tree = np.full((rows, 2 * leaves), NEVER, np.int64)
    if width > 1:
        rank = vocab.ranks(ids[:, :-1], ids[:, 1:])
        tree[:, leaves : leaves + width - 1] = np.where(
            rank < NEVER, rank * leaves + spots[:-1], NEVER
        )
    level = leaves
    while level > 1:
        pairs = tree[:, level : 2 * level]
        tree[:, level // 2 : level] = np.minimum(pairs[:, ::2], pairs[:, 1::2])
        level //= 2

    def put(row: np.ndarray, place: np.ndarray, value: np.ndarray) -> None:
        node = place + leaves
        tree[row, node] = value
        node = node >> 1
        while node[0]:
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            node = node >> 1

    active = np.flatnonzero(tree[:, 1] < NEVER)
    while len(active):
        root = tree[active, 1]
        place, rank = root % leaves, root // leaves
        gone = after[active, place]
        beyond = after[active, gone]
        ids[active, place] = vocab.merged[rank]
        ids[active, gone] = -1
        after[active, place] = beyond
        put(active, gone, np.full(len(active), NEVER))

        inside = beyond < width
        row, here, next_ = active[inside], place[inside], beyond[inside]
        before[row, next_] = here
        right = np.full(len(active), NEVER)
        new = vocab.ranks(ids[row, here], ids[row, next_])
        right[inside] = np.where(new < NEVER, new * leaves + here, NEVER)
        put(active, place, right)

        prior = before[active, place]
        has = prior >= 0
        row, here, prior = active[has], place[has], prior[has]
        if len(row):
            new = vocab.ranks(ids[row, prior], ids[row, here])
            put(row, prior, np.where(new < NEVER, new * leaves + prior, NEVER))
        active = active[tree[active, 1] < NEVER]
    return ids


def merge_words(vocab: Vocabulary, words: list[str], block: int = 1 << 20) -> list[list[int]]:
    """Ids of each word; words of like length share a matrix of bounded size."""
    coded = [w.encode("utf-8") for w in words]
    lengths = np.array([len(c) for c in coded], np.int64)
    out: list[list[int]] = [[] for _ in words]
    order = np.argsort(lengths, kind="stable")
    start = int(np.searchsorted(lengths[order], 1))
    while start < len(order):
        # up to the next power of two in length, and to a bounded matrix
        width = 1 << int(lengths[order[start]] - 1).bit_length()
        end = int(np.searchsorted(lengths[order], width, side="right"))
        end = min(end, start + max(1, block // width))
        chosen = order[start:end]
        width = int(lengths[chosen[-1]])
        flat = np.frombuffer(b"".join(coded[i] for i in chosen), np.uint8)
        inside = np.arange(width) < lengths[chosen][:, None]
        ids = np.full((len(chosen), width), -1, np.int64)
        ids[inside] = vocab.plain[flat]
        ends = lengths[chosen] - 1
        final = flat[np.cumsum(lengths[chosen]) - 1]
        ids[np.arange(len(chosen)), ends] = vocab.last[final]
        ids = _merge_rows(vocab, ids)
        kept = ids >= 0
        values, stops = ids[kept].tolist(), np.cumsum(kept.sum(1)).tolist()
        begin = 0
        for i, stop in zip(chosen.tolist(), stops, strict=True):
            out[i] = values[begin:stop]
            begin = stop
        start = end
    return out


class Encoder:
    """Encodes texts; remembers a bounded number of space-separated parts."""

    def __init__(self, path: str):
        self.vocab = Vocabulary(path)
        pieces = self.vocab.pieces
        # each id as text, and its piece as text, with a space after it
        self.id_texts = [f"{i} " for i in range(self.vocab.size)]
        self.piece_texts = [pieces[i] + " " if i in pieces else "" for i in range(self.vocab.size)]
        # part of a text to the texts of its ids and of its pieces
        self.known: dict[str, tuple[str, str]] = {}

    def parts(self, text: str) -> list[str]:
        """The text cut at spaces, special tokens apart, lower-cased.

        A special token is marked by a leading space, which no other part has. No word
        reaches over a space, so each part has its ids whatever is near.
        """
        if self.vocab.split_special and "<|" in text:
            out: list[str] = []
            for piece in self.vocab.split_special.split(text):
                out += [" " + piece] if piece in self.vocab.special else self._plain(piece)
            return out
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if not text.isascii():
            if _has_unassigned(text):
                text = _NORMAL.normalize_str(text)
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower().replace("\n", " ").split(" ")

    def _texts(self, ids: list[int]) -> tuple[str, str]:
        return (
            "".join([self.id_texts[i] for i in ids]),
            "".join([self.piece_texts[i] for i in ids]),
        )

    def _words(self, part: str) -> list[str]:
        if not part.isascii() and _has_unassigned(part):
            return [w for w, _ in self.vocab.newer.pre_tokenize_str(part)]
        return self.vocab.words.findall(part)

    def learn(self, asked: set[str]) -> None:
        """Make sure that all parts ``asked`` for are known."""
        known = self.known
        new = [p for p in asked if p not in known]
        if not new:
            return
        if len(known) + len(new) > REMEMBERED:
            self.known = known = {p: known[p] for p in asked if p in known}
        # a part of letters alone is a word; others go through the pattern
        words, cut = {p for p in new if p.isalpha()}, {}
        for part in new:
            if part[:1] == " ":
                known[part] = self._texts([self.vocab.special[part[1:]]])
            elif part not in words:
                cut[part] = self._words(part)
        extra = {w for ws in cut.values() for w in ws} - words
        listed = [*words, *(w for w in extra if w not in known)]
        found = dict(zip(listed, map(self._texts, merge_words(self.vocab, listed)), strict=True))
        for part in words:
            known[part] = found[part]
        for part, ws in cut.items():
            pairs = [found.get(w) or known[w] for w in ws]
            known[part] = "".join([p[0] for p in pairs]), "".join([p[1] for p in pairs])

    def coded(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """For each text its ids and its pieces, each followed by a space."""
        cut = [self.parts(t) for t in texts]
        self.learn({p for ps in cut for p in ps})
        known = self.known
        for parts in cut:
            pairs = [known[p] for p in parts]
            yield "".join([p[0] for p in pairs]), "".join([p[1] for p in pairs])

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text."""
        return [list(map(int, ids.split())) for ids, _ in self.coded([t or "" for t in texts])]

    def decode(self, ids: Iterable[int]) -> str:
        """The pieces of ``ids`` joined by spaces, special tokens included.

        The file names no decoder; unknown ids are left out, as in the library.
        """
        pieces = self.vocab.pieces
        return " ".join([pieces[i] for i in ids if i in pieces])


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each task process and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def slices(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a column in runs of about BATCH_CHARS; null counts as empty."""
    size, run = 0, []
    for value in column:
        run.append(value.as_py() or "")
        size += len(run[-1])
        if size >= BATCH_CHARS:
            yield run
            size, run = 0, []
    if run:
        yield run


ADDED = ("n_tokens", "ids_sha256", "decoded_sha256", "ids")


def encode_documents(
    docs: DataFrame, path: str, text: str = "text", with_ids: bool = True
) -> DataFrame:
    """``docs`` with number of ids, digests of ids and decoded text, and the ids.

    Columns named like the added ones are replaced.
    """
    names = [c for c in docs.columns if c not in ADDED]
    inner = {c: f"own{i}" for i, c in enumerate(names)}
    plain = docs.select(*[F.col(f"`{c}`").alias(v) for c, v in inner.items()])
    at = names.index(text)
    added = ADDED if with_ids else ADDED[:3]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            counts, id_digests, text_digests, flat = [], [], [], [np.empty(0, np.int32)]
            for texts in slices(batch.column(at)):
                for ids, decoded in enc.coded(texts):
                    counts.append(ids.count(" "))
                    id_digests.append(hashlib.sha256(ids[:-1].encode()).hexdigest())
                    text_digests.append(hashlib.sha256(decoded[:-1].encode()).hexdigest())
                    if with_ids:
                        flat.append(np.fromstring(ids, np.int32, sep=" "))
            new = [
                pa.array(counts, pa.int64()),
                pa.array(id_digests, pa.string()),
                pa.array(text_digests, pa.string()),
            ]
            if with_ids:
                stops = np.cumsum([0, *counts]).astype(np.int32)
                new.append(pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate(flat))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *new], [*batch.schema.names, *added]
            )

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema)
    kinds = ["n_tokens bigint", "ids_sha256 string", "decoded_sha256 string", "ids array<int>"]
    coded = plain.mapInArrow(run, f"{schema}, {', '.join(kinds[: len(added)])}")
    return coded.select(*[F.col(v).alias(c) for c, v in inner.items()], *added)


def digest_documents(docs: DataFrame, path: str) -> DataFrame:
    """Number of ids and digests of ids and decoded text, for each document."""
    return encode_documents(docs.select("doc_id", "text"), path, with_ids=False).drop("text")
