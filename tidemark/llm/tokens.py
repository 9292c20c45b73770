"""Token counts of documents in flat token files.

A flat file is a run of 16-bit ids in which an end-of-document id closes each
document; it has no index, and its blocks are cut anywhere. Each block is searched
on its own for the separators; what a block leaves open at its two ends is joined
by running sums over the blocks of a file, which hold a few numbers each.

The files are kept as a table with a row for each block (file, block, ids). Rows
of another kind name the documents of a file in order, as nothing in the stream
itself does.

Defined cases: a null or empty text is a document without tokens; the separator's
own string within a text counts as white space, so that it does not end a
document; null and repeated document ids are kept as they are; a last
document without separator counts as one if it has tokens; an empty table has no
blocks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe

BLOCK_IDS = 1 << 18
NAMED = 4096  # document ids in a row

STREAM = "file int, block bigint, ids binary, first bigint, names array<{}>"


def token_stream(
    docs: DataFrame,
    vocabulary: str,
    separator: str = "<|endoftext|>",
    doc_id: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Blocks of flat files, one file for each task that reads documents.

    A row holds a block of ids, or names documents from the ``first`` one on.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = STREAM.format(kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoder(vocabulary)
        end = enc.vocab.special[separator]
        file, block, first = TaskContext.get().partitionId(), 0, 0
        waiting: list[np.ndarray] = []
        size = 0

        none = None

        def row(names: pa.Array, block: int | None, ids: bytes | None, first: int | None):
            listed = pa.array([None], pa.list_(names.type))
            if ids is None:
                listed = pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int32()),
                    pa.array([block], pa.int64()),
                    pa.array([ids], pa.binary()),
                    pa.array([first], pa.int64()),
                    listed,
                ],
                ["file", "block", "ids", "first", "names"],
            )

        for batch in batches:
            names = batch.column(0)
            none = names.slice(0, 0)
            for at in range(0, len(names), NAMED):
                part = names.slice(at, NAMED)
                yield row(part, None, None, first + at)
            first += len(names)
            for texts in bpe.slices(batch.column(1)):
                cleared = [t.replace(separator, " ") if separator in t else t for t in texts]
                coded = "".join([f"{ids}{end} " for ids, _ in enc.coded(cleared)])
                waiting.append(np.fromstring(coded, np.uint16, sep=" "))
                size += len(waiting[-1])
                if size >= block_ids:
                    flat = np.concatenate(waiting)
                    for start in range(0, size - size % block_ids, block_ids):
                        yield row(none, block, flat[start : start + block_ids].tobytes(), None)
                        block += 1
                    waiting, size = [flat[size - size % block_ids :]], size % block_ids
        if size:
            yield row(none, block, np.concatenate(waiting).tobytes(), None)

    return docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text").mapInArrow(run, schema)


def scan_blocks(stream: DataFrame, separator: int) -> DataFrame:
    """What each block shows: ids before its first separator, the documents that
    lie wholly inside it, and the ids after its last separator.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, heads, tails, inner = [], [], [], []
            for value in batch.column(2):
                ids = np.frombuffer(value.as_buffer(), np.uint16)
                at = np.flatnonzero(ids == separator)
                ends.append(len(at))
                heads.append(int(at[0]) if len(at) else len(ids))
                tails.append(int(len(ids) - at[-1] - 1) if len(at) else 0)
                inner.append(np.diff(at) - 1)
            stops = np.cumsum([0, *map(len, inner)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int64), *inner]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(ends, pa.int64()),
                    pa.array(heads, pa.int64()),
                    pa.array(tails, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(stops), pa.array(flat)),
                ],
                ["file", "block", "ends", "head", "tail", "inside"],
            )

    return (
        stream.where("ids IS NOT NULL")
        .select("file", "block", "ids")
        .mapInArrow(
            run,
            "file int, block bigint, ends bigint, head bigint, tail bigint, inside array<bigint>",
        )
    )


def count_tokens(stream: DataFrame, separator: int) -> DataFrame:
    """Tokens of each document by file and place (from 0), from the ids alone."""
    seen = scan_blocks(stream, separator)
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # ids since the last separator: those of the blocks after the last one that has
    # any, and that block's tail; a running sum minus its value there gives them
    sums = seen.select("file", "block", "ends", "head", "tail", "inside").withColumns(
        {
            "closed": F.coalesce(F.sum("ends").over(before), F.lit(0)),
            "plain": F.coalesce(
                F.sum(F.when(F.col("ends") == 0, F.col("head")).otherwise(0)).over(before),
                F.lit(0),
            ),
        }
    )
    # what to add at a block after the last separator before it
    opened = F.when(
        F.col("ends") > 0, F.struct(F.col("tail").alias("t"), F.col("plain").alias("p"))
    )
    sums = sums.withColumn("since", F.last(opened, ignorenulls=True).over(before))
    carried = F.coalesce(
        F.col("since.t") + F.col("plain") - F.col("since.p"), F.col("plain")
    )
    sums = sums.withColumn("carry", carried)
    whole = F.concat(F.array(F.col("carry") + F.col("head")), F.col("inside"))
    closed = sums.where("ends > 0").select(
        "file", "closed", F.posexplode(whole).alias("at", "n_tokens")
    )
    after = Window.partitionBy("file").orderBy(F.col("block").desc())
    last = sums.withColumn("rn", F.row_number().over(after)).where("rn = 1")
    left = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("head"))
    unclosed = last.select(
        "file", (F.col("closed") + F.col("ends")).alias("place"), left.alias("n_tokens")
    ).where("n_tokens > 0")
    return closed.select(
        "file", (F.col("closed") + F.col("at")).alias("place"), "n_tokens"
    ).unionByName(unclosed)


def count_documents(stream: DataFrame, separator: int) -> DataFrame:
    """Tokens of each document by its id, with its file and place there."""
    counted = count_tokens(stream, separator)
    named = stream.where("ids IS NULL").select(
        "file", "first", F.posexplode("names").alias("at", "doc_id")
    )
    named = named.select("file", (F.col("first") + F.col("at")).alias("place"), "doc_id")
    return named.join(counted, ["file", "place"]).select("doc_id", "n_tokens", "file", "place")
