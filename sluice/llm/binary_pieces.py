"""Sequences of power-of-two length, each from one document.

A tokenised document is cut into as many pieces of the longest length as it holds, then into one
piece for every binary digit of the rest, from high to low. Every piece is a sequence of its own: no
sequence crosses documents and none is padded. Equal lengths form a bucket, so a batch of one length
is a slice of one bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.packing import load_encoder
from sluice.session import cut_lineage


def binary_sizes(length: int, longest: int) -> list[int]:
    """Sizes of the pieces of a document, largest first; they add up to `length`."""
    whole, rest = divmod(length, longest)
    return [longest] * whole + [1 << b for b in reversed(range(longest.bit_length())) if rest >> b & 1]


def binary_pieces(
    docs: DataFrame, vocabulary: str, longest: int = 2048, end_id: int = 1, id_col: str = "doc_id",
    text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """A row per piece: id, start, length, ids_crc32, doc_tokens[, ids], and where it was made: `_part`
    (the task) and `_slot` (its place among the task's pieces of that length).

    A null text is empty: its only token is the end, a piece of 1. Null ids and repeated rows are cut
    like others, an empty table gives no rows, columns other than id and text are not read. A text is
    encoded whole, whatever its length; batches of 256 texts bound what a task holds."""
    if longest < 1 or longest & (longest - 1):
        raise ValueError(f"the longest piece must be a power of two, not {longest}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(vocabulary)
        part, used = TaskContext.get().partitionId(), [0] * longest.bit_length()
        for batch in batches:
            names, texts = batch.column(0), batch.column(1).to_pylist()
            for low in range(0, len(texts), 256):
                rows, out = [], [[], [], [], [], [], []]
                for i, ids in enumerate(encode([t or "" for t in texts[low : low + 256]]), low):
                    tokens = np.array([*ids, end_id], dtype="<u4")
                    sizes = binary_sizes(len(tokens), longest)
                    for size, b in zip(sizes, accumulate(sizes)):
                        bucket, piece = size.bit_length() - 1, tokens[b - size : b]
                        rows.append(i)
                        for to, v in zip(out, (b - size, size, zlib.crc32(piece), len(tokens), used[bucket], piece)):
                            to.append(v)
                        used[bucket] += 1
                columns = [names.take(pa.array(rows, pa.int64()))]
                columns += [pa.array(v, pa.int64()) for v in out[:5]] + [pa.array([part] * len(rows), pa.int32())]
                columns += [pa.array(out[5], pa.list_(pa.int64()))] * keep_ids
                yield pa.RecordBatch.from_arrays(columns, names=NAMES[: 7 + keep_ids])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, _slot long, _part int"
    schema += ", ids array<long>" * keep_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


NAMES = ["id", "start", "length", "ids_crc32", "doc_tokens", "_slot", "_part", "ids"]


def bucketed(pieces: DataFrame, longest: int = 2048) -> DataFrame:
    """`pieces` with `bucket` (log2 of the length), `bucket_row` (place in the bucket, gapless from 0),
    `sequence_id` and `offset` (always 0: a piece is a sequence).

    The pieces are written once, so a task run again numbers nothing twice. Only counts are added up, a
    row for each task and length; a bucket that holds most pieces is never gathered."""
    held = cut_lineage(pieces)
    counts = cut_lineage(held.groupBy("length", "_part").agg(F.count("*").alias("_n")))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    buckets = longest.bit_length()
    return (
        held.join(first, ["length", "_part"])
        .withColumn("bucket", F.round(F.log2("length")).cast("int"))
        .withColumn("bucket_row", F.col("_first") + F.col("_slot"))
        .withColumn("sequence_id", F.col("bucket_row") * buckets + F.col("bucket"))
        .withColumn("offset", F.lit(0).cast("long"))
        .select(*[c for c in pieces.columns if c not in ("_slot", "_part")], "sequence_id", "offset", "bucket", "bucket_row")
    )


def power_of_two_sequences(
    docs: DataFrame, vocabulary: str, longest: int = 2048, end_id: int = 1, id_col: str = "doc_id",
    text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """Every token of every document in exactly one sequence of one document: see `binary_pieces` for
    odd rows and `bucketed` for the numbers."""
    pieces = binary_pieces(docs, vocabulary, longest, end_id, id_col, text_col, keep_ids)
    return bucketed(pieces, longest).withColumnRenamed("id", id_col)


def write_buckets(sequences: DataFrame, path: str) -> None:
    """One folder of files for each length, rows near each other in the bucket in one file. Sequences
    need their `ids` (`keep_ids=True`)."""
    (
        sequences.repartitionByRange("bucket", "bucket_row")
        .sortWithinPartitions("bucket", "bucket_row")
        .write.partitionBy("bucket")
        .parquet(path)
    )
