"""Best-fit packing of tokenised documents under several capacities at once.

A sequence has room for so many tokens, documents and attention cost (the sum of squared lengths).
Items go from long to short into the open sequence that is best by residual norm or weighted dot
product among those with room in every dimension. Items of one length are alike, so the choice is
made once for a run of them: the driver sees the number of items of each length (as many rows as a
sequence has tokens, however many documents there are) and returns runs; placing the items is a
join on length and rank.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import cut_lineage

# Fixed value: how byte-level vocabularies of this kind cut a text before merging.
PRETOKEN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"


def byte_letters() -> dict[str, int]:
    """Letters that stand for bytes in byte-level vocabularies: printable ones for themselves, the
    others from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_encoder(path: str):
    """A function from a list of texts to lists of ids, for a byte-level vocabulary file of
    `tokenizers`; strings of added tokens in a text are those tokens, as there. Where ids follow the
    order of the merges the same ids come several times faster from `tiktoken`, which is used then."""
    data = json.load(open(path, encoding="utf-8"))
    vocab, merges = data["model"]["vocab"], data["model"]["merges"]
    letters = byte_letters()
    special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
    plain = not any(t.get(k) for t in data.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized"))
    joined = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in merges]
    first = len(letters)
    if plain and data["pre_tokenizer"]["type"] == "ByteLevel" and not data["pre_tokenizer"].get("add_prefix_space") and all(
        vocab[t] == first + i for i, t in enumerate(joined)
    ):
        import tiktoken

        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if t not in special}
        fast = tiktoken.Encoding("vocabulary", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens=special)
        return lambda texts: [
            fast.encode(t, allowed_special="all") if any(s in t for s in special) else fast.encode_ordinary(t)
            for t in texts
        ]
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    return lambda texts: [e.ids for e in slow.encode_batch(texts, add_special_tokens=False)]


def cuts(length: int, room: int) -> list[int]:
    """Borders of the pieces of a document: whole if it fits, else pieces of `room` tokens with the
    shorter one first."""
    if length <= room:
        return [0, length]
    first = length % room
    return ([0] if first else []) + list(range(first, length + 1, room))


def tokenised_pieces(
    docs: DataFrame, vocabulary: str, room: int = 1024, end_id: int = 2, id_col: str = "doc_id",
    text_col: str = "text", keep_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) of every piece of every document. A null text
    is empty: its only token is the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = load_encoder(vocabulary)
        for batch in batches:
            names, texts = batch.column(0), batch.column(1).to_pylist()
            for low in range(0, len(texts), 256):
                rows, out = [], [[], [], [], [], []]
                for i, ids in enumerate(encode([t or "" for t in texts[low : low + 256]]), low):
                    tokens = np.array([*ids, end_id], dtype="<u4")
                    borders = cuts(len(tokens), room)
                    for piece, (a, b) in enumerate(zip(borders, borders[1:])):
                        rows.append(i)
                        for to, v in zip(out, (piece, a, b - a, zlib.crc32(tokens[a:b].tobytes()), tokens[a:b])):
                            to.append(v)
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
                columns = [names.take(pa.array(rows, pa.int64()))]
                columns += [pa.array(v, k) for v, k in zip(out[: 4 + keep_ids], kinds)]
                yield pa.RecordBatch.from_arrays(columns, names=NAMES[: 5 + keep_ids])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * keep_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


NAMES = ["id", "piece", "start", "length", "ids_crc32", "ids"]


@dataclass(frozen=True)
class Capacity:
    """Room of a sequence, and the weights of the dimensions in the choice."""

    tokens: int = 1024
    documents: int = 1024
    cost: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"  # or "dot"

    def item(self, length: int) -> tuple[int, int, int]:
        return length, 1, length * length

    def room(self) -> tuple[int, int, int]:
        return self.tokens, self.documents, self.cost

    def merit(self, residual: tuple[int, int, int], item: tuple[int, int, int]) -> float:
        """Smaller is better: the norm of what would be left, or minus the dot product."""
        full = self.room()
        if self.rule == "dot":
            return -sum(w * i / f * r / f for w, i, r, f in zip(self.weights, item, residual, full))
        return sum(w * ((r - i) / f) ** 2 for w, i, r, f in zip(self.weights, item, residual, full))


def plan_best_fit(histogram: dict[int, int], capacity: Capacity = Capacity()) -> list[tuple]:
    """Runs (length, rank_from, rank_to, sequence, per_sequence, offset): items of a length with a
    rank in the run lie `per_sequence` to a sequence from `sequence` on, from `offset` on."""
    free: dict[tuple[int, int, int], list[tuple[int, int]]] = {}  # residual -> (first, number)
    runs, sequences = [], 0

    def put(residual: tuple[int, int, int], first: int, number: int) -> None:
        if number and min(residual) > 0:
            free.setdefault(residual, []).append((first, number))

    for length in sorted(histogram, reverse=True):
        item, left, rank = capacity.item(length), histogram[length], 0
        if any(i > r for i, r in zip(item, capacity.room())):
            raise ValueError(f"an item of {length} tokens does not fit an empty sequence")
        choice = sorted(
            (r for r in free if all(x >= i for x, i in zip(r, item))), key=lambda r: (capacity.merit(r, item), r)
        )
        while left:
            residual = choice.pop(0) if choice else capacity.room()
            each = min(r // i for r, i in zip(residual, item))
            if residual == capacity.room():
                blocks = [(sequences, -(-left // each))]
                sequences += blocks[0][1]
            else:
                blocks = free.pop(residual)
            while blocks:
                first, number = blocks.pop()
                if not left:
                    put(residual, first, number)
                    continue
                for per, n in ((each, min(number, left // each)), (left % each, 1)):
                    if per and n and left >= per and n <= number:
                        if per < each and left >= each:
                            continue
                        runs.append((length, rank, rank + per * n, first, per, capacity.tokens - residual[0]))
                        put(tuple(r - per * i for r, i in zip(residual, item)), first, n)
                        rank, left = rank + per * n, left - per * n
                        first, number = first + n, number - n
                put(residual, first, number)
    return runs


RUN = "length long, rank_from long, rank_to long, first long, per_sequence long, base long"


def pack(pieces: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """`pieces` (with `length`) and its sequence_id and offset. The table is written out once, then
    ranked inside (part of the table, length): no length is one task, however frequent it is."""
    spark = pieces.sparkSession
    held = cut_lineage(pieces.withColumn("_part", F.spark_partition_id()))
    counts = held.groupBy("_part", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut_lineage(counts.select("*", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs = spark.createDataFrame(plan_best_fit(histogram, capacity), RUN)
    inside = Window.partitionBy("_part", "length").orderBy(*[c for c in ("id", "piece") if c in pieces.columns])
    ranked = (
        held.withColumn("_k", F.row_number().over(inside) - 1)
        .join(counts.drop("_n"), ["_part", "length"])
        .withColumn("_rank", F.col("_before") + F.col("_k"))
    )
    at = F.col("_rank") - F.col("rank_from")
    # The runs are a few for each length at most, whatever the number of documents.
    return (
        ranked.join(F.broadcast(runs), "length")
        .where((F.col("_rank") >= F.col("rank_from")) & (F.col("_rank") < F.col("rank_to")))
        .withColumn("sequence_id", F.col("first") + F.floor(at / F.col("per_sequence")).cast("long"))
        .withColumn("offset", F.col("base") + at % F.col("per_sequence") * F.col("length"))
        .select(*pieces.columns, "sequence_id", "offset")
    )


def pack_documents(
    docs: DataFrame, vocabulary: str, capacity: Capacity = Capacity(), end_id: int = 2,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32, sequence_id, offset. Null ids and
    repeated rows are packed like others; an empty table gives no rows."""
    pieces = tokenised_pieces(docs, vocabulary, capacity.tokens, end_id, id_col, text_col)
    return pack(pieces, capacity).withColumnRenamed("id", id_col)
