"""Interpolated modified Kneser-Ney model of word pairs, counted in Spark, kept as sorted arrays.

The model is a folder of arrays that all executors share: for each shard the sorted word hashes
with counts, the sorted pairs of word numbers with counts, sums by context, and continuation
counts. Workers map the files into memory and look up sorted batches. Every shard is written by one
task under a name of its own and moved into place, so a task that runs again writes the same file.

What a shuffle carries are sorted arrays, counted in each task before: one row per task and shard.
Words that make up a thousandth of the tokens or more (a thousand words at most) have their pairs
dealt over all shards; only the sums of those contexts are added up in a second step.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm import words as W
from sluice.session import cut_lineage, shared_folder

END = np.uint64(0x5EED0E4D)  # the hash that stands for the end of a text
FLUSH = 4_000_000  # distinct entries a task holds before it sends them on
HOT_SHARE = 1_000
HALF = np.uint64(32)
LOW = np.uint64(0xFFFFFFFF)


def mounted(folder: str) -> str:
    """Local path of a shared folder; memory mapping needs one that executors have mounted."""
    path = folder.removeprefix("file://") if folder.startswith("file://") else folder.removeprefix("file:")
    if "://" in path:
        raise ValueError(f"a memory-mapped model needs a mounted shared folder, not {folder}")
    return path


def _save(path: str, values: np.ndarray) -> None:
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, values)
    os.replace(part, path)


def _shard_of_hash(h: np.ndarray, shards: int) -> np.ndarray:
    return ((h >> HALF) * np.uint64(shards)) >> HALF


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, and the first token of each text and the total."""
    words, starts = W.word_hashes(texts)
    n = len(texts)
    firsts = starts + np.arange(n + 1)
    out = np.empty(len(words) + n, np.uint64)
    ends = firsts[1:] - 1
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside], out[ends] = words, END
    return out, firsts


def _merge(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    if not len(k):
        return k, c
    order = np.argsort(k)
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(c, first)


class _Counter:
    """Counts of 64-bit keys, merged now and then so that a task holds distinct keys."""

    def __init__(self):
        self.keys, self.counts, self.held = [], [], 0

    def add(self, keys: np.ndarray) -> bool:
        k, c = np.unique(keys, return_counts=True)
        self.keys.append(k)
        self.counts.append(c.astype(np.int64))
        self.held += len(k)
        if self.held > FLUSH:
            k, c = _merge(self.keys, self.counts)
            self.keys, self.counts, self.held = [k], [c], len(k)
        return self.held > FLUSH // 2 and len(self.keys) == 1

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        k, c = _merge(self.keys, self.counts) if self.keys else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        self.__init__()
        return k, c


def _packed(keys: np.ndarray, counts: np.ndarray, shard: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (shard, keys, counts) of arrays as bytes; counts of 255 and more are kept apart."""
    order = np.argsort(shard, kind="stable")
    keys, counts, shard = keys[order], counts[order], shard[order]
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(shard) else []
    for a, b in zip(first, [*first[1:], len(shard)]):
        c = counts[a:b]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(shard[a])], pa.int32()),
                pa.array([keys[a:b].tobytes()], pa.binary()),
                pa.array([np.minimum(c, 255).astype(np.uint8).tobytes()], pa.binary()),
                pa.array([c[c >= 255].tobytes()], pa.binary()),
            ],
            names=["shard", "keys", "counts", "large"],
        )


PACKED = "shard int, keys binary, counts binary, large binary"


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for k, c, large in zip(*(table.column(n).to_pylist() for n in ("keys", "counts", "large"))):
        keys.append(np.frombuffer(k, np.uint64))
        c = np.frombuffer(c, np.uint8).astype(np.int64)
        c[c == 255] = np.frombuffer(large, np.int64)
        counts.append(c)
    return _merge(keys, counts)


def _discounts(seen: dict[int, int]) -> list[float]:
    """Discounts of counts 1, 2 and 3 or more from the numbers of entries seen 1 to 4 times."""
    n = [seen.get(i, 0) for i in range(5)]
    if not (n[1] and n[2]):
        return [0.5, 0.75, 1.0]
    y = n[1] / (n[1] + 2 * n[2])
    found = [k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2 for k in (1, 2, 3)]
    return [min(max(d, 0.05), k) for d, k in zip(found, (1, 2, 3))]


@dataclass
class Model:
    """Where the arrays are, and the few numbers that belong to the whole of them."""

    folder: str
    shards: int
    tokens: int
    vocabulary: int
    offsets: list[int]  # number of the first word of each shard, and their total
    hot: list[int]  # words whose pairs are dealt over all shards
    hot_sums: dict[int, tuple[int, int, int, int]] = field(default_factory=dict)
    pairs: int = 0
    discounts: list[float] = field(default_factory=list)
    lower_discounts: list[float] = field(default_factory=list)
    lower_seen: tuple[int, int, int] = (0, 0, 0)

    def open(self) -> _Arrays:
        return _Arrays(self)


class _Arrays:
    """The arrays of a model, mapped into memory as they are needed."""

    def __init__(self, model: Model):
        self.model, self.maps = model, {}
        self.offsets = np.array(model.offsets, np.int64)
        self.hot = np.array(model.hot, np.int64)

    def get(self, kind: str, shard: int) -> np.ndarray:
        if (kind, shard) not in self.maps:
            path = f"{self.model.folder}/{kind}-{shard}.npy"
            self.maps[kind, shard] = np.load(path, mmap_mode="r") if os.path.exists(path) else np.zeros(0, np.uint64)
        return self.maps[kind, shard]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of sorted distinct word hashes; -1 for unknown ones."""
        out = np.full(len(hashes), -1, np.int64)
        shard = _shard_of_hash(hashes, self.model.shards)
        cut = np.searchsorted(shard, np.arange(self.model.shards + 1, dtype=np.uint64))
        for s in range(self.model.shards):
            part = slice(cut[s], cut[s + 1])
            held = self.get("words", s)
            if cut[s] < cut[s + 1] and len(held):
                at = np.minimum(np.searchsorted(held, hashes[part]), len(held) - 1)
                out[part] = np.where(held[at] == hashes[part], at + self.offsets[s], -1)
        return out

    def by_number(self, kind: str, numbers: np.ndarray) -> np.ndarray:
        """Values of an array by word number, for sorted known numbers."""
        out = np.zeros(len(numbers), np.float64)
        cut = np.searchsorted(numbers, self.offsets)
        for s in range(self.model.shards):
            if cut[s] < cut[s + 1]:
                out[cut[s] : cut[s + 1]] = self.get(kind, s)[numbers[cut[s] : cut[s + 1]] - self.offsets[s]]
        return out

    def pair_shard(self, pairs: np.ndarray) -> np.ndarray:
        left = (pairs >> HALF).astype(np.int64)
        own = np.minimum(np.searchsorted(self.offsets, left, "right") - 1, self.model.shards - 1)
        spread = (W.mix(pairs & LOW) % np.uint64(self.model.shards)).astype(np.int64)
        return np.where(np.isin(left, self.hot) | (left >= self.offsets[-1]), spread, own)

    def pair_counts(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of sorted distinct pairs."""
        out = np.zeros(len(pairs), np.int64)
        shard = self.pair_shard(pairs)
        for s in np.unique(shard):
            mine = np.flatnonzero(shard == s)
            wanted = pairs[mine]
            for keys, counts in (("once", None), ("more", "times")):
                held = self.get(keys, int(s))
                if len(held):
                    at = np.minimum(np.searchsorted(held, wanted), len(held) - 1)
                    found = held[at] == wanted
                    out[mine[found]] = 1 if counts is None else self.get(counts, int(s))[at[found]]
        return out


def _count_words(texts: DataFrame, shards: int) -> DataFrame:
    def run(batches):
        seen = _Counter()
        for batch in batches:
            for _, chunk in W.chunks(batch.column(0).to_pylist()):
                if seen.add(_tokens(chunk)[0]):
                    k, c = seen.take()
                    yield from _packed(k, c, _shard_of_hash(k, shards))
        k, c = seen.take()
        yield from _packed(k, c, _shard_of_hash(k, shards))

    return texts.mapInArrow(run, PACKED)


def _count_pairs(texts: DataFrame, model: Model) -> DataFrame:
    def run(batches):
        arrays, seen = model.open(), _Counter()
        for batch in batches:
            for _, chunk in W.chunks(batch.column(0).to_pylist()):
                if seen.add(_pair_keys(arrays, *_tokens(chunk))[0]):
                    k, c = seen.take()
                    yield from _packed(k, c, arrays.pair_shard(k))
        k, c = seen.take()
        yield from _packed(k, c, arrays.pair_shard(k))

    return texts.mapInArrow(run, PACKED)


def _pair_keys(arrays: _Arrays, tokens: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pair keys, word numbers, context numbers): the context of a first word is the number after
    the last word's; unknown words are -1 and their keys are those of no pair."""
    distinct, place = np.unique(tokens, return_inverse=True)
    numbers = arrays.numbers(distinct)[place]
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[firsts[:-1]] = arrays.model.vocabulary
    known = (numbers >= 0) & (before >= 0)
    keys = (before.astype(np.uint64) << HALF) | (numbers.astype(np.uint64) & LOW)
    return np.where(known, keys, ~np.uint64(0)), numbers, before


def _tally(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [int((counts >= 3).sum()), len(counts)]


def train(texts: DataFrame, shards: int | None = None) -> Model:
    """Model of the one text column of `texts` (null: no words, but an end)."""
    spark = texts.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = f"{mounted(shared_folder(spark))}/model-{uuid.uuid4().hex}"
    os.makedirs(folder)

    def keep_words(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        k, c = _unpacked(table)
        _save(f"{folder}/words-{shard}.npy", k)
        _save(f"{folder}/counts-{shard}.npy", c)
        top = np.argsort(-c, kind="stable")[:HOT_SHARE]
        return pa.table(
            {
                "shard": pa.array([shard], pa.int32()), "held": pa.array([len(k)], pa.int64()),
                "tokens": pa.array([int(c.sum())], pa.int64()),
                "place": pa.array([top], pa.list_(pa.int64())), "top": pa.array([c[top]], pa.list_(pa.int64())),
            }
        )

    kept = cut_lineage(
        _count_words(texts, shards).groupBy("shard").applyInArrow(
            keep_words, "shard int, held long, tokens long, place array<long>, top array<long>"
        )
    )
    sizes = {r.shard: r.held for r in kept.select("shard", "held").collect()}
    total = kept.agg(F.sum("tokens")).first()[0] or 0
    offsets = np.concatenate([[0], np.cumsum([sizes.get(s, 0) for s in range(shards)])])
    if offsets[-1] >= 1 << 32:
        raise ValueError("more than 2^32 words: pair keys need more than 64 bits")
    frequent = (
        kept.select("shard", F.explode(F.arrays_zip("place", "top")).alias("w"))
        .where(F.col("w.top") * HOT_SHARE >= total).select("shard", "w.place").collect()
    )  # at most a thousand words have a thousandth of the tokens each
    model = Model(folder, shards, total, int(offsets[-1]), [int(x) for x in offsets],
                  sorted(int(offsets[r.shard] + r.place) for r in frequent))

    def keep_pairs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard, arrays = key[0].as_py(), model.open()
        k, c = _unpacked(table)
        once = c == 1
        _save(f"{folder}/once-{shard}.npy", k[once])
        _save(f"{folder}/more-{shard}.npy", k[~once])
        _save(f"{folder}/times-{shard}.npy", c[~once])
        left = (k >> HALF).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], left[1:] != left[:-1]])) if len(left) else np.zeros(0, np.int64)
        context = left[first]
        sums = np.zeros((4, len(context)), np.int64)
        if len(context):
            for row, v in zip(sums, (c, c == 1, c == 2, c >= 3)):
                row[:] = np.add.reduceat(v.astype(np.int64), first)
        apart = np.isin(context, arrays.hot) | (context >= model.vocabulary)
        own = np.zeros((4, int(arrays.offsets[shard + 1] - arrays.offsets[shard])), np.int64)
        own[:, context[~apart] - arrays.offsets[shard]] = sums[:, ~apart]
        for name, row in zip(("total", "n1", "n2", "n3"), own):
            _save(f"{folder}/{name}-{shard}.npy", row.astype(np.uint32) if row.max(initial=0) < 1 << 32 else row)
        words, ahead = np.unique(k & LOW, return_counts=True)
        to = np.searchsorted(arrays.offsets, words.astype(np.int64), "right") - 1
        rows = [r.to_pydict() for r in _packed(words, ahead.astype(np.int64), np.minimum(to, shards - 1))]
        n = len(rows)
        return pa.table(
            {
                "shard": pa.array([r["shard"][0] for r in rows] + [-1], pa.int32()),
                "keys": pa.array([r["keys"][0] for r in rows] + [None], pa.binary()),
                "counts": pa.array([r["counts"][0] for r in rows] + [None], pa.binary()),
                "large": pa.array([r["large"][0] for r in rows] + [None], pa.binary()),
                "seen": pa.array([None] * n + [_tally(c)], pa.list_(pa.int64())),
                "context": pa.array([None] * n + [context[apart]], pa.list_(pa.int64())),
                "sums": pa.array([None] * n + [sums[:, apart].T.ravel()], pa.list_(pa.int64())),
            }
        )

    told = cut_lineage(
        _count_pairs(texts, model).groupBy("shard").applyInArrow(
            keep_pairs, PACKED + ", seen array<long>, context array<long>, sums array<long>"
        )
    )
    seen = told.where("seen IS NOT NULL").select(*[F.sum(F.col("seen")[i]).alias(f"s{i}") for i in range(6)]).first()
    model.discounts = _discounts({k + 1: seen[k] or 0 for k in range(4)})
    model.pairs = seen[5] or 0
    at = F.posexplode("context")
    apart = told.where("size(context) > 0").select("sums", at).select(
        F.col("col").alias("context"), *[F.col("sums")[F.col("pos") * 4 + i].alias(f"c{i}") for i in range(4)]
    )
    model.hot_sums = {
        r.context: (r.c0, r.c1, r.c2, r.c3)
        for r in apart.groupBy("context").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(4)]).collect()
    }  # a thousand words at most, and the start

    def keep_lower(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        k, c = _unpacked(table)
        low = model.offsets[shard]
        row = np.zeros(model.offsets[shard + 1] - low, np.int64)
        row[k.astype(np.int64) - low] = c
        _save(f"{folder}/ahead-{shard}.npy", row.astype(np.uint32) if row.max(initial=0) < 1 << 32 else row)
        return pa.table({"seen": pa.array([_tally(c)], pa.list_(pa.int64()))})

    lower = told.where("shard >= 0").select("shard", "keys", "counts", "large").groupBy("shard").applyInArrow(
        keep_lower, "seen array<long>"
    )
    low = lower.select(*[F.sum(F.col("seen")[i]).alias(f"s{i}") for i in range(6)]).first()
    model.lower_discounts = _discounts({k + 1: low[k] or 0 for k in range(4)})
    model.lower_seen = (low[0] or 0, low[1] or 0, low[4] or 0)
    return model


def _cut(counts: np.ndarray, discounts: list[float]) -> np.ndarray:
    return np.array([0.0, *discounts])[np.minimum(counts, 3).astype(np.int64)]


def score_texts(arrays: _Arrays, texts: list[bytes]) -> pd.DataFrame:
    """n_tokens, n_known, base_score and score of each text."""
    m = arrays.model
    tokens, firsts = _tokens(texts)
    keys, numbers, before = _pair_keys(arrays, tokens, firsts)
    known = numbers >= 0
    word, place = np.unique(np.where(known, numbers, 0), return_inverse=True)
    if not m.vocabulary:
        word = word[:0]

    def of_word(kind: str) -> np.ndarray:
        return arrays.by_number(kind, word)[place] if len(word) else np.zeros(len(tokens))

    count = np.where(known, of_word("counts"), 0)
    base = np.log10((count + 0.5) / (m.tokens + 0.5 * (m.vocabulary + 1)))
    ahead = np.where(known, of_word("ahead"), 0)
    d = m.lower_discounts
    if m.pairs:
        spare = sum(x * n for x, n in zip(d, m.lower_seen)) / m.pairs
        p = np.maximum(ahead - _cut(ahead, d), 0) / m.pairs + spare / (m.vocabulary + 1)
    else:
        p = np.full(len(tokens), 1 / (m.vocabulary + 1))
    context, back = np.unique(np.clip(before, 0, None), return_inverse=True)
    sums = np.zeros((4, len(context)))
    inside = context < m.vocabulary
    for row, kind in zip(sums, ("total", "n1", "n2", "n3")):
        row[inside] = arrays.by_number(kind, context[inside])
    for i, c in enumerate(context):
        if (s := m.hot_sums.get(int(c))) is not None:
            sums[:, i] = s
    total, *n = (row[back] for row in sums)
    total = np.where(before >= 0, total, 0)
    pair, at = np.unique(keys, return_inverse=True)
    c = arrays.pair_counts(pair)[at]
    if m.pairs:
        spare = sum(x * y for x, y in zip(m.discounts, n))
        full = (np.maximum(c - _cut(c, m.discounts), 0) + spare * p) / np.maximum(total, 1)
        p = np.where(total > 0, full, p)
    return pd.DataFrame(
        {
            "n_tokens": np.diff(firsts),
            "n_known": np.add.reduceat((count > 0).astype(np.int64), firsts[:-1]),
            "base_score": np.add.reduceat(base, firsts[:-1]),
            "score": np.add.reduceat(np.log10(p), firsts[:-1]),
        }
    )


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """`docs` without its text, with n_tokens, n_known, train_tokens, base_score and score (log10)."""
    rest = [c for c in docs.columns if c != text_col]
    texts = docs.select(text_col, *rest)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[1:])

    def run(batches):
        arrays = model.open()
        for batch in batches:
            for first, chunk in W.chunks(batch.column(0).to_pylist()):
                got = score_texts(arrays, chunk)
                own = [batch.column(i + 1).slice(first, len(chunk)) for i in range(len(rest))]
                new = [pa.array(got[c].to_numpy()) for c in ("n_tokens", "n_known")]
                new += [pa.array(np.full(len(chunk), m_tokens, np.int64))]
                new += [pa.array(got[c].to_numpy()) for c in ("base_score", "score")]
                yield pa.RecordBatch.from_arrays(own + new, names=rest + NEW)

    m_tokens = model.tokens
    return texts.mapInArrow(
        run, schema + ", n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


NEW = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]


def held_out(id_col: str = "doc_id", folds: int = 5, fold: int = 1) -> Column:
    """Rows kept from training: CRC-32 of the id as text. A null id is trained on."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def perplexity_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for every row of `docs`: id, held_out, n_tokens, n_known, train_tokens, base_score and
    score, from a model of the rows that are not held out. A null or empty text is one end token.
    Perplexity is 10 ** (-score / n_tokens). Repeated rows count and are scored each time."""
    rows = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    model = train(rows.where(~F.col("held_out")).select("text"))
    scored = score(rows, model)
    return scored.withColumnRenamed("_id", id_col)
