"""Similarity join on word n-grams: points of group counts in an R-tree, then exact sets.

The n-grams of a text are hashed into groups, and the text becomes the point of its group counts.
Two texts share at most the summed coordinate minima of their points, and a box of points shares at
most the summed minima with the largest coordinates of the box, so points and boxes that can't
reach the threshold are never verified.

One tree over all texts has hundreds of useful coordinates and boxes that all overlap, so the top
level is cut by the counts themselves: for texts of a size class the groups form m blocks, more than
the n-grams in which two linked texts can differ, so linked texts have the same counts in at least
one block. Equal blocks meet in a bucket. A bucket holds little but near copies.

1. One node for each distinct set (copies are one node), with a key for every block.
2. In every bucket each node is compared with the first node of the bucket: a star, as many pairs
   as rows. Pairs that the bound lets through are verified. Most links of a group of near copies
   need no more.
3. Buckets of three nodes or more that still hold several components: R-trees over their points,
   large buckets cut into chunks. Of the pairs that the bound lets through a forest is verified
   first, then every one that is still between different components. No pair in a bucket is left
   out, so no link is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm import words as W
from sluice.llm.columns import free_name
from sluice.operators.components import connected_components
from sluice.session import cut_lineage

CLASS_RATIO = 1.5  # sizes of a class; at least 1 / threshold
FAMILIES = 4  # other cuts into blocks for texts with an empty block
LEAF = 32  # points of a leaf of the tree
CHUNK = 1_024  # nodes of a bucket in one task
GROUP = np.uint64(0xFFFF)
GROUPS = 256  # coordinates of the points of the tree


def class_edges(largest: int) -> np.ndarray:
    """First sizes of the size classes, up to beyond `largest`."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, int(edges[-1] * CLASS_RATIO)))
    return np.array(edges, np.int64)


def differing(size: int, threshold: Fraction) -> int:
    """N-grams of either text alone at most, for linked texts of at most `size` n-grams each."""
    return int(2 * size * (1 - threshold) / (1 + threshold))


def required(total: np.ndarray, threshold: Fraction) -> np.ndarray:
    """N-grams that linked texts share at least, by the sum of their sizes."""
    up, low = threshold.numerator, threshold.numerator + threshold.denominator
    return -(-up * total // low)


def block_number(least: int, differ: int) -> int:
    """Blocks for a class whose smallest texts have `least` n-grams: so many that those still fill one
    more than can differ, by three deviations if a number does that, else by two or one."""
    for deviations in (3, 2, 1):
        for blocks in range(differ + 1, 2 * differ + 8):
            empty = blocks * math.exp(-least / blocks)
            if blocks - empty - deviations * math.sqrt(empty) >= differ + 1:
                return blocks
    return differ + 1


class _Keys:
    """Bucket keys of a set. Linked texts differ in at most d blocks of a class. A text that fills
    d + 1 blocks or more has at least one filled block that any linked text has too, so it needs no
    keys for its empty blocks. Others are cut into blocks anew, and if no cut fills enough blocks,
    the empty blocks of the last cut are keys as well."""

    def __init__(self, threshold: Fraction):
        self.threshold, self.edges = threshold, class_edges(1)
        self.weights = W.numbers(int(GROUP) + 1, 11)
        self.roles = W.numbers(FAMILIES, 12)
        self.classes: dict[int, tuple[int, int, int]] = {}

    def class_of(self, c: int) -> tuple[int, int, int]:
        """(smallest size, n-grams that can differ, blocks) of a class."""
        if c not in self.classes:
            low = -(-int(self.edges[c]) * self.threshold.numerator // self.threshold.denominator)
            differ = differing(int(self.edges[c + 1]) - 1, self.threshold)
            self.classes[c] = low, differ, block_number(low, differ)
        return self.classes[c]

    def of(self, grams: np.ndarray) -> np.ndarray:
        n = len(grams)
        if not n:
            return grams
        if self.edges[-1] <= 2 * n:
            self.edges = class_edges(2 * n)
        own = int(np.searchsorted(self.edges, n, "right")) - 1
        found = []
        for c in (own, own + 1):
            low, differ, blocks = self.class_of(c)
            if n < low or not differ:  # none differs: only equal sets, which are one node
                continue
            for family in range(FAMILIES):
                h = W.mix(grams ^ self.roles[family]) if family else grams
                block = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
                weight = self.weights[(h & GROUP).astype(np.int64)]
                order = np.argsort(block, kind="stable") if family else slice(None)
                block, weight = block[order], weight[order]
                first = np.flatnonzero(np.diff(block, prepend=np.uint64(1 << 40)))
                counts = np.add.reduceat(weight, first)
                cell = block[first]
                enough = len(cell) > differ
                if not enough and family + 1 == FAMILIES:
                    missing = np.setdiff1d(np.arange(blocks, dtype=np.uint64), cell)
                    cell = np.concatenate([cell, missing])
                    counts = np.concatenate([counts, np.zeros(len(missing), np.uint64)])
                place = np.uint64((c * FAMILIES + family) << 40) + cell
                found.append(W.mix(counts + W.mix(place)))
                if enough:
                    break
        return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(id, text_hash, n_shingles, sig_a, sig_b): size and 128-bit signature of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = W.numbers(2, 13)
        for batch in batches:
            for first, texts in W.chunks(batch.column(2).to_pylist()):
                grams = W.sets(*W.ngram_hashes(*W.word_hashes(texts), n))
                with np.errstate(over="ignore"):
                    a, b = (
                        np.array([W.mix(g ^ s).sum(dtype=np.uint64) for g in grams], np.uint64)
                        for s in salt
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        batch.column(1).slice(first, len(texts)),
                        pa.array([len(g) for g in grams], pa.int64()),
                        pa.array(_signed(a)),
                        pa.array(_signed(b)),
                    ],
                    names=["id", "text_hash", "n_shingles", "sig_a", "sig_b"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col)
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).mapInArrow(
        run, f"id {kind}, text_hash long, n_shingles long, sig_a long, sig_b long"
    )


def bucket_keys(texts: DataFrame, n: int, threshold: Fraction) -> DataFrame:
    """(node, keys) of `texts` (node, text): the bucket keys of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = _Keys(threshold)
        for batch in batches:
            for first, texts in W.chunks(batch.column(1).to_pylist()):
                grams = W.sets(*W.ngram_hashes(*W.word_hashes(texts), n))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array([_signed(keys.of(g)) for g in grams], pa.list_(pa.int64())),
                    ],
                    names=["node", "keys"],
                )

    return texts.select("node", "text").mapInArrow(run, "node long, keys array<long>")


def set_points(texts: DataFrame, n: int) -> DataFrame:
    """(node, size, point) of `texts` (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in W.chunks(batch.column(1).to_pylist()):
                grams = W.sets(*W.ngram_hashes(*W.word_hashes(texts), n))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array([len(g) for g in grams], pa.int64()),
                        pa.array([point(g) for g in grams], pa.binary()),
                    ],
                    names=["node", "size", "point"],
                )

    return texts.select("node", "text").mapInArrow(run, "node long, size long, point binary")


def shingle_sets(texts: DataFrame, n: int) -> DataFrame:
    """(node, grams) of `texts` (node, text): sets of n-gram hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in W.chunks(batch.column(1).to_pylist()):
                grams = W.sets(*W.ngram_hashes(*W.word_hashes(texts), n))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array([_signed(g) for g in grams], pa.list_(pa.int64())),
                    ],
                    names=["node", "grams"],
                )

    return texts.select("node", "text").mapInArrow(run, "node long, grams array<long>")


# --- the tree over the points of a bucket -----------------------------------------------------


def point(grams: np.ndarray) -> bytes:
    """Counts of the groups of a set, 16 bits each, or 32 for sets where those could overflow."""
    kind = np.uint16 if len(grams) <= 0xFFFF else np.uint32
    return np.bincount((grams % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS).astype(kind).tobytes()


def _points(stored: list[bytes]) -> np.ndarray:
    return np.array([np.frombuffer(p, np.uint16 if len(p) == 2 * GROUPS else np.uint32) for p in stored], np.int32)


class Node:
    """A box of points: the largest coordinates, the smallest size, and children or members."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, members: np.ndarray):
        self.top, self.least = points[members].max(axis=0), int(sizes[members].min())
        self.members, self.children = members, []
        if len(members) > LEAF:
            spread = points[members].var(axis=0)
            order = members[np.argsort(points[members, int(spread.argmax())], kind="stable")]
            half = len(order) // 2
            self.children = [Node(points, sizes, order[:half]), Node(points, sizes, order[half:])]


def tree_pairs(
    left: Node, right: Node, points: np.ndarray, sizes: np.ndarray, threshold: Fraction
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (one of `left`, one of `right`) whose points can reach the threshold."""
    todo = [(left, right)]
    while todo:
        a, b = todo.pop()
        bound = int(np.minimum(a.top, b.top).sum())
        if bound < int(required(np.int64(a.least + b.least), threshold)):
            continue
        if a.children and (not b.children or len(a.members) >= len(b.members)):
            todo += [(c, b) for c in a.children]
        elif b.children:
            todo += [(a, c) for c in b.children]
        else:
            shared = np.minimum(points[a.members][:, None], points[b.members][None]).sum(axis=2)
            total = sizes[a.members][:, None] + sizes[b.members][None]
            i, j = np.nonzero(shared >= required(total, threshold))
            yield a.members[i], b.members[j]


def _joining(pairs: np.ndarray, labels: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Of pairs of rows, those of a forest that joins all labels they join, best bounds first."""
    above = {int(x): int(x) for x in labels}

    def root(x: int) -> int:
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    kept = []
    for k in np.argsort(-bounds, kind="stable"):
        a, b = root(int(labels[pairs[k, 0]])), root(int(labels[pairs[k, 1]]))
        if a != b:
            above[b] = a
            kept.append(k)
    return pairs[kept]


def _one_bucket(points, sizes, node, label, pivot, side, threshold: Fraction, forest: bool) -> np.ndarray:
    """Pairs of one (bucket, chunk, chunk) that the points let through, of different labels and
    without the pairs of the star: all of them, or a forest."""
    pairs = [np.zeros((0, 2), np.int64)]
    one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(two):
        two = one
    if len(one):
        for i, j in tree_pairs(Node(points, sizes, one), Node(points, sizes, two), points, sizes, threshold):
            keep = (label[i] != label[j]) & (node[i] != pivot[i]) & (node[j] != pivot[j])
            pairs.append(np.stack([i[keep], j[keep]], axis=1))
    found = np.concatenate(pairs)
    if forest and len(found):
        shared = np.minimum(points[found[:, 0]], points[found[:, 1]]).sum(axis=1)
        found = _joining(found, label, shared / (sizes[found[:, 0]] + sizes[found[:, 1]]))
    return node[found]


def _bucket_pairs(threshold: Fraction, forest: bool):
    """For rows sorted by (key, i, j): a bucket at a time, whatever the borders of the batches."""
    names = ["key", "i", "j", "pivot", "node", "label", "side", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(table: pa.Table) -> pa.RecordBatch:
            c = {n: table.column(n).to_numpy() for n in names}
            points = _points(table.column("point").to_pylist())
            key = np.stack([c["key"], c["i"], c["j"]])
            first = np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)]))
            found = [np.zeros((0, 2), np.int64)]
            for a, b in zip(first, [*first[1:], key.shape[1]]):
                part = [c[n][a:b] for n in ("size", "node", "label", "pivot", "side")]
                if b - a > 1 and (part[2] != part[2][0]).any():
                    found.append(_one_bucket(points[a:b], *part, threshold, forest))
            ends = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"])

        for batch in batches:
            held.append(batch)
            table = pa.Table.from_batches(held)
            key = [table.column(n).to_numpy() for n in ("key", "i", "j")]
            last = np.flatnonzero(np.any([k != k[-1] for k in key], axis=0)) if len(key[0]) else []
            if len(last):
                cut = int(last[-1]) + 1
                yield done(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held and sum(map(len, held)):
            yield done(pa.Table.from_batches(held))

    return run


# --- buckets ----------------------------------------------------------------------------------


PACKED = "shard int, keys binary, nodes binary, counts binary"
FLUSH = 400_000  # keys a task holds before it sends them on
SHARD = 2_000_000  # n-grams to a shard of keys: there are fewer keys than n-grams
DEALT = 10_000  # further nodes in a row


def _pack_keys(shards: int):
    """Rows (shard, keys, nodes, counts) of (node, keys): for each key its first node in the task
    and the number of its nodes there, so that a frequent key is one entry of a task. Further nodes
    of a key are rows without counts, dealt over all shards."""

    def packed(keys: list[np.ndarray], nodes: list[int]) -> Iterator[pa.RecordBatch]:
        k = np.concatenate(keys)
        n = np.repeat(np.array(nodes, np.int64), [len(x) for x in keys])
        order = np.lexsort((n, k))
        k, n = k[order], n[order]
        new = np.concatenate([[True], k[1:] != k[:-1]])
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(k))).astype(np.int32)
        # keys are sorted, so the keys of a shard are a run
        borders = (np.arange(1, shards, dtype=object) * (1 << 64) // shards).astype(np.uint64)
        at = [0, *map(int, np.searchsorted(k[first], borders)), len(first)]
        k1, n1 = k[first], n[first]
        rows = []
        for shard, (a, b) in enumerate(zip(at, at[1:])):
            if a < b:  # by node: runs of equal nodes take little room in the shuffle
                by_node = a + np.argsort(n1[a:b], kind="stable")
                rows.append((shard, k1[by_node], n1[by_node], counts[by_node]))
        k, n = k[~new], n[~new]
        for a in range(0, len(k), DEALT):
            rows.append((int(k[a] % np.uint64(shards)), k[a : a + DEALT], n[a : a + DEALT], np.zeros(0, np.int32)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int32())]
            + [pa.array([r[i].tobytes() for r in rows], pa.binary()) for i in (1, 2, 3)],
            names=["shard", "keys", "nodes", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, held = [], [], 0
        for batch in batches:
            for node, own in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = own.values.to_numpy().view(np.uint64)
                if len(own):
                    keys.append(own)
                    nodes.append(node)
                    held += len(own)
                if held > FLUSH:
                    yield from packed(keys, nodes)
                    keys, nodes, held = [], [], 0
        if held:
            yield from packed(keys, nodes)

    return run


def _shared_keys(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """(key, pivot, node, held) of the keys of a shard that two nodes or more have: the pivot is
    the first of the nodes, and held their number. Further nodes come out with neither."""
    rows = [
        [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
        for name, kind in (("keys", np.uint64), ("nodes", np.int64), ("counts", np.int32))
    ]
    none = [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)]
    k, n, c = (np.concatenate([z, *[x for x, at in zip(r, rows[2]) if len(at)]]) for z, r in zip(none, rows))
    more_k, more_n = (np.concatenate([z, *[x for x, at in zip(r, rows[2]) if not len(at)]]) for z, r in zip(none, rows[:2]))
    order = np.lexsort((n, k))
    k, n, c = k[order], n[order], c[order].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(k)))
    held = np.repeat(np.add.reduceat(c, first), size) if len(k) else c
    keep = held > 1
    absent = pa.nulls(len(more_k), pa.int64())
    return pa.table(
        {
            "key": np.concatenate([k[keep], more_k]).view(np.int64),
            "pivot": pa.concat_arrays([pa.array(np.repeat(n[first], size)[keep]), absent]),
            "node": np.concatenate([n[keep], more_n]),
            "held": pa.concat_arrays([pa.array(held[keep]), absent]),
        }
    )


def bucket_members(nodes: DataFrame, grams: int = 0) -> DataFrame:
    """(key, pivot, node, held) of `nodes` (node, keys): the nodes of every key of two or more. `grams`
    is the number of n-grams of all nodes; the shards grow with it, not with what a task holds."""
    shards = max(int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-grams // SHARD))
    packed = nodes.select("node", "keys").mapInArrow(_pack_keys(shards), PACKED)
    found = cut_lineage(
        packed.groupBy("shard").applyInArrow(_shared_keys, "key long, pivot long, node long, held long")
    )
    firsts, rest = found.where("pivot IS NOT NULL"), found.where("pivot IS NULL").select("key", "node")
    buckets = firsts.select("key", "pivot", "held").distinct()
    return firsts.unionByName(rest.join(buckets, "key").select("key", "pivot", "node", "held"))


# --- the join ---------------------------------------------------------------------------------


def _within_bound(pairs: DataFrame, points: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs (a, b) of nodes whose points can reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2_000):
                part = batch.slice(low, 2_000)
                shared = np.minimum(_points(part.column(3).to_pylist()), _points(part.column(4).to_pylist())).sum(axis=1)
                keep = pa.array(shared >= required(part.column(2).to_numpy(), threshold))
                yield part.select(["a", "b"]).filter(keep)

    left, right = (
        points.select(F.col("node").alias(x), F.col("size").alias(f"size_{x}"), F.col("point").alias(f"point_{x}"))
        for x in ("a", "b")
    )
    close = F.least("size_a", "size_b") * threshold.denominator >= F.greatest("size_a", "size_b") * threshold.numerator
    both = pairs.distinct().join(left, "a").join(right, "b").where(close)
    total = (F.col("size_a") + F.col("size_b")).alias("total")
    return both.select("a", "b", total, "point_a", "point_b").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, n: int, threshold: Fraction) -> DataFrame:
    """Pairs (a, b) of nodes whose sets reach the threshold. Sets are made of the texts of these
    pairs only."""
    pairs = cut_lineage(pairs.distinct())
    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    held = cut_lineage(shingle_sets(texts.join(needed, "node"), n))
    left = held.select(F.col("node").alias("a"), F.col("grams").alias("ga"))
    right = held.select(F.col("node").alias("b"), F.col("grams").alias("gb"))
    shared = F.size(F.array_intersect("ga", "gb")).cast("long")
    union = F.size("ga") + F.size("gb") - F.col("shared")
    return (
        pairs.join(left, "a").join(right, "b")
        .select("a", "b", "ga", "gb", shared.alias("shared"))
        .where(F.col("shared") * threshold.denominator >= union * threshold.numerator)
        .select("a", "b")
    )


def _more_links(
    members: DataFrame, labels: DataFrame, points: DataFrame, texts: DataFrame, n: int, threshold: Fraction,
    forest: bool,
) -> DataFrame:
    """Labels (node, label) after the links inside the buckets of `members` that hold several labels."""
    mixed = members.join(labels, "node")
    split = mixed.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    mixed = cut_lineage(mixed.join(split.where("x != y").select("key"), "key"))
    if mixed.isEmpty():
        return labels
    parts = F.ceil(F.col("held") / CHUNK).cast("int")
    mixed = mixed.select("*", parts.alias("parts"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("own"))
    mixed = mixed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = mixed.select(
        "key", "pivot", "node", "label", F.least("own", "other").alias("i"),
        F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"),
    ).join(points, "node")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    more = dealt.mapInArrow(_bucket_pairs(threshold, forest), "a long, b long")
    fresh = cut_lineage(_verified(more, texts, n, threshold))
    at_a = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
    at_b = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
    merged = connected_components(
        labels.select(F.col("label").alias("id")).distinct(),
        fresh.join(at_a, "a").join(at_b, "b").select(F.col("la").alias("a"), F.col("lb").alias("b")),
    )
    return cut_lineage(
        labels.join(merged.withColumnRenamed("id", "label"), "label").select("node", F.col("component").alias("label"))
    )


def _components(
    docs: DataFrame, id_col: str, text_col: str, n: int, threshold: str
) -> tuple[DataFrame, DataFrame]:
    """(rows, components): each row of `docs` with its id, text_hash, n_shingles and the signature of its
    set, and for each signature the first (unknown, id, text_hash, row) of its component."""
    limit = Fraction(threshold)
    if limit * Fraction(str(CLASS_RATIO)) < 1:
        raise ValueError(f"a threshold under {1 / CLASS_RATIO:.2f} would lose links: linked sets may share no size class")
    rows = cut_lineage(signatures(docs, id_col, text_col, n).withColumn("row", F.monotonically_increasing_id()))
    first = F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "text_hash", "row")).alias("first")
    nodes = (
        rows.where("n_shingles > 0").groupBy("sig_a", "sig_b").agg(first, F.max("n_shingles").alias("n_shingles"))
        .select("sig_a", "sig_b", "n_shingles", F.col("first.row").alias("node"), F.col("first.id").alias("least"), "first.text_hash", "first")
    )
    nodes = cut_lineage(nodes)
    # a struct is a key that takes null ids as equal
    by_row = docs.select(
        F.struct(F.col(id_col).alias("id")).alias("_key"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash")
    ).dropDuplicates(["_key", "text_hash"])
    wanted = nodes.select("node", F.struct(F.col("least").alias("id")).alias("_key"), "text_hash")
    texts = cut_lineage(by_row.join(wanted, ["_key", "text_hash"]).select("node", "text"))
    grams = nodes.agg(F.sum("n_shingles").alias("n")).first().n or 0
    members = cut_lineage(bucket_members(bucket_keys(texts, n, limit), grams))
    points = cut_lineage(set_points(texts, n))

    star = members.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    links = cut_lineage(_verified(_within_bound(star, points, limit), texts, n, limit))
    labels = connected_components(members.select(F.col("node").alias("id")).distinct(), links)
    labels = cut_lineage(labels.select(F.col("id").alias("node"), F.col("component").alias("label")))

    # A forest of each bucket first: most groups are one component after it, and pairs inside a
    # component need no look. Then every pair that is left.
    for forest in (True, False):
        labels = _more_links(members.where("held > 2"), labels, points, texts, n, limit, forest)
    labels = labels.withColumnRenamed("label", "component")

    grouped = nodes.join(labels, "node", "left").select(
        "sig_a", "sig_b", "first", F.coalesce("component", "node").alias("component")
    )
    least = grouped.groupBy("component").agg(F.min("first").alias("top"))
    return rows, grouped.join(least, "component").select("sig_a", "sig_b", "top")


def ngram_jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, threshold: str = "0.9"
) -> DataFrame:
    """(id, n_shingles, component_id) for every row of `docs`: the size of its set of word n-grams
    and the smallest id reachable by links (Jaccard similarity of the sets >= `threshold`).

    Repeated rows and rows with equal sets share a component. A row without words (or without text)
    has an empty set and is its own component. Rows whose id is null take part; they get the
    smallest id that is not null of their component, or null. Columns besides the two are not read.
    """
    rows, found = _components(docs, id_col, text_col, n, threshold)
    return rows.select("id", "n_shingles", "sig_a", "sig_b").join(found, ["sig_a", "sig_b"], "left").select(
        F.col("id").alias(id_col), "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("top.id")).otherwise(F.col("id")).alias("component_id"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: str = "0.8"
) -> DataFrame:
    """Of the rows of a component only the first stays: the smallest id (null last), then the smallest
    hash of the text; of equal rows one. A row goes for its own text: another row of its id, with another
    text, is not touched. Rows without words are no duplicates and stay, repeated ones too. All columns
    of `docs` are kept, whatever their names.

    Only what goes is joined to the texts: the (id, hash) of rows that are not the first, and of rows
    that repeat a first."""
    rows, found = _components(docs, id_col, text_col, n, threshold)
    own = F.struct(F.col("id").alias("id"), "text_hash")
    placed = rows.where("n_shingles > 0").join(found, ["sig_a", "sig_b"]).select(
        own.alias("own"), F.struct(F.col("top.id").alias("id"), F.col("top.text_hash").alias("text_hash")).alias("top")
    )
    gone = cut_lineage(placed.where("own != top").select("own").distinct())
    again = cut_lineage(placed.where("own = top").groupBy("own").agg(F.count("*").alias("n")).where("n > 1").select("own"))
    mark = free_name(docs, "own")
    marked = docs.withColumn(mark, F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash")))
    kept = marked.join(gone.withColumnRenamed("own", mark), mark, "left_anti")
    again = again.withColumnRenamed("own", mark)
    single = kept.join(again, mark, "left_anti")
    first = kept.join(again, mark, "left_semi").dropDuplicates([mark])
    return single.unionByName(first).select(*docs.columns)
