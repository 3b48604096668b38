"""Outlines of merged areas. Polygons are directed edges (code, x1, y1, x2, y2) with their area on the
left, so outlines run counter-clockwise and holes clockwise."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from sluice.session import cut_lineage

EDGE = ("x1", "y1", "x2", "y2")
TWICE = "areas of one code overlap: an edge is there twice in one direction"
BROKEN = "edges cross, overlap or end in the open"

CHUNK = 50_000  # edges a task works on at a time
HOT = 8  # a tile with more than so many chunks is not held by one task
SIDE = 256  # cells along a tile in which cells are packed
KEY = ("code", "_tx", "_ty")
MIX = 0x9E3779B97F4A7C15  # odd, spreads bits


def _batched(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held)
            held = []
    if sum(b.num_rows for b in held):
        yield pa.Table.from_batches(held)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Equal values have equal numbers, null -1."""
    return column.combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Positions at which a run of equal rows begins."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _cut(starts: np.ndarray, size: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(run, start) of the pieces of at most `most` rows into which runs are cut."""
    length = np.diff(starts, append=size)
    pieces = -(-length // most)
    run = np.repeat(np.arange(len(starts)), pieces)
    first = np.cumsum(pieces) - pieces
    return run, starts[run] + most * (np.arange(len(run)) - first[run])


def _distinct_cells(cells: DataFrame, code: str) -> DataFrame:
    """Distinct (code, ix, iy). A task packs the cells it reads by tile, two bytes a cell, so rows are short before
    the one shuffle, whose key is the tile. A cell with a null coordinate is a row of its own."""
    if not all(isinstance(cells.schema[c].dataType, IntegralType) for c in ("ix", "iy")):
        return cells.select(F.col(code).alias("code"), "ix", "iy").distinct()
    kind = cells.schema[code].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _batched(batches, 3 * CHUNK):
            null = pc.or_(pc.is_null(table["ix"]), pc.is_null(table["iy"]))
            alone = table.filter(null).group_by(["code", "ix", "iy"], use_threads=False).aggregate([])
            if alone.num_rows:
                yield from pa.table([*(alone[c] for c in ("code", "ix", "iy")), pa.nulls(alone.num_rows, pa.binary())], names=names).to_batches()
            table = table.filter(pc.invert(null))
            if not table.num_rows:
                continue
            x, y, number = table["ix"].to_numpy(), table["iy"].to_numpy(), _numbers(table["code"])
            at = (x % SIDE) * SIDE + y % SIDE
            order = np.lexsort((at, y // SIDE, x // SIDE, number))
            order = order[_starts(number[order], x[order], y[order])]
            tx, ty, at = x[order] // SIDE, y[order] // SIDE, at[order].astype(np.uint16)
            run, first = _cut(_starts(number[order], tx, ty), len(at), 4096)
            ends = np.append(first, len(at)).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(2 * ends), pa.py_buffer(at)])
            code = table["code"].combine_chunks().take(pa.array(order[first]))
            yield pa.RecordBatch.from_arrays([code, pa.array(tx[first]), pa.array(ty[first]), packed], names)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in (batch.slice(i, 64) for i in range(0, batch.num_rows, 64)):
                held.append(part)
                size += part.num_rows + sum(len(c) for c in part["_cells"].to_pylist() if c) // 2
                if size >= 2 * CHUNK:
                    done, held = merged(pa.Table.from_batches(held), False)
                    size = sum(len(c) // 2 for b in held for c in b["_cells"].to_pylist() if c)
                    yield done
        if held:
            yield merged(pa.Table.from_batches(held), True)[0]

    def merged(table: pa.Table, end: bool) -> tuple[pa.RecordBatch, list[pa.RecordBatch]]:
        """The cells of all tiles, less the last one unless this is the `end`, and what stays for later."""
        starts = _starts(*[_numbers(table[k]) for k in KEY])
        run = np.repeat(np.arange(len(starts)), np.diff(starts, append=table.num_rows))
        packed = table["_cells"].to_pylist()
        at = np.frombuffer(b"".join(c for c in packed if c), np.uint16)
        seen = np.unique((np.repeat(run, [len(c) // 2 if c else 0 for c in packed]) << 16) | at)
        firsts = table.take(pa.array(starts)).combine_chunks()
        later = []
        if not end:
            kept = seen[seen >> 16 == len(starts) - 1]
            seen = seen[: len(seen) - len(kept)]
            last = firsts.slice(len(starts) - 1)
            cuts = [(kept[i : i + 4096] & 0xFFFF).astype(np.uint16).tobytes() for i in range(0, len(kept), 4096)] or [None]
            again = last.take(pa.array(np.zeros(len(cuts), np.int64))).select(list(KEY))
            later = pa.table([*again.columns, pa.array(cuts, pa.binary())], names=names).to_batches()
            firsts = firsts.slice(0, len(starts) - 1)
        alone = firsts.filter(pc.is_null(firsts["_cells"])).select(list(KEY))
        found = firsts.select(list(KEY)).take(pa.array(seen >> 16))
        x = found["_tx"].to_numpy() * SIDE + (seen >> 8 & 0xFF)
        y = found["_ty"].to_numpy() * SIDE + (seen & 0xFF)
        rows = pa.table([found["code"], pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["code", "ix", "iy"])
        rows = pa.concat_tables([rows, alone.rename_columns(["code", "ix", "iy"])]).combine_chunks()
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in rows.columns], rows.column_names), later

    names = [*KEY, "_cells"]
    rows = cells.select(F.col(code).alias("code"), F.col("ix").cast("long").alias("ix"), F.col("iy").cast("long").alias("iy"))
    packed = rows.mapInArrow(pack, f"code {kind}, _tx long, _ty long, _cells binary")
    near = packed.repartition(*KEY).sortWithinPartitions(*KEY)
    return near.mapInArrow(unpack, f"code {kind}, ix long, iy long")


def cell_edges(cells: DataFrame, code: str, size: float = 1.0) -> DataFrame:
    """The four edges of each distinct cell (`code`, ix, iy) of side `size`."""
    x, y = F.col("ix").cast("double"), F.col("iy").cast("double")
    corners = [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1)]
    sides = [
        F.struct(*[(v * float(size)).alias(name) for v, name in zip((*corners[i], *corners[(i + 1) % 4]), EDGE)])
        for i in range(4)
    ]
    rows = _distinct_cells(cells, code).select(F.col("code").alias(code), F.explode(F.array(*sides)).alias("e"))
    return rows.select(code, "e.*")


def _keys(values: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the values; zeros are one number, and missing values are."""
    values = np.where(np.isnan(values), np.nan, values + 0.0)
    bits = values.view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(2**63 - 1))


def _values(keys: np.ndarray) -> np.ndarray:
    return (keys ^ ((keys >> 63) & np.int64(2**63 - 1))).view(np.float64)


def _encoded(edges: np.ndarray) -> bytes:
    """Edges as bytes: differences to the edge before and between the ends, by byte, where that is shorter."""
    plain = edges.tobytes()
    if len(edges) < 32:
        return plain
    bits = edges.copy()
    bits[:, 2:] ^= edges[:, :2]
    bits[1:, :2] ^= edges[:-1, :2]
    short = pa.compress(bits.view(np.uint8).reshape(len(edges), 32).T.tobytes(), "zstd", asbytes=True)
    return short if len(short) < len(plain) else plain


def _decoded(packed: bytes, n: int) -> bytes:
    if len(packed) == 32 * n:
        return packed
    planes = np.frombuffer(pa.decompress(packed, 32 * n, "zstd", asbytes=True), np.uint8).reshape(32, n)
    bits = np.ascontiguousarray(planes.T).view(np.int64)
    bits[:, :2] = np.bitwise_xor.accumulate(bits[:, :2], axis=0)
    bits[:, 2:] ^= bits[:, :2]
    return bits.tobytes()


def _net(group: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What is left of the edges of a group when opposite ones cancel: (first row, edge, times) in the order of rows.
    Edges of length 0 are left out."""
    x1, y1, x2, y2 = edges.T
    there = np.flatnonzero((x1 != x2) | (y1 != y2))
    group, edges = group[there], edges[there]
    x1, y1, x2, y2 = edges.T
    ahead = (x1 < x2) | ((x1 == x2) & (y1 < y2))
    ends = [np.where(ahead, a, b) for a, b in ((x1, x2), (y1, y2), (x2, x1), (y2, y1))]
    mixed = group.astype(np.uint64)
    for end in ends:
        mixed = (mixed ^ end.view(np.uint64)) * np.uint64(MIX)
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    starts = _starts(group[order], *[end[order] for end in ends])
    if len(starts) != len(_starts(mixed[order])):  # two edges have one hash
        order = np.lexsort((*ends[::-1], group))
        starts = _starts(group[order], *[end[order] for end in ends])
    if not len(starts):
        return there, edges, there
    net = np.add.reduceat(np.where(ahead, 1, -1)[order], starts)
    left = np.flatnonzero(net)
    row, net = order[starts[left]], net[left]
    kept = np.column_stack([np.where(net > 0, end[row], other[row]) for end, other in zip(ends, (*ends[2:], *ends[:2]))])
    again = np.argsort(row)
    return there[row[again]], kept[again], np.abs(net[again])


def _packed_edges(edges: DataFrame, code: str, tile: float) -> DataFrame:
    """Edges by tile of side `tile`, packed. An edge lies in the tiles of both its ends, so a task that holds a tile has
    all edges at its vertices. Opposite edges that one task reads cancel before the shuffle. Edges with a missing
    coordinate lie in no tile."""
    kind = edges.schema[code].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _batched(batches, CHUNK):
            number = _numbers(table["code"])
            row, kept, times = _net(number, _keys(np.column_stack([table[c].to_numpy() for c in EDGE])))
            row, kept = np.repeat(row, times), np.repeat(kept, times, axis=0)
            at = np.floor(_values(kept) / tile) + 0.0
            at[np.isnan(at).any(axis=1)] = np.nan
            second = np.flatnonzero((at[:, 0] != at[:, 2]) | (at[:, 1] != at[:, 3]))
            second = second[~np.isnan(at[second, 0])]
            row, kept = np.append(row, row[second]), np.vstack([kept, kept[second]])
            tx, ty = np.append(at[:, 0], at[second, 2]), np.append(at[:, 1], at[second, 3])
            order = np.lexsort((ty, tx, number[row]))
            row, kept, tx, ty = row[order], kept[order], tx[order], ty[order]
            if not len(row):
                continue
            _, first = _cut(_starts(number[row], _keys(tx), _keys(ty)), len(row), 1024)
            ends = np.append(first[1:], len(row))
            packed = [_encoded(kept[a:b]) for a, b in zip(first.tolist(), ends.tolist())]
            columns = [pa.array(c[first], from_pandas=True) for c in (tx, ty)]
            code = table["code"].combine_chunks().take(pa.array(row[first]))
            yield pa.RecordBatch.from_arrays([code, *columns, pa.array(ends - first), pa.array(packed, pa.binary())], names)

    names = [*KEY, "_n", "_edges"]
    rows = edges.select(F.col(code).alias("code"), *[F.col(c).cast("double").alias(c) for c in EDGE])
    packed = rows.mapInArrow(pack, f"code {kind}, _tx double, _ty double, _n long, _edges binary")
    return packed.repartition(*KEY).sortWithinPartitions(*KEY)


def _follow(vertex: np.ndarray, edges: np.ndarray, leaves: np.ndarray, arrives: np.ndarray) -> np.ndarray:
    """The edge after each arriving edge, -1 for others. Round a vertex the ends of edges alternate; an area lies
    between an edge that leaves and, counter-clockwise, the next end, which arrives. So the edge to follow
    is the end before the arriving one. `vertex` has the numbers of both ends of each edge."""
    x1, y1, x2, y2 = edges.T
    at = np.concatenate([vertex[leaves, 0], vertex[arrives, 1]])
    angle = np.concatenate([np.arctan2((y2 - y1)[leaves], (x2 - x1)[leaves]), np.arctan2((y1 - y2)[arrives], (x1 - x2)[arrives])])
    edge, out = np.concatenate([leaves, arrives]), np.arange(len(at)) < len(leaves)
    order = np.lexsort((out, angle, at))
    starts = _starts(at[order])
    before = np.arange(-1, len(at) - 1)
    before[starts] = np.append(starts[1:], len(at)) - 1
    edge, out = edge[order], out[order]
    if not out[before[~out]].all():
        raise ValueError(BROKEN)
    following = np.full(len(edges), -1)
    following[edge[~out]] = edge[before[~out]]
    return following


POINT = "struct<" + ", ".join(f"{c}: double" for c in EDGE) + ">"
PIECE = f"xs array<double>, ys array<double>, head {POINT}, place long, n long, closed boolean, " \
    f"link struct<next: {POINT}, id: {POINT}, steps: long>, _tx double, _ty double"
PIECE_NAMES = ["code", "xs", "ys", "head", "place", "n", "closed", "link", "_tx", "_ty"]


def _pieces(code: pa.Array, mine: np.ndarray, after: np.ndarray, follow: np.ndarray) -> pa.RecordBatch:
    """Chains of the edges `mine`, sorted by code and coordinates, of which `after` is the next edge and `follow` its row or
    -1. A chain is rows of up to CHUNK / 1000 edges, the corners from `place` on, with the chain's first edge `head` and
    its length `n`. A ring that lies in these edges is `closed` and its head is its least edge; the first row of an open
    chain carries `link`: the head of the chain after it, and the least edge with the steps to it."""
    size = len(mine)
    first = np.ones(size, bool)
    first[follow[follow >= 0]] = False
    to, walk, ends = follow.tolist(), [], []
    for i in np.flatnonzero(first).tolist():
        while i >= 0:
            walk.append(i)
            i = to[i]
        ends.append(len(walk))
    opened = len(ends)
    first[:] = True
    first[walk] = False
    left = bytearray(first)
    for i in np.flatnonzero(first).tolist():  # what is left are rings; their least edge comes first
        if left[i]:
            while left[i]:
                left[i] = 0
                walk.append(i)
                i = to[i]
            ends.append(len(walk))
    walk, ends = np.array(walk, np.int64), np.array(ends, np.int64)
    starts = np.append(0, ends[:-1])
    chain, at = _cut(starts, size, max(1, CHUNK // 1000))
    length = np.diff(at, append=size)
    offsets = np.append(0, np.cumsum(length + 1))
    corner = np.arange(size) + np.repeat(np.arange(len(at)), length)

    def line(x1: np.ndarray, x2: np.ndarray) -> pa.Array:
        flat = np.empty(offsets[-1])
        flat[corner] = x1[walk]
        flat[offsets[1:] - 1] = x2[walk[at + length - 1]]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))

    def struct(edges: np.ndarray) -> pa.Array:
        return pa.StructArray.from_arrays([pa.array(c) for c in np.ascontiguousarray(edges.T)], list(EDGE))

    step = np.empty(size, np.int64)
    step[walk] = np.arange(size)
    least = np.minimum.reduceat(walk, starts)
    linked = (at == starts[chain]) & (chain < opened)
    link = pa.StructArray.from_arrays(
        [struct(after[walk[ends - 1]][chain]), struct(mine[least][chain]), pa.array((step[least] - starts)[chain])],
        ["next", "id", "steps"], mask=pa.array(~linked),
    )
    columns = [
        code.take(pa.array(walk[at])), line(mine[:, 0], mine[:, 2]), line(mine[:, 1], mine[:, 3]), struct(mine[walk[starts]][chain]),
        pa.array(at - starts[chain]), pa.array((ends - starts)[chain]), pa.array(chain >= opened), link,
        *[pa.nulls(len(at), pa.float64())] * 2,
    ]
    return pa.RecordBatch.from_arrays(columns, PIECE_NAMES)


def _tile_chains(packed: DataFrame, tile: float) -> DataFrame:
    """Chains (see `_pieces`) of packed edges. Of a tile its task holds all edges at its vertices, so edges cancel there
    and it knows the edge after each edge that ends in the tile, and goes on through tiles it holds beside. The edges of
    a tile with more than HOT chunks are left as rows with `_tx` and `_ty`, without `closed`."""

    def edges_of(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        n = table["_n"].to_numpy()
        packed = b"".join(_decoded(p, k) for p, k in zip(table["_edges"].to_pylist(), n.tolist()))
        return np.repeat(np.arange(table.num_rows), n), np.frombuffer(packed, np.int64).reshape(-1, 4)

    def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
        starts = _starts(*[_numbers(table[k]) for k in KEY])
        run = np.repeat(np.arange(len(starts)), np.diff(starts, append=table.num_rows))
        row, edges = edges_of(table)
        kept, edges, times = _net(run[row], edges)
        row, values = row[kept], _values(edges)
        if (times > 1).any():
            raise ValueError(TWICE)
        if np.isnan(values).any():
            raise ValueError(BROKEN)
        if not len(row):
            return
        x, y = (np.unique(edges[:, k::2], return_inverse=True)[1].reshape(-1, 2) for k in (0, 1))
        vertex = (_numbers(table["code"])[row][:, None] * (x.max() + 1) + x) * (y.max() + 1) + y
        vertex = np.unique(vertex, return_inverse=True)[1].reshape(-1, 2)
        name = vertex[:, 0] * (vertex.max() + 1) + vertex[:, 1]
        order = np.argsort(name, kind="stable")
        row, values, vertex, name = row[order], values[order], vertex[order], name[order]
        here = np.floor(values / tile) + 0.0 == np.column_stack([table[k].to_numpy()[row] for k in ("_tx", "_ty")] * 2)
        arrives = np.flatnonzero(here[:, 2] & here[:, 3])
        after = _follow(vertex, values, np.flatnonzero(here[:, 0] & here[:, 1]), arrives)[arrives]
        if not len(arrives):
            return
        found = np.minimum(np.searchsorted(name[arrives], name[after]), len(arrives) - 1)
        follow = np.where(name[arrives][found] == name[after], found, -1)
        yield _pieces(table["code"].combine_chunks().take(pa.array(row[arrives])), values[arrives], values[after], follow)

    def left(table: pa.Table) -> Iterator[pa.RecordBatch]:
        row, edges = edges_of(table)
        values, size = _values(edges), len(edges)
        ends = pa.array(np.arange(0, 2 * size + 1, 2), pa.int32())
        lines = [pa.ListArray.from_arrays(ends, pa.array(values[:, k::2].ravel())) for k in (0, 1)]
        code, tx, ty = (table[k].combine_chunks().take(pa.array(row)) for k in KEY)
        nulls = [pa.nulls(size, kinds.field(c).type) for c in ("head", "place", "n", "closed", "link")]
        yield pa.RecordBatch.from_arrays([code, *lines, *nulls, tx, ty], PIECE_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, hot = [], 0, None
        for part in (b.slice(i, 16) for b in batches for i in range(0, b.num_rows, 16)):
            if hot is not None:
                other = [k != hot for k in zip(*(part[c].to_pylist() for c in KEY))]
                cut = other.index(True) if any(other) else len(other)
                yield from left(pa.Table.from_batches([part.slice(0, cut)]))
                part = part.slice(cut)
                hot = hot if not part.num_rows else None
            if part.num_rows:
                held.append(part)
                size += pc.sum(part["_n"]).as_py()
            if size < CHUNK:
                continue
            table = pa.Table.from_batches(held)
            last = int(_starts(*[_numbers(table[k]) for k in KEY])[-1])
            if last:
                yield from solve(table.slice(0, last))
                table = table.slice(last)
            held, size = table.to_batches(), pc.sum(table["_n"]).as_py()
            if size > HOT * CHUNK:
                hot = tuple(table[c][0].as_py() for c in KEY)
                yield from left(table)
                held, size = [], 0
        if held:
            yield from solve(pa.Table.from_batches(held))

    kind = packed.schema["code"].dataType.simpleString()
    point = pa.struct([(c, pa.float64()) for c in EDGE])
    kinds = pa.schema([
        ("head", point), ("place", pa.int64()), ("n", pa.int64()), ("closed", pa.bool_()),
        ("link", pa.struct([("next", point), ("id", point), ("steps", pa.int64())])),
    ])
    return packed.mapInArrow(run, f"code {kind}, {PIECE}")


def merged_edges(edges: DataFrame, code: str) -> DataFrame:
    """Edges left when the areas of a code are merged: an edge that two areas share is there once in each
    direction, and both go. Counts are combined before the shuffle, whose key is the edge itself."""
    forward = F.struct("x1", "y1") < F.struct("x2", "y2")

    def end(a: str, b: str) -> Column:
        return F.when(forward, F.col(a)).otherwise(F.col(b))

    net = (
        edges.where(F.struct("x1", "y1") != F.struct("x2", "y2"))
        .select(code, end("x1", "x2").alias("_xa"), end("y1", "y2").alias("_ya"), end("x2", "x1").alias("_xb"),
                end("y2", "y1").alias("_yb"), F.when(forward, 1).otherwise(-1).alias("_sign"))
        .groupBy(code, "_xa", "_ya", "_xb", "_yb").agg(F.sum("_sign").alias("_net"))
        .where("_net != 0")
    )
    twice = F.raise_error(F.lit(TWICE))
    ahead = F.when(F.abs("_net") > 1, twice.cast("boolean")).otherwise(F.col("_net") > 0)
    directed = net.select(code, "_xa", "_ya", "_xb", "_yb", ahead.alias("_ahead"))

    def back(a: str, b: str) -> Column:
        return F.when(F.col("_ahead"), F.col(a)).otherwise(F.col(b))

    return directed.select(
        code, back("_xa", "_xb").alias("x1"), back("_ya", "_yb").alias("y1"),
        back("_xb", "_xa").alias("x2"), back("_yb", "_ya").alias("y2"),
    )


def _followers(edges: DataFrame, code: str, tile: float) -> DataFrame:
    """`_follow` for tiles that no task holds: (code, id, next) of the edges that end in their tile. `code` is a
    structure of code and tile. Groups are the edges at one vertex."""
    me = F.struct(*EDGE)
    leave = edges.select(
        code, F.col("x1").alias("_x"), F.col("y1").alias("_y"), me.alias("id"), F.lit(True).alias("_out"),
        F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("_angle"),
    )
    arrive = edges.select(
        code, F.col("x2").alias("_x"), F.col("y2").alias("_y"), me.alias("id"), F.lit(False).alias("_out"),
        F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2")).alias("_angle"),
    )
    here = [F.floor(F.col(f"_{c}") / tile) == F.col(f"{code}._t{c}") for c in "xy"]
    around = Window.partitionBy(code, "_x", "_y").orderBy("_angle", "_out")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    end = F.struct("id", "_out")
    ends = leave.unionByName(arrive).where(F.coalesce(here[0] & here[1], F.lit(True)))
    before = ends.withColumn("_before", F.coalesce(F.lag(end).over(around), F.last(end).over(whole)))
    broken = F.raise_error(F.lit(BROKEN)).cast(leave.schema["id"].dataType)
    return before.where("NOT _out").select(
        F.col(f"{code}.code").alias("code"), "id", F.when(F.col("_before._out"), F.col("_before.id")).otherwise(broken).alias("next")
    )


def _chains(edges: DataFrame, tile: float) -> DataFrame:
    """Chains (see `_pieces`) of the edges of `_followers`: what a task finds by going from edge to edge among the
    edges it holds, up to `CHUNK` of neighbouring tiles."""
    at = [F.floor(F.col(f"id.{c}") / tile) for c in ("x1", "y1")]
    near = edges.select(
        "code", *[F.col(f"id.{c}").alias(c) for c in EDGE], *[F.col(f"next.{c}").alias(f"n_{c}") for c in EDGE],
        F.xxhash64("code", "id").alias("_me"), F.xxhash64("code", "next").alias("_to"), at[0].alias("_tx"), at[1].alias("_ty"),
    ).repartition(*KEY).sortWithinPartitions(*KEY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _batched(batches, CHUNK):
            mine, after = (np.column_stack([table[f"{p}{c}"].to_numpy() for c in EDGE]) for p in ("", "n_"))
            group, me, to = _numbers(table["code"]), table["_me"].to_numpy(), table["_to"].to_numpy()
            by_rank = np.lexsort((*mine.T[::-1], group))
            mine, after, group, me, to = (c[by_rank] for c in (mine, after, group, me, to))
            order = np.argsort(me, kind="stable")
            found = order[np.minimum(np.searchsorted(me, to, sorter=order), len(me) - 1)]
            # equal hashes are compared in full; an edge not found here is only left to the loop
            here = (group[found] == group) & (mine[found] == after).all(axis=1)
            yield _pieces(table["code"].combine_chunks().take(pa.array(by_rank)), mine, after, np.where(here, found, -1))

    return near.mapInArrow(run, f"code {edges.schema['code'].dataType.simpleString()}, {PIECE}")


def _unfolded(pieces: DataFrame, *columns: str) -> DataFrame:
    """One row per edge of the pieces, `_k` from 0."""
    corners = pieces.select(*columns, *[
        F.slice(f"{c[0]}s", int(c[1]), F.size("xs") - 1).alias(c) for c in EDGE
    ])
    edges = corners.select(*columns, F.posexplode(F.arrays_zip(*EDGE)).alias("_k", "_e"))
    return edges.select(*columns, "_k", "_e.*")


def outlines(edges: DataFrame, code: str, tile: float = 256.0) -> DataFrame:
    """Closed rings of the merged areas of each code: the merged edges with `ring` (the first edge of the
    ring, by coordinates), `position` in it from 0, and `n_edges`.

    Areas of a code may share edges, but not overlap (cells never do), and shared borders have the same
    vertices on both sides. Areas that touch in one vertex are rings of their own; a hole that touches its
    outline in one vertex is part of the outline's ring. Edges of length 0 are left out, an empty table
    gives an empty one, rows with a null coordinate are refused as open ends.

    Rings are found in two levels. Edges are shuffled once, packed, to the tiles of side `tile` (any side gives the same
    rings) of their ends; there they cancel, are chained, and the rings that lie in them are closed. Tiles with too many
    edges for a task go the long way, by aggregates and windows whose keys are edges and vertices. Only open
    chains go on, by pointer doubling: each knows the least edge of the next 2^k chains and the steps to it, and the
    chain after them. So the rounds are the logarithm of the chains of the longest ring, each is one join on chains,
    and no ring is ever in one task."""
    found = cut_lineage(_tile_chains(_packed_edges(edges, code, tile), tile))
    hot = found.where("closed IS NULL")
    chained = found.where("closed IS NOT NULL")
    if not hot.isEmpty():
        ends = [F.col(f"{c[0]}s")[int(c[1]) - 1].alias(c) for c in EDGE]
        left = merged_edges(hot.select(F.struct(*KEY).alias("_at"), *ends), "_at")
        chained = chained.unionByName(cut_lineage(_chains(_followers(left, "_at", tile), tile)))
    links = chained.where("link IS NOT NULL")
    rows = links.select(
        F.struct("code", F.col("head").alias("id")).alias("key"), F.struct("code", F.col("link.next").alias("id")).alias("next"),
        F.struct("link.id", "link.steps").alias("lead"), F.col("n").alias("span"), "n",
    )
    if not links.isEmpty():
        rows = cut_lineage(rows)
        while True:
            ahead = rows.select(
                F.col("key").alias("next"), F.col("next").alias("_next"), F.col("lead").alias("_lead"), F.col("span").alias("_span")
            )
            later = F.struct(F.col("_lead.id").alias("id"), (F.col("_lead.steps") + F.col("span")).alias("steps"))
            rows = cut_lineage(
                rows.join(ahead, "next").select(
                    "key", F.col("_next").alias("next"), F.least("lead", later).alias("lead"),
                    (F.col("span") + F.col("_span")).alias("span"), "n", (F.col("_lead.id") < F.col("lead.id")).alias("moved"),
                )
            )
            if rows.where("moved").isEmpty():
                break
    rows = rows.select(F.struct("key.code", "lead.id").alias("whole"), "key", "lead.steps", "n")
    length = rows.groupBy("whole").agg(F.sum("n").alias("n_edges"))
    parts = rows.join(length, "whole").select(
        "key", F.col("whole.id").alias("ring"), "steps", "n_edges"
    )
    wide = chained.where("NOT closed").withColumn("key", F.struct("code", F.col("head").alias("id"))).join(parts, "key")
    wide = wide.withColumn("first", F.col("n_edges") - F.col("steps") + F.col("place"))
    whole = chained.where("closed").select("code", F.col("head").alias("ring"), F.col("place").alias("first"), F.col("n").alias("n_edges"), "xs", "ys")
    return whole.unionByName(wide.select(whole.columns)).transform(_unfolded, "code", "ring", "first", "n_edges").select(
        F.col("code").alias(code), "ring", ((F.col("first") + F.col("_k")) % F.col("n_edges")).alias("position"), "n_edges", *EDGE
    )


def ring_areas(rings: DataFrame, code: str) -> DataFrame:
    """One row per ring: number of edges, perimeter, `surface` (negative for a hole) and `hole`. Coordinates are
    taken from the start of the ring, so far away rings lose no digits."""
    x1, y1, x2, y2 = (F.col(c) - F.col(f"ring.{'x1' if c[0] == 'x' else 'y1'}") for c in EDGE)
    return rings.groupBy(code, "ring").agg(
        F.count("*").alias("n_edges"), F.sum(F.hypot(x2 - x1, y2 - y1)).alias("perimetre"),
        (F.sum(x1 * y2 - x2 * y1) / 2).alias("surface"),
    ).withColumn("hole", F.col("surface") < 0)
