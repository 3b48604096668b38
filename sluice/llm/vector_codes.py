"""Product-quantised vectors: a codebook for each part of a vector, learned by exact integer rounds.

Every part of every vector keeps its entry and a lower bound on its distance to all other entries,
stamped with the round in which it was measured. The history of the codebooks is kept: in a later round
the bound is lowered by the true net displacement of the entries since its stamp, the norm of the sum of
their moves, which is never more than the sum of the norms. Where the distance to the own entry stays
below, the entry is still the nearest; only the other parts are scanned again, and stamped anew.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import cut_lineage

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = 1 << 20  # components up to here keep all squared distances exact in float64
ROWS = 8192  # vectors handled at once


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(kind) if len(column) else np.zeros((0, 0), kind)


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, v): vectors without null or non-finite components, as integers floor(scale * x)."""
    number = F.col("_v").cast("array<double>")
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("_v"))
        .withColumn("_v", number)
        .where(F.col("_v").isNotNull() & finite)
        .select("vec_id", "label", F.transform("_v", lambda x: F.floor(x * scale)).alias("v"))
    )


def _checked(v: np.ndarray, width: int) -> np.ndarray:
    if v.shape[1] != width:
        raise ValueError(f"vectors of {v.shape[1]} and of {width} components")
    if v.size and np.abs(v).max() > LIMIT:
        raise ValueError(f"a component beyond {LIMIT} in absolute value")
    return v


def all_distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of rows to entries: whole numbers below 2**53, exact in float64."""
    return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None, :]


def _others(values: np.ndarray) -> np.ndarray:
    """For each entry the largest value of the other entries."""
    if len(values) < 2:
        return np.zeros(len(values))
    top, next_top = np.argsort(values)[[-1, -2]]
    out = np.full(len(values), values[top])
    out[top] = values[next_top]
    return out


def assign_part(x, history, own, bound, stamp):
    """Nearest entry of each row of `x` in the latest codebook of one part, ties to the lower index, with
    its squared distance, the lower bound of the others and its stamp. `own` is None in the first round.
    The fifth value tells which rows were scanned."""
    now, entries = len(history) - 1, history[-1]
    n = len(x)
    if own is None:
        scan = np.ones(n, bool)
        own, bound, stamp = np.zeros(n, np.int64), np.zeros(n, np.float32), np.zeros(n, np.uint8)
        nearest = np.zeros(n)
    else:
        gap = x - entries[own]
        nearest = (gap * gap).sum(1)
        moved = np.stack([_others(np.sqrt(((entries - old) ** 2).sum(1))) for old in history])
        # a little is taken off, so that rounding never hides a nearer entry
        below = (bound.astype(np.float64) - moved[stamp, own]) * (1 - 1e-9) - 1e-6
        scan = np.sqrt(nearest) >= below
        own, bound, stamp = own.copy(), bound.copy(), stamp.copy()
    if scan.any():
        d = all_distances(x[scan], entries)
        best = d.argmin(1)
        rows = np.arange(len(best))
        own[scan], nearest[scan] = best, d[rows, best]
        d[rows, best] = np.inf
        second = np.minimum(d.min(1), np.finfo(np.float32).max / 4) if d.shape[1] > 1 else np.full(len(best), 1e30)
        bound[scan] = np.nextafter(np.sqrt(second).astype(np.float32), np.float32(0))
        stamp[scan] = now
    return own, nearest, bound, stamp, scan


STATE = "vec_id {id}, label {label}, v array<long>, codes binary, bounds binary, stamps binary, sums binary, scanned long"


def _bytes_of(a: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    raw = np.ascontiguousarray(a)
    size = raw.shape[1] * raw.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(raw), [None, pa.py_buffer(raw)]).cast(pa.binary())


def _rows_of(column: pa.Array, kind, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, parts)


def assign(rows: DataFrame, history: list[np.ndarray], first: bool, last: bool) -> DataFrame:
    """One round. `history` holds codebooks as arrays (part, entry, component). Gives the rows with their
    state, and from each task one more row with the sums and counts of its parts by entry (`sums`); the
    last round gives (vec_id, label, code, error) alone."""
    parts, size = history[0].shape[0], history[0].shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, history[0].shape[1], size + 1), np.int64)
        scanned, like = 0, None
        for big in batches:
            for low in range(0, big.num_rows, ROWS):
                batch = big.slice(low, ROWS)
                if "sums" in batch.schema.names:
                    batch = batch.filter(batch.column("sums").is_null())
                if not batch.num_rows:
                    continue
                like = batch.slice(0, 0)
                v = _checked(_matrix(batch.column("v"), np.float64), parts * size)
                if not first:
                    old = [_rows_of(batch.column(c), k, parts) for c, k in KINDS]
                codes, bounds, stamps = (np.zeros((len(v), parts), k) for _, k in KINDS)
                error = np.zeros(len(v))
                for p in range(parts):
                    x = v[:, p * size : (p + 1) * size]
                    state = (None, None, None) if first else (old[0][:, p].astype(np.int64), old[1][:, p], old[2][:, p])
                    own, near, bounds[:, p], stamps[:, p], scan = assign_part(x, [h[p] for h in history], *state)
                    codes[:, p] = own
                    error += near
                    scanned += int(scan.sum())
                    if not last:
                        np.add.at(total[p], own, np.column_stack([x, np.ones(len(x))]).astype(np.int64))
                head = [batch.column("vec_id"), batch.column("label")]
                if last:
                    text = pa.array([c.tobytes().hex() for c in codes], pa.string())
                    yield pa.RecordBatch.from_arrays([*head, text, pa.array(error.astype(np.int64))], names=CODED)
                else:
                    state = [_bytes_of(codes), _bytes_of(bounds), _bytes_of(stamps)]
                    empty = [pa.nulls(len(v), pa.binary()), pa.nulls(len(v), pa.int64())]
                    yield pa.RecordBatch.from_arrays([*head, batch.column("v"), *state, *empty], names=HELD)
        if like is not None and not last:
            none = [pa.nulls(1, like.column(c).type) for c in ("vec_id", "label", "v")] + [pa.nulls(1, pa.binary())] * 3
            sums = [pa.array([total.tobytes()], pa.binary()), pa.array([scanned], pa.int64())]
            yield pa.RecordBatch.from_arrays([*none, *sums], names=HELD)

    types = dict(rows.dtypes)
    schema = "vec_id {id}, label {label}, code string, error long" if last else STATE
    return rows.mapInArrow(run, schema.format(id=types["vec_id"], label=types["label"]))


KINDS = (("codes", np.uint8), ("bounds", np.float32), ("stamps", np.uint8))
HELD = ["vec_id", "label", "v", "codes", "bounds", "stamps", "sums", "scanned"]
CODED = ["vec_id", "label", "code", "error"]


def moved_codebook(state: DataFrame, codebook: np.ndarray) -> np.ndarray:
    """Each entry becomes the floor of the mean of its parts; an entry without any stays. The sums of the
    tasks, a codebook each, are first added up by part in Spark."""
    parts, entries, size = codebook.shape

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                one = np.frombuffer(raw, np.int64)
                total = one.copy() if total is None else total + one
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(total))), pa.array(total)], names=["at", "value"]
            )

    sums = state.where("sums IS NOT NULL").select("sums").mapInArrow(split, "at long, value long")
    rows = sums.groupBy("at").agg(F.sum("value").alias("value")).collect()  # as many as the codebook has numbers
    total = np.zeros(parts * entries * (size + 1), np.int64)
    for r in rows:
        total[r.at] = r.value
    total = total.reshape(parts, entries, size + 1)
    count = total[:, :, -1:]
    return np.where(count > 0, total[:, :, :-1] // np.maximum(count, 1), codebook.astype(np.int64)).astype(np.float64)


def codebooks_text(codebook: np.ndarray) -> str:
    return ",".join(str(int(x)) for x in codebook.reshape(-1))


def train_and_code(
    kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray | None, list[tuple[int, int]]]:
    """(vec_id, label, code, error) of every vector, the final codebook, and for each round the number of
    parts scanned and of all. `kept` has vec_id, label and v, and is a written table."""
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not start:
        types = dict(kept.dtypes)
        schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"
        return kept.sparkSession.createDataFrame([], schema), None, []
    first = np.array([r.v for r in start], np.float64)
    if first.shape[1] % parts or not first.shape[1]:
        raise ValueError(f"vectors of {first.shape[1]} components cannot be cut into {parts} equal parts")
    _checked(first, first.shape[1])
    history = [first.reshape(len(first), parts, -1).transpose(1, 0, 2)]
    rows, scans = kept, []
    for r in range(rounds):
        rows = cut_lineage(assign(rows, history, first=r == 0, last=False))
        seen = rows.where("sums IS NOT NULL").agg(F.sum("scanned").alias("n")).first().n
        scans.append((seen, parts * rows.where("sums IS NULL").count()))
        history.append(moved_codebook(rows, history[-1]))
    return assign(rows, history, first=rounds == 0, last=True), history[-1], scans


def vector_codes(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> DataFrame:
    """A row per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    Vectors that are null or hold a null, NaN or infinite component are dropped. The first codebook is
    that of the smallest ids (null last, repeated ids by vector; equal rows are rows of their own); with
    fewer vectors than entries it is that much smaller. No vectors give no rows. All vectors must have
    one length that `parts` divides and integer components up to 2**20 in absolute value, else
    ValueError. Null labels are one label. Other columns are not read."""
    kept = cut_lineage(whole_vectors(df, id_col, vector_col, label_col))
    coded, codebook, _ = train_and_code(kept, parts, entries, rounds)
    coded = cut_lineage(coded)
    text = "" if codebook is None else codebooks_text(codebook)
    # sums by label are written, so that the join sees their size: a small table is broadcast, a large one not
    labels = cut_lineage(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")))
    return coded.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("vec_id").alias(id_col), "code", "error", "label_error",
        F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"),
    )
