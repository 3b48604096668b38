"""Merkle manifest of a dataset: a root for all rows, one for each group, and a proof for every row.

The rows of a group are its leaves, in order. Level by level, runs of `FAN` consecutive nodes become
the hash of their hashes; the last node of a group is its subroot, and the subroots, ordered by group,
likewise give the root. In every level, lag and lead columns at fixed offsets, masked by a node's slot
in its run and by the length of the run, supply its siblings, and the first child of a run hashes the
parent. Proofs come down the same way: a parent stands before its children in their window.

Windows hold (group, block of runs), so a group that has a third of all rows is many windows. Levels
are written out: a sixteenth of the rows each.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import cut_lineage

FAN = 16
RUNS = 16  # runs to a window
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def field(value: Column) -> Column:
    """`-` for null, else the number of bytes, a colon and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def group_key(group: Column) -> Column:
    """Text that is never null and sorts like the group by its bytes, null first."""
    return F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group.cast("string")))


def positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """`df` with `idx`, the row's place in its `grp` by `order` from 0, and `n`, the rows of the group.

    Rows are dealt out by ranges and sorted there; the ranges are then counted. A group may lie in any
    number of ranges."""
    by = ["grp", *order]
    placed = cut_lineage(
        df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_range", F.shiftright("_at", 33))
    counts = cut_lineage(placed.groupBy("grp", "_range").agg(F.min("_at").alias("_min"), F.count("*").alias("_n")))
    before = Window.partitionBy("grp").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(
        "grp", "_range", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_min")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("grp")).alias("n"),
    )
    return (
        placed.join(shifts, ["grp", "_range"])
        .withColumn("idx", F.col("_at") + F.col("_shift"))
        .select(*df.columns, "idx", "n")
    )


def _slot() -> Column:
    return F.col("idx") % FAN


def _run_length() -> Column:
    return F.least(F.lit(FAN), F.col("n") - F.col("idx") + _slot())


def _in_block(df: DataFrame) -> DataFrame:
    return df.withColumn("_block", F.floor(F.col("idx") / (FAN * RUNS)))


def _left(window) -> Column:
    lags = [F.when(_slot() >= k, F.lag("h", k).over(window)) for k in range(FAN - 1, 0, -1)]
    return F.concat(*[F.coalesce(c, F.lit("")) for c in lags])


def _right(window) -> Column:
    leads = [F.when(_slot() + k < _run_length(), F.lead("h", k).over(window)) for k in range(1, FAN)]
    return F.concat(*[F.coalesce(c, F.lit("")) for c in leads])


def parents(nodes: DataFrame) -> DataFrame:
    """(grp, idx, n, h) of the level above nodes (grp, idx, n, h), of groups with several nodes."""
    window = Window.partitionBy("grp", "_block").orderBy("idx")
    return (
        _in_block(nodes.where("n > 1").select("grp", "idx", "n", "h"))
        .withColumn("_right", _right(window))
        .where(_slot() == 0)
        .select(
            "grp", F.floor(F.col("idx") / FAN).alias("idx"), F.ceil(F.col("n") / FAN).alias("n"),
            F.sha2(F.concat("h", "_right"), 256).alias("h"),
        )
    )


def tree(leaves: DataFrame) -> list[DataFrame]:
    """The levels of all groups, from the leaves on. A group ends where it has one node."""
    levels, most = [leaves], leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(cut_lineage(parents(levels[-1])))
        most = -(-most // FAN)
    return levels


def subroots(levels: Sequence[DataFrame]) -> DataFrame:
    last = [level.where("n = 1").select("grp", "h") for level in levels]
    return reduce(DataFrame.unionByName, last)


# `up` of a node: siblings from its own level to the top, left and right of the path, and the roots
UP = "struct<path: array<struct<l: string, r: string>>, subroot: string, root: string>"


def descend(levels: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """The leaves with their `up`; `tops` has (grp, up) for the single last node of each group."""
    above = None
    for level in reversed(levels):
        lone = level.where("n = 1").join(tops, "grp")
        if above is None:  # the highest level holds single nodes only
            found = lone
        else:
            window = Window.partitionBy("grp", "_block").orderBy("_place")
            seen = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            children = level.where("n > 1").withColumn("_place", F.col("idx") * 2 + 1)
            heads = above.select(
                "grp", (F.col("idx") * FAN).alias("idx"), (F.col("idx") * FAN * 2).alias("_place"), "up"
            )
            mixed = _in_block(children.unionByName(heads, allowMissingColumns=True))
            siblings = F.struct(_left(window).alias("l"), _right(window).alias("r"))
            inner = (
                mixed.withColumn("_own", siblings)
                .withColumn("_up", F.last("up", ignorenulls=True).over(seen))
                .where(F.col("_place") % 2 == 1)
                .withColumn("up", F.struct(
                    F.concat(F.array("_own"), "_up.path").alias("path"), F.col("_up.subroot").alias("subroot"),
                    F.col("_up.root").alias("root"),
                ))
            )
            found = inner.select(*level.columns, "up").unionByName(lone.select(*level.columns, "up"))
        above = found if level is levels[0] else cut_lineage(found.select("grp", "idx", "up"))
    return above


def proof_text(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda p: F.concat(p["l"], p["r"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["l"], h, p["r"]), 256))


def merkle_proofs(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """`leaves` has grp (text, never null) and h (the leaf), and is a written table; each row is returned
    with `up`: its siblings on the way to the root, its subroot and the root."""
    levels = tree(cut_lineage(positions(leaves, order)))
    # the subroots are the leaves of one more tree
    tops = subroots(levels).select(F.lit("").alias("grp"), F.col("grp").alias("name"), "h")
    above = tree(cut_lineage(positions(tops, ["name"])))
    summit = subroots(above).select("grp", F.struct(
        F.array().cast("array<struct<l: string, r: string>>").alias("path"), F.col("h").alias("subroot"), F.col("h").alias("root")
    ).alias("up"))
    named = descend(above, summit).select(
        F.col("name").alias("grp"),
        F.struct("up.path", F.col("h").alias("subroot"), "up.root").cast(UP).alias("up"),
    )
    return descend(levels, cut_lineage(named))


def dataset_manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    group_col: str = "source",
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    text_col: str = "text",
) -> DataFrame:
    """A row per document: id, leaf, subroot, root, proof_sha256, folded_root and verified.

    Leaves are ordered by id (null first), rows of one id by leaf; equal rows are leaves of their own.
    Null values are `-` in the leaf; a null group is a group. A lone leaf is its own subroot, and with
    a single group the subroot is the root; the proof is then the hash of nothing. A text of any length
    is hashed whole. An empty table gives no rows; other columns are not read. Where 5 divides the
    crc32 of the id (not null), `folded_root` is that of the row with its text's A-Z lower-cased."""
    ids = F.col(id_col)
    changed = [F.translate(text_col, _UPPER, _LOWER) if c == text_col else F.col(c) for c in columns]
    tampered = F.crc32(ids.cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        ids.alias("id"), group_key(F.col(group_col)).alias("grp"), leaf_hash([F.col(c) for c in columns]).alias("h"),
        F.when(tampered, leaf_hash(changed)).alias("other"), F.monotonically_increasing_id().alias("_tie"),
    )
    rows = merkle_proofs(cut_lineage(leaves), ["id", "h", "_tie"])
    return (
        rows.select(
            F.col("id").alias(id_col), F.col("h").alias("leaf"), "up.subroot", "up.root",
            F.sha2(proof_text(F.col("up.path")), 256).alias("proof_sha256"),
            folded(F.coalesce("other", "h"), F.col("up.path")).alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )
