"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import cut_lineage


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each node.

    `nodes` has `id`, `edges` has `a` and `b` (undirected, both ends among the nodes). Each round
    draws a new order of the ids (a hash of the id and the round). Every group takes the first of
    itself and its neighbours as parent, parents of parents are followed to the root, and the edges
    between roots are the input of the next round. A group with a neighbour stays a root with
    probability one half at most, whatever the shape, so the rounds grow with the logarithm of the
    number of nodes and the loop ends when no edge is left. Minima are combined before the shuffle,
    so a node with very many edges sends few rows. Only "is any row left" reaches the driver; every
    round is written out to cut the lineage."""
    both = edges.select("a", "b").unionByName(
        edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    live = cut_lineage(both.where(F.col("a") != F.col("b")).distinct())
    labels = nodes.select("id", F.col("id").alias("label")).distinct()
    turn = 0
    while not live.isEmpty():
        turn += 1
        parents = _roots(_first_neighbours(live, turn))
        at_a = parents.select(F.col("id").alias("a"), F.col("parent").alias("_a"))
        at_b = parents.select(F.col("id").alias("b"), F.col("parent").alias("_b"))
        live = cut_lineage(
            live.join(at_a, "a").join(at_b, "b").where(F.col("_a") != F.col("_b"))
            .select(F.col("_a").alias("a"), F.col("_b").alias("b")).distinct()
        )
        labels = labels.join(parents.withColumnRenamed("id", "label"), "label", "left").select(
            "id", F.coalesce("parent", "label").alias("label")
        )
    labels = cut_lineage(labels)
    least = labels.groupBy("label").agg(F.min("id").alias("component"))
    return labels.join(least, "label").select("id", "component")


def _first_neighbours(live: DataFrame, turn: int) -> DataFrame:
    """(id, parent): of each id and its neighbours, the first in the order of this turn."""

    def place(c: str) -> Column:
        return F.struct(F.xxhash64(F.lit(turn), c).alias("rank"), F.col(c).alias("id"))

    best = live.groupBy("a").agg(F.min(place("b")).alias("best"))
    return best.select(F.col("a").alias("id"), F.least("best", place("a"))["id"].alias("parent"))


def _roots(parents: DataFrame) -> DataFrame:
    """Parents of parents until every parent is a root; ranks fall along a chain, so it ends."""
    parents = cut_lineage(parents)
    while True:
        above = parents.select(F.col("id").alias("parent"), F.col("parent").alias("_up"))
        moved = cut_lineage(
            parents.join(above, "parent").select(
                "id", F.col("_up").alias("parent"), (F.col("_up") != F.col("parent")).alias("_moved")
            )
        )
        parents = moved.drop("_moved")
        if moved.where("_moved").isEmpty():
            return parents


def network_reach(
    segments: DataFrame,
    segment: str,
    node_a: str,
    node_b: str,
    start: str,
    allowed: dict[str, str],
    length: str,
    keep_segments: bool = False,
) -> DataFrame:
    """For each variant of `allowed` (name -> boolean column): segments linked to a start through
    allowed segments, their number and total length.

    All variants are solved in one component run: nodes carry the name of their variant."""
    variants = F.explode(
        F.filter(
            F.array(*[F.when(F.col(c), F.lit(n)) for n, c in allowed.items()]),
            lambda v: v.isNotNull(),
        )
    )
    usable = segments.select("*", variants.alias("variant"))
    a = F.concat_ws("|", "variant", F.col(node_a).cast("string"))
    b = F.concat_ws("|", "variant", F.col(node_b).cast("string"))
    edges = usable.select(a.alias("a"), b.alias("b"))
    nodes = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id")))
    parts = connected_components(nodes.distinct(), edges)
    tagged = usable.withColumn("_id", a).join(parts.withColumnRenamed("id", "_id"), "_id")
    started = tagged.where(F.col(start)).select("component").distinct()
    reached = tagged.join(started, "component", "left_semi")
    if keep_segments:
        return reached.select("variant", segment, length)
    return reached.groupBy("variant").agg(
        F.count("*").alias("n_segments"), F.sum(length).alias("total_length")
    )
