"""Benchmark decontamination: item-sized windows of documents against benchmark items.

A window of as many words as the item is laid over a document wherever the two have a run of five
words in common (a window without one has similarity 0). Windows and items get a SimHash of their
weighted five-word shingles. Fingerprints are cut into one block more than the radius, so any two
within the radius agree in a block; those that meet in a block and are within the radius are verified by
the exact weighted Jaccard similarity of their shingles. A shingle weighs the characters of its
words, times its occurrences. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.columns import free_name
from sluice.llm.quality_rules import let
from sluice.session import cut_lineage

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 24  # of 64 bits; a weighted similarity of 0.8 differs in about 10, with a deviation of 3
BITS = 64
BROADCAST_ROWS = 1_000_000  # runs of the benchmark that are sent to every executor; more are joined by a shuffle


def plain_words(text: Column) -> Column:
    """Words of letters and digits, lower-cased; none for a null text."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def runs(words: Column, n: Column | int) -> Column:
    """Hashes of all runs of n words; none if there are fewer."""
    n = F.lit(n) if isinstance(n, int) else n
    places = F.sequence(F.lit(1), F.size(words) - n + 1)
    return F.when(F.size(words) >= n, F.transform(places, lambda i: F.xxhash64(F.slice(words, i, n)))).otherwise(
        F.array().cast("array<long>")
    )


def shingles(words: Column, n: Column) -> Column:
    """Runs of n words as texts."""
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, n), " ")
    )


def simhash(texts: Column) -> Column:
    """64-bit fingerprint: each bit is that of most of the weight of the shingles."""
    none = F.array_repeat(F.lit(0).cast("long"), BITS)

    def add(sums: Column, s: Column) -> Column:
        return let(
            F.struct(F.xxhash64(s).alias("h"), F.length(s).cast("long").alias("w")),
            lambda v: F.transform(
                sums,
                lambda x, b: x + F.when(F.getbit(v["h"], b) == 1, v["w"]).otherwise(-v["w"]),
            ),
        )

    def bit(print_: Column, x: Column) -> Column:
        return F.shiftleft(print_, 1).bitwiseOR(F.when(x > 0, 1).otherwise(0).cast("long"))

    return F.aggregate(F.aggregate(texts, none, add), F.lit(0).cast("long"), bit)


def blocks(print_: Column, radius: int = RADIUS) -> Column:
    """(block, bits) of the radius + 1 blocks of a fingerprint."""
    borders = [BITS * i // (radius + 1) for i in range(radius + 2)]
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(print_, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("bits"),
            )
            for i, (a, b) in enumerate(zip(borders, borders[1:]))
        ]
    )


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of shingles with repeats."""

    def weight(s: Column) -> Column:
        return F.aggregate(s, F.lit(0).cast("long"), lambda t, x: t + F.length(x))

    def times(s: Column, x: Column) -> Column:
        return F.size(F.filter(s, lambda y: y == x))

    shared = F.aggregate(
        F.array_intersect(a, b), F.lit(0).cast("long"),
        lambda t, x: t + F.least(times(a, x), times(b, x)) * F.length(x),
    )
    return let(shared, lambda s: s / (weight(a) + weight(b) - s))


def benchmark_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY, radius: int = RADIUS,
) -> DataFrame:
    """(id, item, start, n_words, distance, similarity) of every document and item with a window of
    similarity `similarity` or more: the best window, the first of equal ones. Items of fewer than
    five words are one shingle; items without words, and null or empty texts, match nothing. Equal
    items are all reported. Repeated rows of a document are one document."""
    words = plain_words(F.col(item_text))
    known = items.select(F.col(item_col).alias("item"), words.alias("words")).where(F.size("words") > 0)
    known = cut_lineage(known.withColumn("n", F.least(F.size("words"), F.lit(SHINGLE))).distinct())
    at = known.select("item", "n", F.size("words").alias("long"), F.posexplode(runs(F.col("words"), F.col("n"))))
    at = at.select("item", "n", "long", F.col("pos").alias("place"), F.col("col").alias("run"))
    sizes = [r.n for r in known.select("n").distinct().collect()]  # 1 to 5
    small = at.count() <= BROADCAST_ROWS

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    worded = texts.select("id", plain_words(F.col("text")).alias("words"))
    none = texts.limit(0).select("id", F.lit(0).alias("n"), F.lit(0).alias("pos"), F.lit(0).cast("long").alias("run"))
    for n in sizes:
        found = worded.select("id", F.posexplode(runs(F.col("words"), n)))
        none = none.unionByName(found.select("id", F.lit(n).alias("n"), "pos", F.col("col").alias("run")))
    hits = none.join(F.broadcast(at) if small else at, ["n", "run"])
    starts = cut_lineage(hits.select("id", "item", (F.col("pos") - F.col("place")).alias("start")).distinct())

    near = starts.groupBy("id").agg(F.lit(1).alias("one")).withColumnRenamed("id", "_id")
    near = worded.join(near, F.col("id").eqNullSafe(F.col("_id"))).select("id", "words").distinct()
    laid = starts.withColumnRenamed("id", "_id").join(near, F.col("_id").eqNullSafe(F.col("id"))).drop("_id")
    prints = known.select(
        "item", "n", F.size("words").alias("long"), shingles(F.col("words"), F.col("n")).alias("theirs")
    ).withColumn("their_print", simhash(F.col("theirs")))
    light = prints.select("item", "n", "long")
    laid = laid.join(light, "item")
    start = F.greatest(F.lit(0), F.least(F.col("start"), F.size("words") - F.col("long")))
    laid = laid.select("id", "item", "n", start.alias("start"), F.slice("words", start + 1, F.col("long")).alias("window"))
    windows = laid.distinct().select("id", "item", "start", shingles(F.col("window"), F.col("n")).alias("ours"))
    windows = windows.withColumn("our_print", simhash(F.col("ours")))
    ours = windows.select("*", F.explode(blocks(F.col("our_print"), radius)).alias("b"))
    theirs = prints.select("item", "theirs", "their_print", F.explode(blocks(F.col("their_print"), radius)).alias("b"))
    distance = F.bit_count(F.col("our_print").bitwiseXOR(F.col("their_print")))
    met = (
        ours.select("*", "b.block", "b.bits").drop("b")
        .join(theirs.select("*", "b.block", "b.bits").drop("b"), ["item", "block", "bits"])
        .where(distance <= radius)
        .select("id", "item", "start", "ours", "theirs", distance.alias("distance")).distinct()
    )
    scored = met.withColumn("similarity", weighted_jaccard(F.col("ours"), F.col("theirs")))
    best = F.min(F.struct((-F.col("similarity")).alias("s"), "start", "distance")).alias("best")
    return (
        scored.where(F.col("similarity") >= similarity).groupBy("id", "item").agg(best)
        .join(light.groupBy("item").agg(F.max("long").alias("long")), "item")
        .select(
            F.col("id").alias(id_col), F.col("item").alias(item_col), F.col("best.start").alias("start"),
            F.col("long").cast("long").alias("n_words"), F.col("best.distance").alias("distance"),
            (-F.col("best.s")).alias("similarity"),
        )
    )


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose document holds no window of an item; their columns as they are."""
    mark = free_name(docs, "leak")
    leaks = benchmark_leaks(docs, items, id_col, text_col).select(F.col(id_col).alias(mark)).distinct()
    return docs.join(leaks, F.col(id_col).eqNullSafe(F.col(mark)), "left_anti")
