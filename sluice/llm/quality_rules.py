"""Quality rules: counts of a text, and decision lists learned from labelled rows.

Sequential covering: a rule is grown one threshold at a time by information gain on two thirds of
the labelled rows, cut back on the other third, and kept if it is right there often enough; the
rows it covers are taken out and the next rule is grown. The list is an ordered conditional
expression of Spark. Only counts by (feature, bin) reach the driver: some hundred rows a step.
Everything is DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.session import cut_lineage

SPACE = r"[\x20\x09-\x0D]"
NO_SPACE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
FEATURES = (
    "n_words", "word_length", "symbol_share", "dup_line_share", "repeat_share",
    "distinct_share", "mark_share", "capital_share", "line_length",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, width: int = WINDOW) -> Column:
    """Words inside a window of `width` words that occurs twice or more. Equal windows have equal
    hashes, so a text whose hashes all differ has none; the others compare the windows themselves."""
    places = F.sequence(F.lit(1), F.size(words) - (width - 1))
    hashes = F.transform(places, lambda i: F.xxhash64(F.slice(words, i, width)))
    differ = let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h))
    windows = F.transform(
        places, lambda i: F.struct(F.array_join(F.slice(words, i, width), " ").alias("w"), i.alias("i"))
    )

    def twice(s: Column) -> Column:
        same = F.transform(
            s,
            lambda x, j: F.when(
                (F.get(s, j - 1)["w"] == x["w"]) | (F.get(s, j + 1)["w"] == x["w"]), x["i"]
            ),
        )
        return F.array_sort(F.filter(same, lambda i: i.isNotNull()))

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda i, j: F.coalesce(F.least(F.get(at, j + 1) - i, F.lit(width)), F.lit(width))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    slow = let(F.array_sort(windows), lambda s: let(twice(s), covered))
    few = F.size(words) < width
    return F.when(few, F.lit(0).cast("long")).when(differ, F.lit(0).cast("long")).otherwise(slow)


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` with _words and the counts of each text: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, and the features of the rules. A null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    words = F.array_remove(F.split(text, SPACE + "+"), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NO_SPACE))
    marks = F.length(text) - F.length(F.regexp_replace(text, "[!?]", ""))
    capitals = F.length(text) - F.length(F.regexp_replace(text, r"\p{Lu}", ""))
    counted = docs.withColumns({"_words": words, "_lines": lines}).withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")),
            "_n_lines": F.size("_lines"),
            "_distinct": F.size(F.array_distinct("_words")),
            "_marks": marks,
            "_capitals": capitals,
        }
    )

    def share(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))

    few = F.col("n_words") < 20
    return counted.withColumns(
        {
            "base_failed": few | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
            "word_length": share("word_chars", "n_words"),
            "symbol_share": share("n_symbols", "n_words"),
            "dup_line_share": share("n_dup_lines", "_n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "distinct_share": share("_distinct", "n_words"),
            "mark_share": share("_marks", "n_words"),
            "capital_share": share("_capitals", "word_chars"),
            "line_length": share("n_words", "_n_lines"),
        }
    ).drop("_words", "_lines", "_n_lines", "_distinct", "_marks", "_capitals")


# --- decision lists ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Test:
    """feature > threshold, or feature <= threshold."""

    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.threshold if self.above else value <= self.threshold


@dataclass(frozen=True)
class Limits:
    rules: int = 8
    tests: int = 3
    bins: int = 64
    right: float = 0.95  # share of covered rows of the pruning part that are low
    covered: int = 4  # low rows of the pruning part that a rule covers at least


def _all(tests: Sequence[Test]) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t.column()
    return out


def covered(rules: Sequence[Sequence[Test]]) -> Column:
    """The list as an ordered conditional expression: true where a rule fires."""
    out = None
    for rule in rules:
        out = F.when(_all(rule), True) if out is None else out.when(_all(rule), True)
    return F.lit(False) if out is None else out.otherwise(False)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _best_test(rows: DataFrame, cuts: dict[str, list[float]]) -> tuple[Test, float] | None:
    """The test of the largest gain for rows with `low`, from counts by (feature, bin)."""
    def bin_of(feature: str) -> Column:
        below = F.filter(F.array(*[F.lit(c) for c in cuts[feature]]), lambda c: F.col(feature) > c)
        return F.struct(F.lit(feature).alias("feature"), F.size(below).alias("bin"))

    bins = [bin_of(f) for f, cs in cuts.items() if cs]
    if not bins:
        return None
    counts = rows.select("low", F.explode(F.array(*bins)).alias("b")).groupBy("b.feature", "b.bin").agg(
        F.count_if("low").alias("p"), F.count_if(~F.col("low")).alias("n")
    )
    table: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counts.collect():
        table.setdefault(r.feature, {})[r.bin] = (r.p, r.n)
    best = None
    for feature in sorted(table):
        held = table[feature]
        p0, n0 = (sum(v[i] for v in held.values()) for i in (0, 1))
        p = n = 0
        for b, cut in enumerate(cuts[feature]):  # rows of bins 0..b are <= the cut
            p, n = p + held.get(b, (0, 0))[0], n + held.get(b, (0, 0))[1]
            for above, x, y in ((False, p, n), (True, p0 - p, n0 - n)):
                if x and x + y < p0 + n0:
                    gain = _gain(x, y, p0, n0)
                    if gain > 1e-9 and (best is None or gain > best[1] + 1e-9):
                        best = (Test(feature, above, cut), gain)
    return best


def learn_rules(rows: DataFrame, features: Sequence[str] = FEATURES, limits: Limits = Limits()) -> list[list[Test]]:
    """Rules for the rows with `low` (boolean). `rows` also has `id`, whose hash deals rows out to
    growing and pruning, and the features."""
    share = [i / limits.bins for i in range(1, limits.bins)]
    asked = rows.agg(*[F.percentile_approx(f, share, 10_000).alias(f) for f in features]).first()
    cuts = {f: sorted(set(asked[f] or [])) for f in features}
    rows = cut_lineage(rows.select("low", *features, (F.pmod(F.xxhash64("id"), F.lit(3)) > 0).alias("grow")))
    rules: list[list[Test]] = []
    while len(rules) < limits.rules:
        left = rows.where(~covered(rules))
        rule: list[Test] = []
        while len(rule) < limits.tests:
            found = _best_test(left.where(F.col("grow") & _all(rule)), cuts)
            if found is None:
                break
            rule.append(found[0])
        if not rule:
            break
        heads = [rule[: k + 1] for k in range(len(rule))]
        seen = left.where(~F.col("grow")).agg(
            *[F.count_if(_all(h) & F.col("low")).alias(f"p{k}") for k, h in enumerate(heads)],
            *[F.count_if(_all(h) & ~F.col("low")).alias(f"n{k}") for k, h in enumerate(heads)],
        ).first()
        scored = [((seen[f"p{k}"] - seen[f"n{k}"]) / max(1, seen[f"p{k}"] + seen[f"n{k}"]), -k) for k in range(len(heads))]
        k = -max(scored)[1]
        p, n = seen[f"p{k}"], seen[f"n{k}"]
        if p < limits.covered or p < limits.right * (p + n):
            break
        rules.append(heads[k])
    return rules


def learned_from(counted: DataFrame, labels: DataFrame, id_col: str = "doc_id", limits: Limits = Limits()) -> list[list[Test]]:
    """Rules from the labelled rows of `counted` that the base rules let pass. Low is a quality of 0;
    of several labels of an id the lowest counts, null labels and ids without a label do not."""
    known = labels.where(F.col("quality").isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min("quality").alias("q"))
    rows = counted.where(~F.col("base_failed")).select(F.col(id_col).alias("id"), *FEATURES).join(known, "id")
    return learn_rules(rows.withColumn("low", F.col("q") == 0), limits=limits)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts, base_failed, kept) for every row of `docs`: kept unless the base rules or a
    learned rule reject the text. A null or empty text has counts of 0 and fails. Repeated rows and
    null ids are judged like others; only ids with a label are learned from, and with no low labels
    there are no learned rules."""
    counted = with_counts(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).drop("text")
    counted = cut_lineage(counted.withColumnRenamed("id", id_col))
    rules = learned_from(counted, labels, id_col)
    kept = ~F.col("base_failed") & ~covered(rules)
    return counted.select(id_col, *COUNTS, "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are kept, with their columns. Rows are written with their counts
    first: a filter on counts that are still expressions would compute them for every mention."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    counted = with_counts(docs.select(row, F.col(id_col).alias("id"), F.col(text_col).alias("text"))).drop("text")
    counted = cut_lineage(counted)
    rules = learned_from(counted.withColumnRenamed("id", id_col), labels, id_col)
    kept = counted.where(~F.col("base_failed") & ~covered(rules)).select("_row")
    return kept.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
