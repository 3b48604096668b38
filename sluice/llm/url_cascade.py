"""Exact URL lists as cascades of Bloom filters.

Level 1 encodes the listed keys. Of all keys that occur in the corpus (the universe), those that
level 1 lets through by mistake are encoded in level 2, the listed keys that level 2 lets through
in level 3, and so on until a level makes no mistake. For a key of the universe the first level
that refuses it tells whether it is listed, with no join and no key kept.

Keys of every level stay in Spark: a level is the OR of bit words that are merged before and after
a shuffle. The driver and the workers hold the bits, a few for each listed key, whose number is
checked against a limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType

from sluice.llm.words import mix
from sluice.session import cut_lineage

BITS_PER_KEY = 10
HASHES = 5
LIMIT_BITS = 1 << 33  # a gigabyte for a level

# What a cascade sees of a key: two 64-bit hashes.


def key_hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(key, F.lit("second"))


def _positions(a: np.ndarray, b: np.ndarray, level: int, bits: int) -> np.ndarray:
    """HASHES bit positions for each key, other ones at every level."""
    salt = np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x, y = mix(a ^ salt), mix(b + salt) | np.uint64(1)
    return np.stack([(x + np.uint64(i) * y) % np.uint64(bits) for i in range(HASHES)])


@dataclass
class Level:
    bits: int
    words: np.ndarray

    def lets_through(self, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
        at = _positions(a, b, level, self.bits)
        one = (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
        return one.all(axis=0)


class Cascade:
    """Levels of a list over a universe; `listed(a, b)` for arrays of key hashes."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        out = np.zeros(len(a), bool)
        open_ = np.arange(len(a))
        for i, level in enumerate(self.levels):
            passed = level.lets_through(a[open_], b[open_], i)
            out[open_[~passed]] = i % 2 == 1  # refused by an even level: a mistake of the one before
            open_ = open_[passed]
        out[open_] = len(self.levels) % 2 == 1
        return out


def _encode(keys: DataFrame, number: int, level: int) -> Level:
    bits = max(64, -(-number * BITS_PER_KEY // 64) * 64)
    if bits > LIMIT_BITS:
        raise ValueError(f"a level of {bits} bits is over the limit of {LIMIT_BITS}; split the list")

    def words(batches):
        for rows in batches:
            a, b = rows["a"].to_numpy().view(np.uint64), rows["b"].to_numpy().view(np.uint64)
            at = np.unique(_positions(a, b, level, bits).ravel())
            word = (at >> np.uint64(6)).astype(np.int64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            one = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
            yield pd.DataFrame({"word": word[first], "value": one.view(np.int64)})

    merged = keys.mapInPandas(words, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value"))
    table = np.zeros(bits // 64, np.uint64)
    # a part of the bits at a time: 2^26 bits are a million rows
    for r in merged.coalesce(1 + (bits >> 26)).toLocalIterator():
        table[r.word] = np.int64(r.value).view(np.uint64)
    return Level(bits, table)


def _passes(level: Level, i: int):
    @F.pandas_udf(BooleanType())
    def passes(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(level.lets_through(a.to_numpy().view(np.uint64), b.to_numpy().view(np.uint64), i))

    return passes


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade of the keys of `listed` over those of `universe` (one string column each, any
    repeats; nulls are left out). Exact for every key of either."""

    def hashes(df: DataFrame) -> DataFrame:
        key = F.col(df.columns[0])
        a, b = key_hashes(key)
        return df.where(key.isNotNull()).select(a.alias("a"), b.alias("b"))

    yes = cut_lineage(hashes(listed))
    no = cut_lineage(hashes(universe).join(yes, ["a", "b"], "left_anti"))
    levels, sides = [], [yes, no]
    number = yes.count()
    while number:
        i = len(levels)
        levels.append(_encode(sides[i % 2], number, i))
        other = (i + 1) % 2
        sides[other] = cut_lineage(sides[other].where(_passes(levels[-1], i)("a", "b")))
        number = sides[other].count()
    return Cascade(levels)


# --- URLs ------------------------------------------------------------------------------------


def url_host(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(rest, upper, lower), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and its parent domains, longest first."""
    parts = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), ".")
    )


def rule_keys(host: Column, path: Column) -> Column:
    """Every host suffix with every start of the path that ends in a slash, longest first. Rules
    that end in a slash and fit the URL are among them."""
    steps = F.split(path, "/")
    starts = F.when(
        F.startswith(path, F.lit("/")),
        F.transform(
            F.sequence(F.lit(2), F.size(steps)),
            lambda i: F.concat(F.array_join(F.slice(steps, 1, i - 1), "/"), F.lit("/")),
        ),
    ).otherwise(F.array().cast("array<string>"))
    every = F.flatten(
        F.transform(host_suffixes(host), lambda h: F.transform(starts, lambda p: F.concat(h, p)))
    )
    longest = F.array_sort(F.transform(every, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("k"))))
    return F.when(host != "", F.transform(longest, lambda s: s["k"])).otherwise(F.array().cast("array<string>"))


def first_listed(spark: SparkSession, cascades: Sequence[Cascade], keys: str) -> list[Column]:
    """For each cascade, position from 1 of the first listed key of an array column, or 0."""
    held = [spark.sparkContext.broadcast(c) for c in cascades]
    a = F.transform(keys, lambda k: key_hashes(k)[0])
    b = F.transform(keys, lambda k: key_hashes(k)[1])

    def of(cascade) -> Column:
        @F.pandas_udf(IntegerType())
        def place(a: pd.Series, b: pd.Series) -> pd.Series:
            size = np.array([len(x) for x in a], np.int64)
            out = np.zeros(len(size), np.int32)
            if size.sum():
                one, two = (np.concatenate(list(s)).astype(np.int64).view(np.uint64) for s in (a, b))
                row = np.repeat(np.arange(len(size)), size)
                at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                hit = np.flatnonzero(cascade.value.listed(one, two))
                rows, first = np.unique(row[hit], return_index=True)
                out[rows] = at[hit[first]] + 1
            return pd.Series(out)

        return place(a, b)

    return [of(c) for c in held]


def site_hosts(pages: DataFrame, sites: Sequence[str], url_col: str = "url") -> DataFrame:
    """(key): the domains of the table, hosts or their parents, that begin with a label in `sites`,
    whatever follows it; so their subdomains are listed too. Labels are compared whole."""
    keys = pages.select(F.explode(host_suffixes(url_host(F.col(url_col)))).alias("key"))
    label = F.substring_index("key", ".", 1)
    return keys.where(label.isin(*[s.lower() for s in sites])).distinct()


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]], blocked: DataFrame | Sequence[str] = (),
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row. `rules` are (allow or block, host/path/); the
    longest one that fits decides. Where none fits the verdict is block if the host or a parent
    domain is in `blocked`, else allow. Every list is a cascade over all keys of the table. Urls
    that are null or have no :// have an empty host and path, no rule, and are allowed."""
    spark = pages.sparkSession
    for action, key in rules:
        if action not in ("allow", "block") or not key.endswith("/"):
            raise ValueError(f"a rule is allow or block and ends in a slash: {action} {key}")
    url = F.col(url_col)
    judged = pages.select(F.col(id_col), url_host(url).alias("host"), url_path(url).alias("path")).withColumns(
        {"_keys": rule_keys(F.col("host"), F.col("path")), "_domains": host_suffixes(F.col("host"))}
    )
    # one universe: rules end in a slash, domains do not
    keys = cut_lineage(judged.select(F.explode(F.concat("_keys", "_domains")).alias("key")).distinct())
    lists = {
        action: spark.createDataFrame([(k,) for a, k in rules if a == action], "key string")
        for action in ("allow", "block")
    }
    if not isinstance(blocked, DataFrame):
        blocked = spark.createDataFrame([(h,) for h in blocked], "key string")
    allow, block = (build_cascade(lists[a], keys) for a in ("allow", "block"))
    allowed, barred = first_listed(spark, [allow, block], "_keys")
    (listed,) = first_listed(spark, [build_cascade(blocked, keys)], "_domains")
    judged = judged.withColumns({"_allow": allowed, "_block": barred, "_listed": listed})
    place = F.when(F.col("_allow") == 0, F.col("_block")).when(F.col("_block") == 0, F.col("_allow")).otherwise(
        F.least("_allow", "_block")
    )
    judged = judged.withColumn("_place", place)
    verdict = (
        F.when((F.col("_place") > 0) & (F.col("_place") == F.col("_allow")), "allow")
        .when(F.col("_place") > 0, "block").when(F.col("_listed") > 0, "block").otherwise("allow")
    )
    rule = F.when(F.col("_place") > 0, F.try_element_at("_keys", F.col("_place")))
    return judged.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("verdict"))
