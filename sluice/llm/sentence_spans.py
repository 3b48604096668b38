"""Removal of sentences that stand in repeated spans.

A text is cut into sentences (long ones into clauses of a fixed number of words). From each sentence
on, the shortest run of two sentences or more with a dozen words or more is a span, and so is the
shortest one that ends with it. Spans are hashed, and the first occurrence of each hash over all
documents is found by an aggregate that combines before the shuffle; sentences of every other
occurrence are removed.

Passages that begin anywhere in a long sentence, or whose full stops differ, are found by runs of
words: of every RUN runs of RUN words in a row, wherever sentences end, the one of the smallest hash
is kept, so that any passage of 2 * RUN - 1 words has the same ones in both places. Of what such runs
cover, words of long sentences are removed, and whole sentences where the cover goes on past them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.words import mix, word_hashes
from sluice.session import cut_lineage

SENTENCES = 2  # of a span at least
WORDS = 12  # of a span at least
LONG = 24  # a sentence of more words is cut
CLAUSE = 16  # into clauses of so many
RUN = 16  # words of a run that is looked up wherever it begins

HOT = 1000  # a hash on more than one in so many rows is hot
BATCH = 1_000_000  # characters of texts handled at once; a longer text is handled alone

# a line's end, or marks from the first of them on and white space: one scan, whatever their number
_END = re.compile(r"[.!?\n](?:(?<=\n)\s*|(?<![.!?][.!?])(?<=[.!?])[.!?]*+(?:[^\S\n]+|\n\s*))")
_WORD = re.compile(r"\S+")


def sentences(text: str) -> list[tuple[int, int, str]]:
    """(begin, end, words) of the sentences of a text, with the white space after them. Words are
    lower-cased and joined by spaces; nothing of the text is left out."""
    borders = [0, *(m.end() for m in _END.finditer(text))]
    if borders[-1] < len(text):
        borders.append(len(text))
    out = []
    for a, b in zip(borders, borders[1:]):
        words = text[a:b].lower().split()
        if len(words) <= LONG:
            out.append((a, b, words))
            continue
        begins = [m.start() + a for m in _WORD.finditer(text[a:b])]
        cut = [a, *begins[CLAUSE::CLAUSE], b]
        out += [(x, y, words[i : i + CLAUSE]) for i, (x, y) in zip(range(0, len(words), CLAUSE), zip(cut, cut[1:]))]
    return out


def _sizes(text: str) -> tuple[list[str], list[int]]:
    """Words of a text, and their number in each of its sentences, cut as by `sentences`."""
    low = text.lower()
    words, sizes, at = [], [], 0
    if len(low) != len(text):  # a letter whose lower case is longer: places differ
        for _, _, unit in sentences(text):
            words += unit
            sizes.append(len(unit))
        return words, sizes
    borders = [m.end() for m in _END.finditer(low)]
    if (borders[-1] if borders else 0) < len(low):
        borders.append(len(low))
    for end in borders:
        unit = low[at:end].split()
        at, n = end, len(unit)
        words += unit
        if n <= LONG:
            sizes.append(n)
        else:
            sizes += [CLAUSE] * (n // CLAUSE) + [n % CLAUSE] * (n % CLAUSE > 0)
    return words, sizes


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _run_hasher(x: np.ndarray):
    """A function of arrays i and j: hashes of the runs x[i:j], by sums of x times powers."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * _powers(_BASE, len(x)))])
    back = _powers(_BACK, len(x) + 1)
    return lambda i, j: mix((total[j] - total[i]) * back[i] + (j - i).astype(np.uint64) * np.uint64(_BASE))


def _word_numbers(words: list[str]) -> np.ndarray:
    step = 100_000  # words hashed at once
    parts = ["\n".join(words[k : k + step]).encode("utf-8", "surrogatepass") for k in range(0, len(words), step)]
    return np.concatenate([np.zeros(0, np.uint64), *(word_hashes([p])[0] for p in parts)])


def _spans(x: np.ndarray, sizes: np.ndarray, units: np.ndarray, ends_too: bool) -> tuple[np.ndarray, ...]:
    """(hashes, texts, first and last sentences) of the span from each sentence on, if its text is
    long enough; and of the spans that end with each, where they are others. `x` are the words of all
    texts, `sizes` those of each sentence, `units` the first sentence of each text and their total."""
    edge = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    digest = _run_hasher(_run_hasher(x)(edge[:-1], edge[1:]))
    text = np.repeat(np.arange(len(units) - 1), np.diff(units))
    i = np.arange(len(sizes))
    end = np.maximum(np.searchsorted(edge, edge[:-1] + WORDS), i + SENTENCES)  # i to end - 1 have the words
    found = (end <= units[text + 1]) & (sizes > 0)
    first, last = i[found], end[found] - 1
    if ends_too:
        # the last begin with the words
        begin = np.minimum(np.searchsorted(edge, edge[1:] - WORDS, side="right") - 1, i + 1 - SENTENCES)
        inside = (begin >= units[text]) & (sizes > 0)
        begin = np.maximum(begin, 0)
        inside &= (sizes[begin] > 0) & ~(found[begin] & (end[begin] == i + 1))
        first, last = np.concatenate([first, begin[inside]]), np.concatenate([last, i[inside]])
    own = text[first]
    return digest(first, last + 1).view(np.int64), own, first - units[own], last - units[own]


def _runs(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, texts, first words) of the runs that are looked up. The choice follows from the words
    alone, so a passage of 2 * RUN - 1 words has one in common wherever it stands, and the runs of a
    longer one leave no gap. `starts` are the first words of the texts in `x` and their total."""
    if len(x) < RUN:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    k = np.arange(len(x) - RUN + 1)
    h = _run_hasher(x)(k, k + RUN)
    least, width = k, 1  # the last place of the least hash in windows of `width` runs
    while width < RUN and len(least):
        step = min(width, RUN - width)
        a, b = least[:-step], least[step:]
        least, width = np.where(h[b] <= h[a], b, a), width + step
    w = np.arange(len(least))
    at = [np.unique(least[w + 2 * RUN - 1 <= starts[text[w] + 1]])]
    count = np.diff(starts) - RUN + 1
    for t in np.flatnonzero((count > 0) & (count < RUN)):
        mine = h[starts[t] : starts[t] + count[t]]
        at.append(starts[t : t + 1] + count[t] - 1 - np.argmin(mine[::-1]))
    at = np.concatenate(at)
    return h[at].view(np.int64), text[at], at - starts[text[at]]


def runs(units: list[tuple[int, int, list[str]]]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first words) of the runs of one text that are looked up."""
    x = _word_numbers([w for u in units for w in u[2]])
    h, _, first = _runs(x, np.array([0, len(x)]))
    return h, first


def _span_table(docs: DataFrame, anywhere: bool) -> DataFrame:
    """(hash, id, text_hash, first, last) of `docs` (id, text); for a run of words, the first word and,
    negated, the one after it. A row without hash has the number of a text's sentences in `first`."""
    kind = docs.schema["id"].dataType.simpleString()

    def table(batch: pa.RecordBatch, low: int, texts: list[str | None]) -> pa.RecordBatch:
        words, sizes, ends, tops = [], [], [], []
        for text in texts:
            if text:
                w, n = _sizes(text)
                words += w
                sizes += n
            ends.append(len(sizes))
            tops.append(len(words))
        x = _word_numbers(words)
        units = np.array([0, *ends])
        found = [(np.zeros(len(texts), np.int64), np.arange(len(texts)), np.diff(units), np.zeros(len(texts), np.int64))]
        found.append(_spans(x, np.array(sizes, np.int64), units, anywhere))
        if anywhere:
            h, text, first = _runs(x, np.array([0, *tops]))
            found.append((h, text, first, -first - RUN))
        h, text, first, last = (np.concatenate(c) for c in zip(*found))
        at = pa.array(text + low)
        return pa.RecordBatch.from_arrays(
            [pa.array(h, mask=np.arange(len(h)) < len(texts)), batch.column(0).take(at), batch.column(1).take(at),
             pa.array(first, pa.int32()), pa.array(last, pa.int32())],
            names=["hash", "id", "text_hash", "first", "last"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, held, size = 0, [], 0
            for i, text in enumerate(batch.column(2).to_pylist()):
                if held and size + len(text or "") > BATCH:
                    yield table(batch, low, held)
                    low, held, size = i, [], 0
                held.append(text)
                size += len(text or "")
            if held:
                yield table(batch, low, held)

    return docs.select("id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(
        run, f"hash long, id {kind}, text_hash long, first int, last int"
    )


def _kept_text(text: str, marks: list[dict]) -> tuple[str, int]:
    """The text without what is marked, and the number of its sentences removed or cut."""
    units = sentences(text)
    drop = {i for m in marks if m["last"] >= 0 for i in range(m["first"], m["last"] + 1)}
    cut: list[tuple[int, int]] = []  # characters
    touched = set(drop)
    covered = np.zeros(sum(len(u[2]) for u in units) + 1, bool)  # the last one is beyond the text
    for m in marks:
        if m["last"] < 0:
            covered[m["first"] : -m["last"]] = True
    if covered.any():
        at = 0
        for i, (a, b, words) in enumerate(units):
            mine = covered[at : at + len(words)]
            beyond = at and covered[at - 1] or covered[at + len(words)]
            # clauses of a sentence follow each other without its end
            long = len(words) and (i and not _END.search(text, units[i - 1][0], a) or i + 1 < len(units) and not _END.search(text, a, b))
            at += len(words)
            if i in drop or not mine.any():
                continue
            if mine.all() and (beyond or long):
                drop.add(i), touched.add(i)
            elif long:
                touched.add(i)
                places = [w.start() for w in _WORD.finditer(text, a, b)] + [b]
                cut += [(places[k], places[k + 1]) for k in np.flatnonzero(mine).tolist()]
    if not touched:
        return text, 0
    cut = sorted(cut + [units[i][:2] for i in drop])
    out, at = [], 0
    for a, b in cut:
        out.append(text[at:a])
        at = b
    return "".join(out) + text[at:], len(touched)


def remove_repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", anywhere: bool = False
) -> DataFrame:
    """(id, text, n_sentences, n_removed) for every row of `docs`; with `anywhere`, also by spans
    that end with a sentence and by runs of words, and n_removed counts cut clauses too. The first occurrence of a span is
    that of the smallest id (nulls last), then by the text and the place in it; it stays. Null texts
    stay null. Repeated rows (same id and text) are one document and keep what it keeps."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    every = cut_lineage(_span_table(rows, anywhere))
    table = every.where("hash IS NOT NULL")
    # counts first: they are short rows, and few hashes occur twice
    several = cut_lineage(table.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1"))
    # at most HOT hashes are on so many rows: they are broadcast, so that their rows stay dealt out
    limit = table.count() // HOT
    hot, cold = several.where(F.col("n") > limit), several.where(F.col("n") <= limit)
    table = cut_lineage(table.join(cold, "hash").unionByName(table.join(F.broadcast(hot), "hash")))
    place = F.struct(F.col("id").isNull().alias("unknown"), "id", "text_hash", "first")
    kept = table.groupBy("hash", "n").agg(F.min(place).alias("kept"), F.max(place).alias("other"))
    kept = kept.where("kept != other").select("hash", "n", "kept")

    def first_ones(part: Column, broadcast: bool) -> DataFrame:
        mine = kept.where(part).drop("n")
        return table.where(part).join(F.broadcast(mine) if broadcast else mine, "hash")

    again = first_ones(F.col("n") <= limit, False).unionByName(first_ones(F.col("n") > limit, True))
    again = again.where(~place.eqNullSafe(F.col("kept")))
    # of a run that overlaps the one that stays, the words after it
    inside = F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("text_hash") == F.col("kept.text_hash"))
    past = F.when(inside & (F.col("last") < 0), F.greatest("first", F.col("kept.first") + RUN)).otherwise(F.col("first"))
    mark = again.select("id", "text_hash", F.struct(past.alias("first"), "last").alias("mark"), F.lit(None).cast("int").alias("n"))
    size = every.where("hash IS NULL").select("id", "text_hash", F.col("first").alias("n"))
    marks = mark.unionByName(size, allowMissingColumns=True).groupBy(F.col("id").alias("_id"), "text_hash").agg(
        F.collect_set("mark").alias("marks"), F.max("n").cast("long").alias("n")
    )
    hashed = rows.withColumn("text_hash", F.xxhash64("text"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (hashed["text_hash"] == marks["text_hash"])
    marked = hashed.join(marks, same, "left").select("id", "text", "n", "marks")
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # rows without marks pass as they are
            some = pc.fill_null(pc.greater(pc.list_value_length(batch.column(3)), 0), False)
            at = np.flatnonzero(some.to_numpy(zero_copy_only=False))
            done = [_kept_text(*pair) for pair in zip(batch.column(1).take(at).to_pylist(), batch.column(3).take(at).to_pylist())]
            removed = np.zeros(batch.num_rows, np.int64)
            removed[at] = [n for _, n in done]
            left = pc.replace_with_mask(batch.column(1), some, pa.array([t for t, _ in done], batch.column(1).type))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), left, batch.column(2), pa.array(removed)],
                names=["id", "text", "n_sentences", "n_removed"],
            )

    done = marked.mapInArrow(run, f"id {kind}, text string, n_sentences long, n_removed long")
    return done.withColumnsRenamed({"id": id_col, "text": text_col})
