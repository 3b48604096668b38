"""Spans and runs as the query looks them up, against a plain search over words."""

import random
from collections import Counter, defaultdict

import numpy as np

from sluice.llm import sentence_spans as ss


def made_texts(n, seed=3):
    r = random.Random(seed)

    def run(name, size):
        ends = r.choices([" ", ". ", ".\n", "\n \n", "... "], [30, 2, 1, 1, 1], k=size)
        return "".join(f"{name}{r.randrange(10**6)}{end}" for end in ends)

    passages = [run(f"p{k}w", r.choice([14, 33, 60])) for k in range(6)]
    texts = []
    for i in range(n):
        parts = [run(f"o{i}w", r.randrange(25)) + r.choice(passages) for _ in range(r.randrange(4))]
        texts.append("".join(parts) + run(f"e{i}w", 5))
    return [*texts, texts[0], "word " * 200, "", None, "İ. " * 30, "." * 50_000]


def chosen_runs(words):
    """First words of the runs of RUN words with the least hash of RUN runs in a row, the last one
    of equal ones; the hash is that of the run alone."""
    hashes = [int(ss._runs(ss._word_numbers(words[k : k + ss.RUN]), np.array([0, ss.RUN]))[0][0]) % (1 << 64)
              for k in range(len(words) - ss.RUN + 1)]
    out = set()
    for w in range(max(1, len(hashes) - ss.RUN + 1) if hashes else 0):
        window = hashes[w : w + ss.RUN]
        out.add(w + max(j for j, h in enumerate(window) if h == min(window)))
    return out


def test_what_the_query_removes(spark):
    rows = list(enumerate(made_texts(40)))
    rows += [(None, rows[1][1]), (7, rows[7][1]), (7, rows[9][1])]
    where = defaultdict(list)
    for i, t in {(i, t) for i, t in rows if t}:
        units = ss.sentences(t)
        words = [w for u in units for w in u[2]]
        found = set()
        for p in range(len(units)):
            for q in range(p + ss.SENTENCES, len(units) + 1):
                inner = sum(len(u[2]) for u in units[p:q])
                if inner >= ss.WORDS and units[p][2]:
                    found.add((p, q))
                    break
        for q in range(1, len(units) + 1):
            for p in range(q - ss.SENTENCES, -1, -1):
                if sum(len(u[2]) for u in units[p:q]) >= ss.WORDS:
                    # sentences without words before it belong to no span
                    if units[q - 1][2] and units[p][2]:
                        found.add((p, q))
                    break
        for p, q in found:
            where["|".join(" ".join(u[2]) for u in units[p:q])].append((i is None, i or 0, t, p, q - 1))
        for p in chosen_runs(words):
            where[tuple(words[p : p + ss.RUN])].append((i is None, i or 0, t, p, -p - ss.RUN))
    hashed = spark.createDataFrame([(t,) for t in {t for _, t in rows if t}], "t string").selectExpr("t", "xxhash64(t) AS h")
    number = {r.t: r.h for r in hashed.collect()}
    marks = defaultdict(list)
    for places in where.values():
        places.sort(key=lambda x: (x[0], x[1], number[x[2]], x[3]))
        u0, i0, t0, first0, _ = places[0]
        for u, i, t, first, last in places[1:]:
            if last < 0 and (u, i, t) == (u0, i0, t0):
                first = max(first, first0 + ss.RUN)
            marks[u, i, t].append({"first": first, "last": last})
    want = Counter()
    for i, t in rows:
        left, n = ss._kept_text(t, marks[i is None, i or 0, t]) if t else (t, 0)
        want[i, left, len(ss.sentences(t)) if t else 0, n] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ss.remove_repeated_spans(df, anywhere=True).collect()
    assert Counter((r.doc_id, r.text, r.n_sentences, r.n_removed) for r in got) == want
    assert sum(r.n_removed > 0 for r in got) > 10


def test_hot_spans_and_cold_ones_give_the_same(spark, monkeypatch):
    df = spark.createDataFrame(list(enumerate(made_texts(30))), "doc_id long, text string").selectExpr("doc_id", "text", "1 AS hash", "2 AS n")
    results = []
    for hot in (1, 10**9):  # none hot, all hot
        monkeypatch.setattr(ss, "HOT", hot)
        results.append(Counter(map(tuple, ss.remove_repeated_spans(df, anywhere=True).collect())))
    assert results[0] == results[1] and sum(results[0].values()) == df.count()


def test_a_long_row_of_marks_is_scanned_once():
    text = "." * 1_000_000 + "x! " + "a b. " * 10
    assert [len(u[2]) for u in ss.sentences(text)] == [1] + [2] * 10
