"""Passages that begin anywhere in a long sentence, and the ends of passages."""

import random

import numpy as np

from sluice.llm import sentence_spans as ss


def own(seed, n):
    r = random.Random(seed)
    return [f"w{seed}x{r.randrange(10**6)}" for _ in range(n)]


def removed(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in ss.remove_repeated_spans(df, anywhere=True).collect()}
    return [got[i].text for i in range(len(texts))]


def test_unpunctuated_passages_at_every_offset(spark):
    passage = own(0, 60)
    before = [own(100 + i, 3 + i) for i in range(17)]
    after = [own(200 + i, 30) for i in range(17)]
    texts = [" ".join([*b, *passage, *a]) for b, a in zip(before, after)]
    got = removed(spark, texts)
    assert got[0] == texts[0]
    for i in range(1, 17):
        left = got[i].split()
        rest = [w for w in left if w in passage]
        assert [w for w in left if w not in passage] == before[i] + after[i]
        # a run of 31 words is found, so none of that length and no inner word is left
        assert len(rest) <= 30 and not set(rest) & set(passage[15:-15])


def test_a_passage_without_its_full_stops(spark):
    sentences = [" ".join(own(i, 9)) for i in range(8)]
    texts = [". ".join(sentences[:4]) + ". End of this.", " ".join(own(50, 5)) + " " + " ".join(sentences)]
    texts.append(" ".join(own(60, 7) + sentences[4].split() + sentences[5].split() + sentences[6].split() + sentences[7].split()))
    got = removed(spark, texts)
    assert got[0] == texts[0] and got[1] == texts[1]  # words with and without a full stop differ
    assert len(got[2].split()) <= 7 + 30 - 1 and got[2].split()[:7] == own(60, 7)


def test_short_last_sentences_of_a_passage(spark):
    passage = "The first of these sentences has eleven words in it all. Then some more words follow here. Done now. "
    texts = [f"{' '.join(own(i, 8))}. {passage}{' '.join(own(10 + i, 8))}." for i in range(3)]
    got = removed(spark, texts)
    assert got[0] == texts[0]
    assert got[1:] == [f"{' '.join(own(i, 8))}. {' '.join(own(10 + i, 8))}." for i in (1, 2)]


def test_one_repeated_word_keeps_its_first_run(spark):
    (got,) = removed(spark, ["a " * 500])
    assert ss.RUN <= len(got.split()) < 70


def test_runs_are_shared_and_leave_no_gap():
    passage = own(0, 31)
    for i in range(40):
        a, b = ([(0, 0, own(s, i) + passage + own(s + 1, 9))] for s in (1, 3))
        (h, at), (k, _) = ss.runs(a), ss.runs(b)
        assert set(h.tolist()) & set(k.tolist())
        assert np.diff(at).max(initial=0) <= ss.RUN
