"""Power-of-two sequences, the Merkle manifest and vector codes against plain versions."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import binary_pieces, merkle, packing, queries, vector_codes

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [
    (None, "One Two three.", "en", "a", 1), (None, None, None, None, None), (900_001, None, "en", "a", 0),
    (900_002, "", None, None, None), (900_003, " \n\t ", "en", "", 4), (900_004, "One", "en", "ä", 3),
    (900_005, "one", "en", "b", 3), (900_005, "one", "en", "b", 3), (900_005, "Other", "en", "b", 5),
    (900_006, "A b " * 30_000, "en", "a", 120_000), (900_007, "Ünï 中文 \x00 end", "x", "y", 3),
    (900_008, "a<|endoftext|> b <|endoftext|>", "en", "c", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    base = spark.read.parquet(f"{FOLDER}/documents.parquet")
    more = spark.createDataFrame(AWKWARD, SCHEMA)
    names = ("id", "grp", "h", "idx", "n", "up", "length", "_part", "_slot")  # names the operators use
    return base.unionByName(more).select("*", *[F.lit(1).alias(c) for c in names]).cache()


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def levels_up(hashes):
    out = [hashes]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i : i + 16])) for i in range(0, len(out[-1]), 16)])
    return out


def siblings(levels, i):
    """(left, right) hashes of the other children on the way up from leaf i."""
    out = []
    for level in levels[:-1]:
        first = i - i % 16
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 16])))
        i //= 16
    return out


def plain_manifest(rows):
    def text(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    lower = {i: i + 32 for i in range(65, 91)}
    groups = defaultdict(list)
    for r in rows:
        leaf = H("".join(text(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, r.text)))
        other = leaf
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None:
            other = H("".join(text(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, r.text.translate(lower))))
        groups[r.source].append((r.doc_id is not None, r.doc_id or 0, leaf, other, r.doc_id))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: x[:3])
        trees[s] = levels_up([g[2] for g in groups[s]])
    top = levels_up([trees[s][-1][0] for s in names])
    out = Counter()
    for k, s in enumerate(names):
        for i, (_, _, leaf, other, doc) in enumerate(groups[s]):
            path = siblings(trees[s], i) + siblings(top, k)
            fold = other
            for left, right in path:
                fold = H(left + fold + right)
            out[doc, leaf, trees[s][-1][0], top[-1][0], H("".join(a + b for a, b in path)), fold, fold == top[-1][0]] += 1
    return out


def rows_of(df, *names):
    return Counter(tuple(r) for r in df.select(*names).collect())


MANIFEST = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@pytest.mark.parametrize("runs", [16, 1])
def test_manifest_equals_plain_tree(docs, monkeypatch, runs):
    monkeypatch.setattr(merkle, "RUNS", runs)
    want = plain_manifest(docs.collect())
    assert rows_of(merkle.dataset_manifest(docs), *MANIFEST) == want
    assert {w[-1] for w in want} == {True, False}


def test_manifest_of_one_group_over_three_levels(spark):
    docs = spark.range(0, 700, numPartitions=7).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("Text "), F.col("id") % 9).alias("text"), F.lit("en").alias("lang"),
        F.lit("s").alias("source"), F.lit(6).cast("long").alias("n_chars"),
    )
    assert rows_of(merkle.dataset_manifest(docs), *MANIFEST) == plain_manifest(docs.collect())


def test_manifest_of_few_rows(docs):
    assert merkle.dataset_manifest(docs.limit(0)).count() == 0
    one = docs.where("doc_id = 900004")
    row = merkle.dataset_manifest(one).first()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == H("")
    repeated = docs.where("doc_id = 900005 AND text = 'one'")
    assert rows_of(merkle.dataset_manifest(repeated), *MANIFEST) == plain_manifest(repeated.collect())


def test_a_changed_row_changes_every_root_above(docs):
    unique = docs.where("doc_id < 30 OR doc_id = 900004")
    before = {r.doc_id: r for r in merkle.dataset_manifest(unique).collect()}
    edited = unique.withColumn("lang", F.when(F.col("doc_id") == 900_004, "fr").otherwise(F.col("lang")))
    for r in merkle.dataset_manifest(edited).collect():
        assert r.root != before[r.doc_id].root
        assert (r.leaf != before[r.doc_id].leaf) == (r.doc_id == 900_004)


def test_power_of_two_sequences_are_a_round_trip(docs):
    slow = Tokenizer.from_file(queries.vocabulary())
    want = Counter()
    for r in docs.collect():
        ids = [*slow.encode(r.text or "", add_special_tokens=False).ids, 1]
        start, rest = 0, len(ids)
        while rest:
            size = min(2048, 1 << int(math.log2(rest)))
            piece = np.array(ids[start : start + size], "<u4").tobytes()
            want[r.doc_id, start, size, zlib.crc32(piece), len(ids)] += 1
            start, rest = start + size, rest - size
    got = binary_pieces.power_of_two_sequences(docs, queries.vocabulary()).cache()
    assert rows_of(got, "doc_id", "start", "length", "ids_crc32", "doc_tokens") == want
    table = got.toPandas()
    assert (table.offset == 0).all() and table.sequence_id.is_unique
    assert (2**table.bucket == table.length).all()
    for _, bucket in table.groupby("bucket"):
        assert sorted(bucket.bucket_row) == list(range(len(bucket)))
    assert binary_pieces.power_of_two_sequences(docs.limit(0), queries.vocabulary()).count() == 0


def test_buckets_hold_the_ids(spark, docs, tmp_path):
    few = docs.where("doc_id < 20 OR doc_id >= 900001")
    sequences = binary_pieces.power_of_two_sequences(few, queries.vocabulary(), longest=64, keep_ids=True)
    binary_pieces.write_buckets(sequences, str(tmp_path / "b"))
    slow = Tokenizer.from_file(queries.vocabulary())
    read = spark.read.parquet(str(tmp_path / "b"))
    assert read.where("size(ids) != power(2, bucket) OR bucket > 6").count() == 0
    joined = defaultdict(list)
    for r in read.orderBy("doc_id", "start").collect():
        joined[r.doc_id] += list(r.ids)
    assert joined[900_008] == [*slow.encode(AWKWARD[-1][1], add_special_tokens=False).ids, 1]
    assert sum(map(len, joined.values())) == sequences.selectExpr("sum(length)").first()[0]
    with pytest.raises(ValueError):
        binary_pieces.binary_pieces(few, queries.vocabulary(), longest=1000)


def test_encoder_reads_added_tokens():
    fast, slow = packing.load_encoder(queries.vocabulary()), Tokenizer.from_file(queries.vocabulary())
    texts = ["a <|endoftext|>b", "<|endoftext|><|endoftext|>", " x  <|endoftext|>  y ", "<|endoftext", "plain  text \n"]
    assert fast(texts) == [slow.encode(t, add_special_tokens=False).ids for t in texts]
    assert 50256 in fast(texts)[0]


def plain_codes(rows, entries=64, rounds=2, parts=16):
    kept = [
        (r.vec_id, r.label, [math.floor(256 * float(x)) for x in r.embedding]) for r in rows
        if r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)
    ]
    size = len(kept[0][2]) // parts
    first = sorted(kept, key=lambda k: (k[0] is None, k[0] or 0, k[2]))[:entries]
    books = [[k[2][p * size : (p + 1) * size] for k in first] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[p]))

    def cut(v, p):
        return v[p * size : (p + 1) * size]

    for _ in range(rounds):
        new = []
        for p in range(parts):
            members = defaultdict(list)
            for _, _, v in kept:
                members[nearest(p, cut(v, p))[1]].append(cut(v, p))
            new.append([
                [sum(c) // len(members[j]) for c in zip(*members[j])] if j in members else e for j, e in enumerate(books[p])
            ])
        books = new
    text = ",".join(str(x) for p in books for e in p for x in e)
    found = []
    for i, label, v in kept:
        best = [nearest(p, cut(v, p)) for p in range(parts)]
        found.append((i, label, "".join(f"{j:02x}" for _, j in best), sum(d for d, _ in best)))
    by_label = Counter()
    for _, label, _, error in found:
        by_label[label] += error
    return Counter((i, code, error, by_label[label], H(text)) for i, label, code, error in found)


CODES = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


@pytest.fixture(scope="module")
def vectors(spark):
    base = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding", "label")
    plain = [0.1 * (i % 7) - 0.3 for i in range(64)]
    odd = [
        (None, plain, 1), (None, plain, None), (-5, [-x for x in plain], None), (-5, [-x for x in plain], None),
        (-4, None, 1), (-3, [None, *plain[1:]], 1), (-2, [float("nan"), *plain[1:]], 1), (-1, [float("inf"), *plain[1:]], 2),
        (-6, [0.0] * 64, 3), (-7, [-0.0] * 64, 3), (-8, [40.0] * 64, 77),
    ]
    more = spark.createDataFrame(odd, "vec_id long, embedding array<float>, label int")
    return base.unionByName(more).withColumns({c: F.lit(1) for c in ("v", "codes", "sums", "code", "_label")}).cache()


def test_codes_equal_plain_rounds(vectors):
    assert rows_of(vector_codes.vector_codes(vectors), *CODES) == plain_codes(vectors.collect())


def test_codes_of_few_vectors(vectors):
    assert vector_codes.vector_codes(vectors.limit(0)).count() == 0
    assert vector_codes.vector_codes(vectors.where("embedding IS NULL")).count() == 0
    one = vectors.where("vec_id = -8")
    assert rows_of(vector_codes.vector_codes(one), *CODES) == plain_codes(one.collect())
    with pytest.raises(Exception, match="beyond"):
        vector_codes.vector_codes(vectors.withColumn("embedding", F.transform("embedding", lambda x: x * 1e9))).count()


@pytest.mark.parametrize("rounds", [0, 1, 6])
def test_more_rounds_and_other_sizes(vectors, rounds):
    few = vectors.where("vec_id BETWEEN 0 AND 150")
    got = vector_codes.vector_codes(few, parts=8, entries=16, rounds=rounds)
    assert rows_of(got, *CODES) == plain_codes(few.collect(), 16, rounds, 8)


def test_bounds_spare_scans(spark, vectors):
    kept = vector_codes.cut_lineage(vector_codes.whole_vectors(vectors, "vec_id", "embedding", "label"))
    _, _, scans = vector_codes.train_and_code(kept, entries=16, rounds=8)
    assert scans[0][0] == scans[0][1]
    assert scans[-1][0] < scans[-1][1] / 2  # entries settle, so most parts are not scanned again
