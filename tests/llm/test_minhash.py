"""Links that drawn centres of a bucket do not see."""

import random

import brute
import numpy as np
from pyspark.sql import functions as F

from marquee.llm import minhash


def got(df):
    return sorted((r.doc_id, r.component_id, r.kept) for r in df.collect())


def variants(seed, ids):
    """Texts around one base: each shares about two thirds of its shingles with the others, and pairs of them
    (2k, 2k + 1) are near copies."""
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(300)]
    rows = []
    for n in range(0, len(ids), 2):
        text = list(base)
        for at in rng.sample(range(0, 300, 8), 15):
            text[at] = f"own{n}x{at}"
        rows.append((ids[n], " ".join(text)))
        text[rng.randrange(300)] = f"other{n}"
        rows.append((ids[n + 1], " ".join(text)))
    return rows


def in_one_bucket(monkeypatch):
    real = minhash.signatures
    monkeypatch.setattr(minhash, "signatures", lambda docs, words: real(docs, words).withColumn(
        "bands", F.array_repeat(F.lit(7).cast("long"), minhash.BANDS)))


def test_every_member_of_a_large_bucket_is_tried(spark, monkeypatch):
    """All documents meet in one bucket only."""
    in_one_bucket(monkeypatch)
    rows = variants(5, list(range(160)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((r[0], r[2], r[3]) for r in brute.near_duplicates(rows))
    assert sum(not r[2] for r in want) == 80
    assert got(minhash.near_duplicates(df)) == want


def test_blocks_of_a_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    in_one_bucket(monkeypatch)
    rows = variants(6, list(range(100)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((r[0], r[2], r[3]) for r in brute.near_duplicates(rows))
    assert got(minhash.near_duplicates(df)) == want


def test_all_texts_of_a_doc_id_are_joined(spark):
    """Also when the document names one of its classes itself, and when it has three."""
    one, two, three, four = ("first words alone", "second text here", "third kind of text", "fourth and last")
    rows = [(1, one), (2, one), (2, two), (3, two), (11, one + " x"), (12, three), (13, four), (20, one + " x"),
            (20, three), (20, four)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(minhash.near_duplicates(df)) == [(1, 1, True), (2, 1, False), (2, 1, False), (3, 1, False), (
        11, 11, True), (12, 11, False), (13, 11, False), *[(20, 11, False)] * 3]


def sets_of(seed):
    """Sets around a base, smaller and larger than a sketch, one of exactly its size."""
    rng = np.random.default_rng(seed)
    out = []
    for size in (1, 40, minhash.SKETCH - 1, minhash.SKETCH, 3000):
        base = rng.integers(0, 1 << 63, size, np.uint64)
        for share in (0.0, 0.05, 0.1, 0.12, 0.3):
            own = rng.integers(0, 1 << 63, size, np.uint64)
            out.append(np.unique(np.where(rng.random(size) < share, own, base)))
    return out


def test_sketches_of_whole_sets_decide_as_the_sets_do():
    sets = sets_of(1)
    x, y = map(np.array, zip(*((a, b) for a in range(len(sets)) for b in range(len(sets)) if a != b)))
    near, sure = minhash.compared([s[:minhash.SKETCH] for s in sets], x, y, 80)
    for a, b, n, s in zip(x.tolist(), y.tolist(), near.tolist(), sure.tolist()):
        both = len(np.intersect1d(sets[a], sets[b]))
        union = len(sets[a]) + len(sets[b]) - both
        assert s == (max(len(sets[a]), len(sets[b])) < minhash.SKETCH)
        if s or 100 * both >= 80 * union:
            assert n == (100 * both >= 80 * union)
        if 100 * both < 60 * union:
            assert not n


def test_forest_keeps_what_joins():
    x, y = np.array([5, 5, 3, 9, 1, 9]), np.array([3, 1, 1, 8, 9, 5])
    sure = np.array([True, True, True, True, False, False])
    assert sorted(minhash.forest(x, y, sure).tolist()) == [0, 1, 3, 4, 5]
    assert minhash.forest(x[:0], y[:0], sure[:0]).tolist() == []


def test_a_block_emits_fewer_edges_than_members(spark, monkeypatch):
    """Two components of near copies in one bucket, all pairs across them linked."""
    in_one_bucket(monkeypatch)
    base = [f"w{k}" for k in range(200)]
    rows = [(n, " ".join([*base, f"x{n}"])) for n in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = minhash.signatures(df, 4).selectExpr("doc_id id", "doc_id % 2 component", "n_shingles", "bands", "sig")
    assert minhash.open_pairs(df, classes).count() == 1
    alone = classes.withColumn("component", F.col("id"))
    assert minhash.open_pairs(df, alone).count() == 59
