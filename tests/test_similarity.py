"""R-1, R-2, R-3 against brute force on small fixtures (all metrics, ties, fill, partitioning)."""

import math

import numpy as np
import pytest

from marquee.operators.neighbors import nearest_by_value
from marquee.operators.similarity import recommend_dense, recommend_sparse
from marquee.operators.tfidf import fit_tfidf

TEXTS = [
    "space opera hero galaxy", "galaxy hero rebels", "space opera hero galaxy", "romantic comedy paris",
    "comedy paris love", "the of and", "hero", "documentary ocean whales", "ocean whales hero", "love galaxy",
    "zebra", "yak", "xylophone quartet",
]


def _items(spark, parts=3):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "item_id long, overview string")
    return df.repartition(parts)


def _brute(m, queries, n, metric):
    w = {}
    for r in m.weights.collect():
        w.setdefault(r["item_id"], {})[r["term"]] = r["weight"]
    ids = [r["item_id"] for r in m.item_norms.collect()]
    out = {}
    for q in queries:
        a = w.get(q, {})
        scores = []
        for i in ids:
            if i == q:
                continue
            b = w.get(i, {})
            terms = set(a) | set(b)
            if metric == "cosine":
                s = sum(a.get(t, 0) * b.get(t, 0) for t in terms)
            elif metric == "euclidean":
                s = 1 - math.sqrt(max(0.0, round(sum(a.get(t, 0) ** 2 for t in a) + sum(b.get(t, 0) ** 2 for t in b)
                                                 - 2 * sum(a.get(t, 0) * b.get(t, 0) for t in terms), 12)))
            else:
                s = 1 - sum(abs(a.get(t, 0) - b.get(t, 0)) for t in terms)
            scores.append((-round(s, 9), i, s))
        scores.sort()
        out[q] = [(i, round(s, 6)) for _, i, s in scores[:n]]
    return out


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "manhattan"])
def test_sparse_matches_brute_force(spark, metric):
    m = fit_tfidf(_items(spark), max_features=None, ngram_max=1)
    queries = [0, 5, 6, 10]
    q = spark.createDataFrame([(x,) for x in queries], "query_id long")
    got = {}
    for r in recommend_sparse(m, q, 5, metric).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["item_id"], r["similarity_score"]))
    want = _brute(m, queries, 5, metric)
    assert got == want


def test_identical_items_and_exclusion(spark):
    m = fit_tfidf(_items(spark), max_features=None, ngram_max=1)
    q = spark.createDataFrame([(0,)], "query_id long")
    res = recommend_sparse(m, q, 3, "cosine").orderBy("rank").collect()
    assert res[0]["item_id"] == 2 and res[0]["similarity_score"] == 1.0
    assert all(r["item_id"] != 0 for r in res)


def test_n_larger_than_catalogue_and_unknown_query(spark):
    m = fit_tfidf(_items(spark), max_features=None, ngram_max=1)
    q = spark.createDataFrame([(1,), (999,)], "query_id long")
    res = recommend_sparse(m, q, 50, "cosine").collect()
    assert {r["query_id"] for r in res} == {1}
    assert len(res) == len(TEXTS) - 1


def test_invariant_under_repartitioning(spark):
    q = spark.createDataFrame([(0,), (3,)], "query_id long")
    a = recommend_sparse(fit_tfidf(_items(spark, 1), None, 1), q, 4).orderBy("query_id", "rank").collect()
    b = recommend_sparse(fit_tfidf(_items(spark, 5), None, 1), q, 4).orderBy("query_id", "rank").collect()
    assert a == b


@pytest.mark.parametrize("metric", ["cosine", "euclidean", "manhattan"])
def test_dense_matches_numpy(spark, metric):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(40, 6))
    X[7] = X[3]          # duplicate
    X[9] = 0.0           # zero vector
    df = spark.createDataFrame([(i, X[i].tolist()) for i in range(40)], "item_id long, vec array<double>")
    q = spark.createDataFrame([(3,), (9,)], "query_id long")
    got = recommend_dense(df.repartition(4), q, 5, metric).orderBy("query_id", "rank").collect()
    for qi in (3, 9):
        if metric == "cosine":
            nx = np.linalg.norm(X, axis=1)
            den = nx * nx[qi]
            s = np.divide(X @ X[qi], den, out=np.zeros(40), where=den > 0)
        elif metric == "euclidean":
            s = 1 - np.sqrt(((X - X[qi]) ** 2).sum(1))
        else:
            s = 1 - np.abs(X - X[qi]).sum(1)
        order = sorted([i for i in range(40) if i != qi], key=lambda i: (-round(s[i], 9), i))[:5]
        assert [r["item_id"] for r in got if r["query_id"] == qi] == order
    blocks = recommend_dense(df.repartition(4), q, 5, metric, block=1).orderBy("query_id", "rank").collect()
    assert blocks == got


def test_nearest_by_value_with_ties_and_hot_bucket(spark):
    vals = [5.0] * 30 + [1.0, 2.0, 9.0, 5.5, 4.4, 0.0, 10.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "item_id long, prediction double")
    queries = [0, 30, 32, 35]
    q = spark.createDataFrame([(x,) for x in queries], "query_id long")
    got = nearest_by_value(df.repartition(3), q, 6, bins=8).orderBy("query_id", "rank").collect()
    mn, mx = min(vals), max(vals)
    for qi in queries:
        t = vals[qi]
        d = sorted([(round(abs(v - t), 9), i) for i, v in enumerate(vals) if i != qi])[:6]
        maxd = max(mx - t, t - mn)
        want = [(i, round(1 - abs(vals[i] - t) / (maxd + 1e-10), 6)) for _, i in d]
        assert [(r["item_id"], r["similarity_score"]) for r in got if r["query_id"] == qi] == want


def test_nearest_by_value_with_an_outlier(spark):
    vals = [i * 0.37 % 1.0 for i in range(200)] + [1e12]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "item_id long, prediction double")
    q = spark.createDataFrame([(0,), (77,), (200,)], "query_id long")
    got = nearest_by_value(df.repartition(3), q, 5, bins=16).orderBy("query_id", "rank").collect()
    for qi in (0, 77, 200):
        want = sorted((round(abs(v - vals[qi]), 9), i) for i, v in enumerate(vals) if i != qi)[:5]
        assert [r["item_id"] for r in got if r["query_id"] == qi] == [i for _, i in want]


def test_nearest_by_value_constant_predictions(spark):
    df = spark.createDataFrame([(i, 3.0) for i in range(5)], "item_id long, prediction double")
    q = spark.createDataFrame([(2,)], "query_id long")
    got = nearest_by_value(df, q, 10).orderBy("rank").collect()
    assert [r["item_id"] for r in got] == [0, 1, 3, 4]
    assert all(r["similarity_score"] == 1.0 for r in got)


def test_query_with_empty_vector_gets_fill_by_id(spark):
    # item 5 is "the of and": no vocabulary term; every candidate scores 0 (cosine)
    m = fit_tfidf(_items(spark), max_features=None, ngram_max=1)
    q = spark.createDataFrame([(5,)], "query_id long")
    got = [(r["item_id"], r["similarity_score"]) for r in recommend_sparse(m, q, 4).orderBy("rank").collect()]
    assert got == [(0, 0.0), (1, 0.0), (2, 0.0), (3, 0.0)]
    eu = [(r["item_id"], r["similarity_score"]) for r in recommend_sparse(m, q, 2, "euclidean").orderBy("rank").collect()]
    assert eu == [(0, 0.0), (1, 0.0)]          # distance |b| = 1 for every non-empty item
