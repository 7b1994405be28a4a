"""R-7 beyond the Gramian's bound: the range finder against numpy's SVD."""

import numpy as np

from marquee.operators.svd import fit_svd, right_vectors
from marquee.operators.tfidf import fit_tfidf


def test_range_finder_finds_the_leading_subspace(spark):
    rng = np.random.default_rng(9)
    u, v = (np.linalg.qr(rng.normal(size=(n, 60)))[0] for n in (300, 80))
    x = (u * 0.75 ** np.arange(60)) @ v.T * 50
    x[np.abs(x) < 0.05] = 0
    rows = spark.createDataFrame([([int(j) for j in np.flatnonzero(r)], [float(t) for t in r[r != 0]]) for r in x] + [(None, None)],
                                 "idx array<int>, val array<double>").repartition(4)
    lam, found = right_vectors(rows, 80, 8, direct=10)
    _, s, vt = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(np.sqrt(lam), s[:8], rtol=1e-6) and np.allclose(found.T @ found, np.eye(8), atol=1e-9)
    assert np.linalg.svd(found.T @ vt[:8].T, compute_uv=False).min() > 1 - 1e-8        # cosine of the largest angle
    exact, basis = right_vectors(rows, 80, 8)
    assert np.allclose(exact, lam, rtol=1e-6) and np.allclose(np.abs(np.sum(basis * found, axis=0)), 1, atol=1e-6)


def test_both_ways_give_one_model(spark):
    texts = [" ".join(f"w{(k * j) % 23}" for j in range(1, 9)) for k in range(60)]
    tf = fit_tfidf(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "item_id long, overview string"), 40, 1)
    a, b = fit_svd(tf, 5), fit_svd(tf, 5, direct=0)
    assert np.allclose(a.singular_values, b.singular_values, rtol=1e-3)
    assert abs(a.explained_variance_ratio - b.explained_variance_ratio) < 1e-3
