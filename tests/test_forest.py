"""R-4, R-5: the histogram forest against plain trees, its phases against each other, and the models built on it."""

import numpy as np
from pyspark.sql import functions as F

from marquee.operators import forest
from marquee.operators.forest import BINS, LEAF


def sparse_rows(rng, n, features):
    dense = np.where(rng.random((n, features)) < 0.3, rng.integers(1, BINS, (n, features)), 0)
    y = dense[:, 0] * 0.5 + (dense[:, 1] > 10) * 4.0 - 0.2 * dense[:, 2] * (dense[:, 3] > 0) + rng.normal(size=n)
    return dense, np.round(y * 64) / 64


def frame(spark, dense, y):
    features = dense.shape[1]
    rows = [(k, float(v), [f * BINS + int(d[f]) for f in range(features) if d[f]]) for k, (d, v) in enumerate(zip(dense, y))]
    return spark.createDataFrame(rows, "item_id long, y double, entries array<int>")


def plain_tree(dense, y, w, max_depth):
    """(node -> (feature, bin)) by trying every split of every node."""
    out = {}

    def split(node, rows):
        if node.bit_length() > max_depth or len(rows) < 2:
            return
        W, G, best = w[rows].sum(), (w[rows] * y[rows]).sum(), (1e-9 * max(1.0, (w[rows] * y[rows]).sum() ** 2 / w[rows].sum()), None)
        for f in range(dense.shape[1]):
            for b in range(BINS - 1):
                left = dense[rows, f] <= b
                a, c = rows[left], rows[~left]
                if len(a) and len(c):
                    ga, gc = (w[a] * y[a]).sum(), (w[c] * y[c]).sum()
                    gain = ga * ga / w[a].sum() + gc * gc / w[c].sum() - G * G / W
                    if gain > best[0] + 1e-9:
                        best = (gain, (f, b))
        if best[1]:
            out[node] = best[1]
            left = dense[rows, best[1][0]] <= best[1][1]
            split(2 * node, rows[left])
            split(2 * node + 1, rows[~left])

    split(1, np.flatnonzero(w > 0))
    return out


def test_trees_equal_plain_trees(spark):
    rng = np.random.default_rng(1)
    dense, y = sparse_rows(rng, 150, 5)
    model = forest.fit_forest(frame(spark, dense, y), 5, trees=3, max_depth=4, seed=7)
    w = forest.draws(np.arange(150), 3, 7)
    centred, _, _ = forest.fixed_point(frame(spark, dense, y))
    exact = np.array([r["y"] for r in centred.orderBy("item_id").collect()])
    for t in range(3):
        got = {r[1]: (r[2], r[3]) for r in model.nodes if r[0] == t and r[2] != LEAF}
        assert got == plain_tree(dense, exact, w[:, t].astype(float), 4)


def test_phases_and_partitions_do_not_change_the_trees(spark):
    """Levels by histograms with subtraction (small nodes of 20 or 0 rows), or every tree in one task."""
    rng = np.random.default_rng(2)
    rows = frame(spark, *sparse_rows(rng, 400, 6))
    whole = forest.fit_forest(rows, 6, trees=4, max_depth=5)
    for small, parts in ((20, 3), (0, 5)):
        assert forest.fit_forest(rows.repartition(parts), 6, trees=4, max_depth=5, small_rows=small).nodes == whole.nodes


def test_leaves_hold_weighted_means_and_importance_finds_the_columns(spark):
    rng = np.random.default_rng(3)
    dense, y = sparse_rows(rng, 500, 6)
    rows = frame(spark, dense, y)
    model = forest.fit_forest(rows, 6, trees=10, max_depth=6)
    at, w = model.places(dense.astype(np.uint8)), forest.draws(np.arange(500), 10, 42)
    for t in range(10):
        for leaf in np.unique(at[:, t]):
            k = (at[:, t] == leaf) & (w[:, t] > 0)
            assert k.any() and np.isclose(model.value[leaf], np.average(y[k], weights=w[k, t]), atol=1e-6)
    imp = model.importance()
    assert abs(imp.sum() - 1) < 1e-9 and set(np.argsort(-imp)[:2]) == {0, 1}
    got = dict(forest.forest_values(rows, model).collect())
    want = model.value[at].mean(axis=1)
    assert all(np.isclose(got[k], want[k]) for k in range(500))
    assert 1 - ((want - y) ** 2).sum() / ((y - y.mean()) ** 2).sum() > 0.6


def test_draws_are_poisson():
    w = forest.draws(np.arange(20_000), 5, 42)
    assert abs(w.mean() - 1) < 0.02 and abs(w.var() - 1) < 0.03 and (w[:, 0] != w[:, 1]).any()


def test_constant_target_empty_and_single_rows(spark):
    rows = frame(spark, np.array([[1, 0], [2, 3], [0, 4]]), np.array([5.0, 5.0, 5.0]))
    model = forest.fit_forest(rows, 2, trees=5, max_depth=3)
    assert all(r[2] == LEAF and abs(r[4] - 5.0) < 1e-9 for r in model.nodes) and model.importance().sum() == 0
    assert [r["prediction"] for r in forest.forest_values(rows, model).collect()] == [5.0] * 3
    empty = forest.fit_forest(rows.where("false"), 2, trees=2, max_depth=3)
    assert len(empty.nodes) == 2 and forest.forest_values(rows.where("false"), empty).count() == 0


def test_bins_of_numeric_and_text_columns(spark):
    items = spark.createDataFrame([(k, float(k % 10), None if k % 7 == 0 else k) for k in range(100)],
                                  "item_id long, a double, b long")
    at = forest.numeric_cuts(items, ["a", "b"])
    w = spark.createDataFrame([(k, "x", 0.1 * (k % 5 + 1)) for k in range(0, 100, 2)], "item_id long, term string, weight double")
    vocab = spark.createDataFrame([("x", 0), ("never", 1)], "term string, term_index int")
    cuts = forest.text_cuts(w, vocab)
    rows = forest.binned_rows(items, w, cuts, 2, ["a", "b"], at, F.col("a")).collect()
    c = {r["term"]: r["cuts"] for r in cuts.collect()}
    assert c["never"] == [0.0] and c["x"][0] == 0.0 and len(c["x"]) <= BINS
    for r in rows:
        k, want = r["item_id"], []
        if k % 2 == 0:
            want.append(sum(x < 0.1 * (k % 5 + 1) for x in c["x"]))
        for j, v in enumerate((k % 10, 0 if k % 7 == 0 else k)):
            b = sum(x < v for x in at[j])
            want += [(2 + j) * BINS + b] if b else []
        assert r["entries"] == want
