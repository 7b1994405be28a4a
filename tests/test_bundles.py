"""Bundles: every model saved, read back, and applied to items that were not in the fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import bundles, models
from marquee.operators.linear import fit_sparse
from marquee.operators.regress import ridge_predictions

PARAMS = {
    "content_based": dict(max_features=40, ngram_max=2), "knn": dict(max_features=30, ngram_max=1, metric="cosine"),
    "random_forest": dict(max_features=20, numeric=["popularity", "vote_count"], num_trees=6, max_depth=4),
    "linear": dict(max_features=20, numeric=["popularity"], alpha=1.0),
    "svd": dict(max_features=20, ngram_max=1, n_components=4),
    "neural": dict(max_features=20, hidden=(8,), max_iter=5),
}


@pytest.fixture(scope="module")
def catalog(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    rows = [(k, " ".join(words[(k * j + j) % 10] for j in range(1, 2 + k % 6)), f"t{k}", k % 11 * 0.9, k * 3 % 50, k * 0.5)
            for k in range(80)]
    return spark.createDataFrame(rows, "item_id long, overview string, title string, vote_average double, vote_count long, "
                                       "popularity double")


@pytest.fixture(scope="module")
def fitted(catalog):
    old = catalog.where("item_id < 60")
    return {n: models.fit_model(n, old, p, reuse=False) for n, p in PARAMS.items()}


def values(df, name):
    if name == "svd":
        return {r["item_id"]: r["vec"] for r in df.collect()}
    if name in ("content_based", "knn"):
        return {(r["item_id"], r["term"]): r["weight"] for r in df.collect()}
    return {r["item_id"]: r["prediction"] for r in df.collect()}


def test_bundle_round_trip_and_new_items(spark, catalog, fitted, tmp_path):
    assert bundles.save_bundle(fitted, f"file://{tmp_path}/b", "Film") == 1
    back = bundles.load_bundle(spark, f"file://{tmp_path}/b", content_type="Film")
    assert list(back) == list(models.MODEL_NAMES)
    q, new = spark.createDataFrame([(0,), (7,), (59,)], "query_id long"), catalog.where("item_id >= 50")
    for name, fm in fitted.items():
        assert sorted(map(tuple, back[name].recommend(q, 4).collect())) == sorted(map(tuple, fm.recommend(q, 4).collect()))
        a, b = values(fm.score(new), name), values(back[name].score(new), name)
        assert a.keys() == b.keys() and len(a) >= 20 and all(np.allclose(a[k], b[k], atol=1e-12) for k in a), name
        assert back[name].params == {k: list(v) if isinstance(v, tuple) else v for k, v in PARAMS[name].items()}
    assert back["svd"].extras["explained_variance_ratio"] == fitted["svd"].extras["explained_variance_ratio"]
    top = [tuple(r) for r in models.feature_importance(back["random_forest"]).collect()]
    assert top == [tuple(r) for r in models.feature_importance(fitted["random_forest"]).collect()]


def test_scores_of_fitted_items_are_the_predictions(catalog, fitted):
    old = catalog.where("item_id < 60")
    for name in ("random_forest", "linear", "neural"):
        a, b = values(fitted[name].predictions, name), values(fitted[name].score(old), name)
        assert a.keys() == b.keys() and all(np.isclose(a[k], b[k], atol=1e-9) for k in a), name
    vec = {r["item_id"]: r["vec"] for r in fitted["svd"].factors.collect()}
    assert all(np.allclose(vec[k], v, atol=1e-9) for k, v in values(fitted["svd"].score(old), "svd").items())


def test_unfinished_bundles_are_not_read(spark, fitted, tmp_path, monkeypatch):
    path, one = f"{tmp_path}/b", {"linear": fitted["linear"]}
    with pytest.raises(FileNotFoundError):
        bundles.load_bundle(spark, path)
    monkeypatch.setattr(bundles, "_publish", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        bundles.save_bundle(one, path)
    with pytest.raises(FileNotFoundError):
        bundles.load_bundle(spark, path)
    monkeypatch.undo()
    assert bundles.save_bundle(one, path) == 1 and bundles.save_bundle({"knn": fitted["knn"]}, path) == 2
    assert list(bundles.load_bundle(spark, path)) == ["knn"] and list(bundles.load_bundle(spark, path, number=1)) == ["linear"]
    with pytest.raises(KeyError):
        bundles.load_bundle(spark, path, ["svd"])
    with pytest.raises(FileNotFoundError):
        bundles.load_bundle(spark, path, content_type="Series")


def test_ridge_solvers_agree_with_the_closed_form(spark):
    rng = np.random.default_rng(4)
    x = np.where(rng.random((90, 12)) < 0.4, rng.normal(size=(90, 12)), 0)
    y = x @ rng.normal(size=12) + 3 + 0.1 * rng.normal(size=90)
    rows = spark.createDataFrame([([int(j) for j in np.flatnonzero(r)], [float(v) for v in r[r != 0]], float(t))
                                  for r, t in zip(x, y)], "idx array<int>, val array<double>, label double")
    c = x - x.mean(0)
    want = np.linalg.solve(c.T @ c + 2 * np.eye(12), c.T @ (y - y.mean()))
    for direct in (4096, 3):
        w, b = fit_sparse(rows, 12, 2.0, direct)
        assert np.allclose(w, want, atol=1e-9) and np.isclose(b, y.mean() - x.mean(0) @ want)
    assert fit_sparse(rows.where("false"), 12)[1] == 0.0


def test_sparse_ridge_equals_the_estimator(spark, catalog, fitted):
    fm = models.fit_model("linear", catalog, dict(max_features=0, numeric=["popularity", "vote_count"], alpha=1.0), reuse=False)
    a, b = dict(fm.predictions.collect()), dict(ridge_predictions(catalog, ["popularity", "vote_count"]).collect())
    assert a.keys() == b.keys() and all(np.isclose(a[k], b[k], atol=1e-9) for k in a)
    got = {r["feature"]: r["coefficient"] for r in fitted["linear"].state.coefficients(spark).collect()}
    assert {"(intercept)", "popularity"} < set(got) and len(got) == 2 + fitted["linear"].tfidf.vocab.count()
    assert fitted["linear"].state.coefficients(spark).where(F.isnan("coefficient")).count() == 0
