"""R-6, R-7, R-8, R-9 against numpy closed forms; the model registry end to end."""

import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from marquee.operators import models
from marquee.operators.mlp import fit_mlp, mlp_predictions
from marquee.operators.regress import fit_ridge, ridge_predictions
from marquee.operators.svd import fit_svd
from marquee.operators.tfidf import fit_tfidf


def test_ridge_matches_closed_form(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(60, 5))
    y = X @ np.array([1.0, -2.0, 0.5, 0.0, 3.0]) + rng.normal(scale=0.3, size=60) + 4.0
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType
    schema = StructType([StructField("item_id", LongType()), StructField("features", VectorUDT()),
                         StructField("label", DoubleType())])
    df = spark.createDataFrame([(i, Vectors.dense(X[i]), float(y[i])) for i in range(60)], schema)
    m = fit_ridge(df, alpha=1.0)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + np.eye(5), Xc.T @ yc)
    b = y.mean() - X.mean(0) @ w
    assert np.allclose(m.coefficients.toArray(), w, atol=1e-9) and abs(m.intercept - b) < 1e-9


def test_ridge_predictions_two_features(spark):
    rows = [(i, float(i % 7), int(i * 3 % 11), float(i % 5) if i % 9 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "item_id long, popularity double, vote_count long, vote_average double")
    got = dict(ridge_predictions(df, ["popularity", "vote_count"]).collect())
    X = np.array([[r[1], r[2]] for r in rows], dtype=float)
    y = np.array([r[3] if r[3] is not None else np.nan for r in rows])
    y = np.where(np.isnan(y), np.nanmean(y), y)
    Z = (X - X.mean(0)) / X.std(0)
    w = np.linalg.solve(Z.T @ Z + np.eye(2), Z.T @ (y - y.mean()))
    want = y.mean() + Z @ w
    assert np.allclose([got[i] for i in range(40)], want, atol=1e-9)


def _docs(spark):
    texts = ["alpha beta gamma", "beta gamma delta", "gamma delta epsilon alpha", "epsilon zeta",
             "alpha alpha beta", "zeta eta theta", "theta alpha", "iota", "", "beta eta"]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, overview string")


def test_svd_matches_numpy(spark):
    tf = fit_tfidf(_docs(spark), 50, 1)
    vocab = [r["term"] for r in tf.vocab.orderBy("term_index").collect()]
    X = np.zeros((10, len(vocab)))
    for r in tf.weights.collect():
        X[r["item_id"], vocab.index(r["term"])] = r["weight"]
    sv = fit_svd(tf, 3)
    s = np.linalg.svd(X, compute_uv=False)
    assert np.allclose(sv.singular_values, s[:3], atol=1e-9)
    U, S, Vt = np.linalg.svd(X, full_matrices=False)
    Z = U[:, :3] * S[:3]
    want = Z.var(0).sum() / X.var(0).sum()
    assert abs(sv.explained_variance_ratio - want) < 1e-9
    got = {r["item_id"]: np.array(r["vec"]) for r in sv.factors.collect()}
    for i in range(10):
        assert np.allclose(np.abs(got[i]), np.abs(Z[i]), atol=1e-9)


def test_mlp_learns_and_predicts(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(400, 8))
    y = np.tanh(X[:, 0]) * 3 + X[:, 1] ** 2
    df = spark.createDataFrame([(i, list(range(8)), X[i].tolist(), float(y[i])) for i in range(400)],
                               "item_id long, idx array<int>, val array<double>, label double")
    fm = fit_mlp(df, 8, hidden=(16,), max_iter=60, batch=32, n_iter_no_change=60, tol=0.0)
    assert np.allclose(fm[2], X.mean(0)) and np.allclose(fm[3], X.std(0))
    hist = fm[4]
    assert hist[-1] > hist[0] + 0.3
    preds = dict(mlp_predictions(df, fm).collect())
    assert len(preds) == 400 and all(np.isfinite(list(preds.values())))


def test_registry_fit_recommend_and_unknown_title(spark):
    cat = _docs(spark).withColumn("title", F.concat(F.lit("t"), F.col("item_id").cast("string"))) \
        .withColumn("genres_str", F.lit("g")).withColumn("vote_average", F.col("item_id") * 0.5) \
        .withColumn("vote_count", F.col("item_id") * 10).withColumn("popularity", F.col("item_id") * 1.0)
    fm = models.fit_model("content_based", cat, dict(max_features=50, ngram_max=2))
    titles = spark.createDataFrame([("t0",), ("missing",)], "title string")
    recs = models.recommend_titles(fm, cat, titles, 3).collect()
    assert {r["query_id"] for r in recs} == {0} and len(recs) == 3
    assert models.fit_model("content_based", cat, dict(max_features=50, ngram_max=2)) is fm   # reused


def test_compare_records_failures(spark):
    cat = _docs(spark).withColumn("title", F.col("item_id").cast("string")).withColumn("genres_str", F.lit("g")) \
        .withColumn("vote_average", F.lit(5.0)).withColumn("vote_count", F.lit(10)).withColumn("popularity", F.lit(1.0))
    q = spark.createDataFrame([(0,), (1,)], "query_id long")
    recs, timings = models.compare(cat, q, ["knn", "svd"], 3, params={"knn": dict(max_features=20, ngram_max=1),
                                                                      "svd": dict(max_features=20, ngram_max=1,
                                                                                  n_components=500)})
    st = {r["model"]: r["status"] for r in timings.collect()}
    assert st["knn"] == "ok" and recs.where("model = 'knn'").count() == 6
    # An SVD without a bounded vocabulary fails; the other model goes on.
    recs, timings = models.compare(cat, q, ["svd", "knn"], 3, params={"knn": dict(max_features=20, ngram_max=1),
                                                                      "svd": dict(max_features=0, n_components=5)})
    st = {r["model"]: r["status"] for r in timings.collect()}
    assert st["svd"].startswith("error: ValueError") and st["knn"] == "ok"
    assert {r["model"] for r in recs.collect()} == {"knn"}
    titles = cat.select("title").limit(1)
    assert models.recommend_by_name({}, "no such model", cat, titles).count() == 0


def test_sums_of_many_partitions(spark):
    from marquee.operators.combine import sum_arrays
    parts = spark.range(0, 200, 1, 100).selectExpr("id").mapInPandas(
        lambda batches: (x[["id"]].assign(g=[np.arange(70.0).tobytes()] * len(x))[["g"]] for x in batches), "g binary")
    assert np.array_equal(sum_arrays(parts), 200 * np.arange(70.0))


def test_forest_predictions_and_importance_names(spark):
    from marquee.operators.regress import feature_importance, forest_predictions
    rows = [(i, float(i % 10), int(i % 7) * 10, float(i % 10) * 0.9 + (1.0 if i % 7 == 0 else 0.0)) for i in range(120)]
    df = spark.createDataFrame(rows, "item_id long, popularity double, vote_count long, vote_average double")
    preds, model, inputs = forest_predictions(df, None, ["popularity", "vote_count"], num_trees=5, max_depth=3)
    p1 = dict(preds.collect())
    preds2, _, _ = forest_predictions(df.repartition(3), None, ["popularity", "vote_count"], num_trees=5, max_depth=3)
    assert p1 == dict(preds2.collect())                      # seed + explicit partitioning: reproducible
    assert len(p1) == 120 and inputs == ["popularity_scaled", "vote_count_scaled"]
    imp = feature_importance(model, ["popularity", "vote_count"], 20, spark).collect()
    assert [r["feature"] for r in imp][0] == "popularity" and abs(sum(r["importance"] for r in imp) - 1.0) < 1e-9
