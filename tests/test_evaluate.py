"""E-* on a hand-made recommendation table."""

from marquee.operators import evaluate


def _recs(spark):
    rows = [
        ("m1", 1, 1, 10, "A", "Drama, Crime", 7.5), ("m1", 1, 2, 11, "B", "Drama", 5.0),
        ("m1", 2, 1, 10, "A", "Drama, Crime", 7.5), ("m1", 2, 2, 12, "C", None, None),
        ("m2", 1, 1, 13, "D", "Comedy", 6.5), ("m2", 2, 1, 10, "A", "Drama, Crime", 7.5),
    ]
    return spark.createDataFrame(rows, "model string, query_id long, rank int, item_id long, title string, "
                                       "genres_str string, vote_average double")


def test_basic_metrics(spark):
    recs = _recs(spark)
    cat = spark.range(20).withColumnRenamed("id", "item_id")
    cov = dict(evaluate.coverage(recs, cat).collect())
    assert cov == {"m1": 15.0, "m2": 10.0}
    div = dict(evaluate.diversity_strings(recs).collect())
    assert div["m1"] == round(2 / 3 * 100, 6) and div["m2"] == 100.0
    tags = dict(evaluate.diversity_tags(recs).collect())
    assert tags["m1"] == round(2 / 5 * 100, 6)      # Drama, Crime, Drama, Drama, Crime
    prec = dict(evaluate.precision(recs).collect())
    assert prec["m1"] == 50.0 and prec["m2"] == 100.0
    avg = dict(evaluate.avg_rating(recs).collect())
    assert avg["m1"] == round((7.5 + 5 + 7.5) / 3, 6)


def test_confusion_null_is_tn_and_fn_floor(spark):
    c = {r["model"]: r for r in evaluate.confusion(_recs(spark)).collect()}
    m1 = c["m1"]
    assert (m1["tp"], m1["fp"], m1["tn"]) == (2, 1, 1)
    assert m1["precision_pct"] == round(2 / 3 * 100, 1) and m1["accuracy_pct"] == round(3 / 5 * 100, 1)


def test_agreement_diagonal_and_symmetry(spark):
    a = {(r["model_a"], r["model_b"]): r["agreement_pct"] for r in evaluate.agreement_matrix(_recs(spark)).collect()}
    assert a[("m1", "m1")] == 100.0 and a[("m1", "m2")] == a[("m2", "m1")] == 25.0


def test_comparison_best_and_quality(spark):
    m = spark.createDataFrame(
        [("m1", 0, 1.0, 0.01, 10.0, 50.0, 7.0, 80.0, 10.0), ("m2", 1, 2.0, 0.2, 5.0, 50.0, 6.0, 60.0, 200.0)],
        "model string, model_order int, fit_seconds double, recommend_seconds double, coverage double, "
        "diversity double, avg_rating double, precision double, recommend_ms double")
    s = {r["model"]: r["total_score"] for r in evaluate.comparison_score(m).collect()}
    assert abs(s["m1"] - (0.3 + 0.15 + 0.2 + 0.2)) < 1e-12 and abs(s["m2"] - 0.15) < 1e-12
    q = {r["model"]: r["quality_score"] for r in evaluate.quality_score(m).collect()}
    assert q["m1"] == min(100.0, 70 + 15 + 5) and abs(q["m2"] - (60 + 60 / 70 * 15 + 1)) < 1e-12
    best = {r["priority"]: r["model"] for p in ["balanced", "speed", "quality", "coverage"]
            for r in evaluate.best_for_priority(evaluate.comparison_score(m), p).collect()}
    assert best == {"balanced": "m1", "speed": "m1", "quality": "m1", "coverage": "m1"}


def test_sample_items_reproducible_and_bounded(spark):
    cat = spark.createDataFrame([(i, f"t{i}", i * 10) for i in range(50)], "item_id long, title string, vote_count long")
    a = evaluate.sample_items(cat, 5, 100, 42).collect()
    b = evaluate.sample_items(cat.repartition(4), 5, 100, 42).collect()
    assert a == b and len(a) == 5 and all(r["query_id"] >= 10 for r in a)
    assert evaluate.sample_items(cat, 100, 480, 1).count() == 2


def test_empty_recommendations(spark):
    recs = _recs(spark).where("false")
    cat = spark.range(5).withColumnRenamed("id", "item_id")
    assert evaluate.coverage(recs, cat).count() == 0
    assert evaluate.model_metrics(recs, cat).count() == 0


def test_quality_score_bonus_branches(spark):
    m = spark.createDataFrame([("a", 9.5, 100.0, 10.0), ("b", 0.0, 0.0, 75.0), ("c", 5.0, 35.0, 150.0)],
                              "model string, avg_rating double, precision double, recommend_ms double")
    q = {r["model"]: r["quality_score"] for r in evaluate.quality_score(m).collect()}
    assert q == {"a": 100.0, "b": 3.0, "c": 50.0 + 7.5 + 1.0}
