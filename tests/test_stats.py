"""A-* and T-* on hand-computed fixtures."""

import numpy as np
import pandas as pd

from marquee.operators import clean, stats, topk


def _df(spark):
    data = [(1, "a", 0.0, 0, 1.0), (2, "b", 5.49, 9, 1.0), (3, None, 5.5, 10, 1.0), (4, "d", 5.99, 49, 1.0),
            (5, "e", 6.0, 50, 1.0), (6, "f", 6.99, 99, 1.0), (7, "g", 7.0, 100, 1.0), (8, "h", None, 100, 1.0)]
    return spark.createDataFrame(data, "item_id long, title string, vote_average double, vote_count long, c double")


def test_histogram_last_bin_closed_and_constant(spark):
    h = stats.histogram(_df(spark), "vote_average", 7).orderBy("bin").collect()
    assert sum(r["n_items"] for r in h) == 7 and h[-1]["n_items"] == 3 and h[0]["n_items"] == 1
    v = np.array([0.0, 5.49, 5.5, 5.99, 6.0, 6.99, 7.0])
    assert [r["n_items"] for r in h] == np.histogram(v, bins=7)[0].tolist()
    hc = stats.histogram(_df(spark), "c", 20).where("n_items > 0").collect()
    assert [(r["bin"], r["n_items"]) for r in hc] == [(1, 8)]


def test_correlation_constant_column_is_null(spark):
    rows = {(r["col_x"], r["col_y"]): r["corr"] for r in
            stats.correlation_matrix(_df(spark), ["vote_average", "vote_count", "c"]).collect()}
    pdf = _df(spark).toPandas()
    want = pdf[["vote_average", "vote_count"]].corr()
    assert abs(rows[("vote_average", "vote_count")] - round(want.iloc[0, 1], 6)) < 1e-9
    assert rows[("c", "vote_average")] is None and rows[("vote_count", "vote_count")] == 1.0


def test_describe_matches_pandas(spark):
    got = {r["column_name"]: r for r in stats.describe(_df(spark), ["vote_average", "vote_count"]).collect()}
    d = _df(spark).toPandas()[["vote_average", "vote_count"]].describe()
    for c in ["vote_average", "vote_count"]:
        for ours, theirs in [("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                             ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
            assert abs(got[c][ours] - round(d.loc[theirs, c], 6)) < 1e-9, (c, ours)


def test_minmax_constant_is_half_and_inverse(spark):
    out = stats.minmax_normalize(_df(spark), "c").select("c_norm").distinct().collect()
    assert out[0][0] == 0.5
    inv = stats.minmax_normalize(_df(spark), "vote_count", inverse=True)
    got = dict((r["item_id"], r["vote_count_inv"]) for r in inv.collect())
    assert got[1] == 1.0 and got[7] == 0.0


def test_standard_scale_population_and_zero_variance(spark):
    s = stats.standard_scale(_df(spark), ["vote_average", "c"]).collect()
    x = np.array([r["vote_average"] or 0.0 for r in _df(spark).orderBy("item_id").collect()])
    z = (x - x.mean()) / x.std()
    got = [r["vote_average_scaled"] for r in sorted(s, key=lambda r: r["item_id"])]
    assert np.allclose(got, z) and all(r["c_scaled"] == 0.0 for r in s)


def test_top_content_threshold_ties_and_nulls(spark):
    t = topk.top_content(_df(spark), "vote_average", 3, min_votes=50, cols=("title", "vote_count")).collect()
    assert [r["item_id"] for r in t] == [7, 6, 5]
    base = _df(spark)
    pop = topk.top_popular_sample(base.withColumn("popularity", base.vote_count), 3).collect()
    assert [r["item_id"] for r in pop] == [7, 8, 6]


def test_genre_text_blank_dropped_after_limit(spark):
    df = spark.createDataFrame([(1, "A, ,B"), (2, "A,"), (3, None), (4, " ,")], "item_id long, genres_str string")
    got = [tuple(r) for r in stats.genre_distribution_text(df, top=2).collect()]
    assert got == [("A", 2)]          # '' (3 times) takes a top-2 slot, then is dropped


def test_missing_counts_and_stage_counts(spark):
    m = dict((r["column_name"], r["n_missing"]) for r in stats.missing_counts(_df(spark)).collect())
    assert m["title"] == 1 and m["vote_average"] == 1 and m["item_id"] == 0
    st = dict((r["stage"], r["n_rows"]) for r in clean.stage_counts(_df(spark)).collect())
    assert st == {"raw": 8, "voted": 7, "reliable": 5, "reliable_titled": 4}


def test_lookup_titles_first_match_and_missing(spark):
    cat = spark.createDataFrame([(5, "X"), (2, "X"), (3, "Y")], "item_id long, title string")
    q = spark.createDataFrame([("X",), ("Z",)], "title string")
    assert [tuple(r) for r in clean.lookup_titles(cat, q).collect()] == [("X", 2)]


def test_left_join_suffix_and_fanout(spark):
    movies = spark.createDataFrame([(1, "m1"), (2, "m2")], "id long, title string")
    credits = spark.createDataFrame([(1, "c1"), (1, "c1b")], "movie_id long, title string")
    j = clean.left_join_suffixed(movies, credits, "id", "movie_id")
    assert sorted((r["id"], r["title"], r["title_credits"]) for r in j.collect()) == \
        [(1, "m1", "c1"), (1, "m1", "c1b"), (2, "m2", None)]


def test_rating_center_matches_pandas(spark):
    r = stats.rating_center(_df(spark)).first()
    s = pd.Series([0.0, 5.49, 5.5, 5.99, 6.0, 6.99, 7.0])
    assert abs(r["mean_rating"] - round(s.mean(), 6)) < 1e-12 and r["median_rating"] == s.median()


def test_exact_quantiles_bracket_search_with_ties(spark, monkeypatch):
    monkeypatch.setattr(stats, "APPROX_ACCURACY", 50)      # coarse sketches: several rounds
    rng = np.random.default_rng(0)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.integers(0, 5, 1000).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double").repartition(4)
    ps = [0.0, 0.1, 0.25, 0.5, 0.6, 0.75, 0.999, 1.0]
    n, got = stats.exact_quantiles(df, "x", ps)
    assert n == 6000 and got == list(np.quantile(vals, ps))


def test_selection_of_exact_quantiles(spark):
    """Ties, negative and tiny numbers, infinities, nulls, an empty and a constant column, in five jobs."""
    import numpy as np

    from marquee.operators import stats
    rng = np.random.default_rng(3)
    cols = {"a": [float(x) for x in rng.normal(size=301)], "b": [float(x) for x in rng.integers(-3, 3, 301)],
            "c": [None] * 301, "d": [7.5] * 301, "e": [float(x) for x in 10.0 ** rng.uniform(-300, 300, 300) * rng.choice((-1, 1), 300)] + [None],
            "f": [float("inf"), float("-inf"), -0.0, 0.0, 5e-324] * 60 + [None]}
    df = spark.createDataFrame(list(zip(*cols.values())), ", ".join(f"{c} double" for c in cols)).repartition(5)
    counts = {c: sum(x is not None for x in v) for c, v in cols.items()}
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = stats.column_quantiles(df, {c: probs for c in cols if c != "f"}, counts)
    assert got["c"] == [None] * 7
    for c in "abde":
        assert np.allclose(got[c], np.quantile([x for x in cols[c] if x is not None], probs), rtol=1e-12)
    found = stats._order_statistics(df, {"f": {0, 60, 179, 180, 239, 299}})
    assert [found["f", k] for k in (0, 60, 179, 180, 239, 299)] == [float("-inf"), 0.0, 0.0, 5e-324, 5e-324, float("inf")]
