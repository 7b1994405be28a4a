"""Catalogues are cut by their size: a small one is not dealt to all of the session's shuffle partitions."""

import pytest

from marquee import session
from marquee.operators import models

KEY = "spark.sql.shuffle.partitions"
NUMERIC = dict(max_features=20, numeric=["popularity", "vote_count"], alpha=1.0)


def _catalog(spark):
    rows = [(k, f"word{k % 7} other{k % 5} same", float(k), k % 11, float(k % 4)) for k in range(60)]
    return spark.createDataFrame(rows, "item_id long, overview string, popularity double, vote_count long, vote_average double")


def _fitted(spark, name, params, partitions):
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, str(partitions))
    try:
        fitted = models.fit_model(name, _catalog(spark), params, reuse=False)
        assert spark.conf.get(KEY) == str(partitions)
        recs = fitted.recommend(_catalog(spark).selectExpr("item_id as query_id"), 3)
        assert spark.conf.get(KEY) == str(partitions)
        return fitted, sorted(map(tuple, recs.collect()))
    finally:
        spark.conf.set(KEY, before)


def test_small_catalogue_has_few_partitions(spark):
    few, got = _fitted(spark, "linear", NUMERIC, 97)
    assert few.tfidf.rows.rdd.getNumPartitions() <= max(8, 2 * spark.sparkContext.defaultParallelism) < 97
    assert got == _fitted(spark, "linear", NUMERIC, 2)[1] and len(got) == 180


def test_large_catalogues_keep_the_sessions_partitions(spark):
    before = spark.conf.get(KEY)
    spark.conf.set(KEY, "500")
    try:
        assert session.sized_partitions(spark, 6_000_000_000) == 500
        assert session.sized_partitions(spark, 100 * session.PARTITION_BYTES - 1) == 100
    finally:
        spark.conf.set(KEY, before)


def test_setting_comes_back_after_a_failure(spark):
    before = spark.conf.get(KEY)
    with pytest.raises(RuntimeError), session.partitioned(spark, 1):
        assert spark.conf.get(KEY) == "1"
        raise RuntimeError
    assert spark.conf.get(KEY) == before


def test_items_without_rows(spark):
    fitted = models.fit_model("content_based", _catalog(spark).where("item_id < 0"), dict(max_features=5, ngram_max=1), reuse=False)
    assert fitted.n_items == 0 and fitted.recommend(_catalog(spark).selectExpr("item_id as query_id"), 3).count() == 0
