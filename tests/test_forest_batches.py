"""R-4: histograms in parts of any size, and batches without partial sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import forest
from marquee.operators.forest import BINS


def frame(spark, n=300, features=5):
    rng = np.random.default_rng(6)
    dense = np.where(rng.random((n, features)) < 0.4, rng.integers(1, BINS, (n, features)), 0)
    y = np.round((dense[:, 0] * 0.5 + rng.normal(size=n)) * 64) / 64
    rows = [(k, float(v), [f * BINS + int(d[f]) for f in range(features) if d[f]]) for k, (d, v) in enumerate(zip(dense, y))]
    return spark.createDataFrame(rows, "item_id long, y double, entries array<int>")


@pytest.mark.parametrize("held", [0, 1 << 24])
def test_tasks_that_emit_all_before_their_end(spark, held, monkeypatch):
    """Each tree's sums are emitted at once, so that nothing is left for the last batch of a task."""
    rows = frame(spark)
    want = forest.fit_forest(rows, 5, trees=3, max_depth=4).nodes
    monkeypatch.setattr(forest, "PENDING", 0)
    monkeypatch.setattr(forest, "HELD", held, raising=False)
    assert forest.fit_forest(rows, 5, trees=3, max_depth=4, small_rows=0).nodes == want


def test_partial_sums_do_not_grow_with_the_shuffle_partitions(spark, monkeypatch):
    rows, sent, real, key = frame(spark), [], forest.cut_lineage, "spark.sql.shuffle.partitions"
    monkeypatch.setattr(forest, "cut_lineage", lambda df: sent.append(real(df)) or sent[-1])
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        forest.fit_forest(rows, 5, trees=3, max_depth=2)
    finally:
        spark.conf.set(key, before)
    used = sent[0].select(F.spark_partition_id().alias("p")).distinct().count()
    assert used <= max(8, spark.sparkContext.defaultParallelism)


def test_groups_of_nodes_and_trees_give_the_same_trees(spark, monkeypatch):
    """Histograms of one node at a time, and small nodes of one tree at a time; nothing is sent as a row per entry."""
    rows = frame(spark)
    want = forest.fit_forest(rows, 5, trees=3, max_depth=3).nodes
    sent, real = [], forest._Grower._finished
    monkeypatch.setattr(forest._Grower, "_finished", lambda self, m, small: sent.append({t for t, _ in small}) or real(self, m, small))
    monkeypatch.setattr(forest, "HELD", 5 * BINS)
    monkeypatch.setattr(forest, "SENT", 0)
    monkeypatch.setattr(forest, "PASSES", 3)
    assert forest.fit_forest(rows, 5, trees=3, max_depth=3, small_rows=100).nodes == want
    assert [len(x) for x in sent] == [1] * 3
    assert forest.fit_forest(rows, 5, trees=3, max_depth=3, small_rows=0).nodes == want
