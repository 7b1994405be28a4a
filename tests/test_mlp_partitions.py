"""R-9: what an epoch sends does not grow with the session's shuffle partitions."""

import numpy as np
import pyarrow as pa

from marquee.operators import mlp


def test_trainers_are_as_many_as_cores_at_most(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4))
    df = spark.createDataFrame([(i, list(range(4)), x[i].tolist(), float(x[i, 0])) for i in range(300)],
                               "item_id long, idx array<int>, val array<double>, label double")
    sent, real, key = [], mlp.sum_arrays, "spark.sql.shuffle.partitions"
    monkeypatch.setattr(mlp, "sum_arrays", lambda parts: sent.append(parts.count()) or real(parts))
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    try:
        fitted = mlp.fit_mlp(df, 4, hidden=(8,), max_iter=3)
    finally:
        spark.conf.set(key, before)
    assert len(fitted[4]) == len(sent) == 4 and np.isfinite(fitted[0]).all()
    assert max(sent) <= max(8, spark.sparkContext.defaultParallelism)


def test_epochs_read_batches_as_they_were():
    batch = pa.RecordBatch.from_arrays([pa.array([[0, 2], None, []], pa.list_(pa.int32())), pa.array([1.0, None, 3.0])], ["idx", "label"])
    assert list(mlp._unpacked(mlp._packed([batch, batch.slice(1)]))) == [batch, batch.slice(1)]
