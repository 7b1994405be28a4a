"""R-7: the matrices that tasks send are as many as cores at most, however many partitions the rows have."""

import numpy as np
import pytest

from marquee.operators import combine, svd


@pytest.mark.parametrize("direct", [True, False])
def test_matrices_sent_do_not_grow_with_the_partitions(spark, direct, monkeypatch):
    x = np.random.default_rng(7).normal(size=(90, 5))
    rows = spark.createDataFrame([(list(range(5)), v.tolist()) for v in x], "idx array<int>, val array<double>").repartition(40)
    sent, real = [], combine.sum_arrays
    for module in (combine, svd):
        monkeypatch.setattr(module, "sum_arrays", lambda parts: sent.append(parts.count()) or real(parts))
    if direct:
        got, want = combine.gramian(rows, 5), x.T @ x
    else:
        basis = np.eye(5)[:, :2]
        got, want = svd._through(rows, basis, False), x.T @ (x @ basis)
    assert np.allclose(got, want)
    assert max(sent) <= max(8, spark.sparkContext.defaultParallelism)
