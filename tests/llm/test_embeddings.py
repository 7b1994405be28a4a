"""A vec_id with several vectors, one of them in a bucket of several blocks."""

import numpy as np
from marquee.llm import embeddings


def test_blocks_with_two_vectors_of_an_id(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    rng = np.random.default_rng(5)

    def near(x):
        return (np.array(x, float) + 0.01 * rng.standard_normal(8)).tolist()

    common = [1.0] * 8
    rows = [(k, near(common)) for k in range(60)]
    # A pair of its own for each id: 100 + k is near the second vector of k.
    for k in range(12):
        own = rng.standard_normal(8) * 3
        own -= own.mean()
        rows += [(k, near(own)), (100 + k, near(own))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    out = {(r.vec_id, r.component_id) for r in embeddings.near_duplicates(df).collect()}
    assert out == {(k, 0) for k in [*range(60), *range(100, 112)]}
