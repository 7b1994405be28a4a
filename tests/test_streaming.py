"""New items streamed in get the same weights as a batch transform with the stored vocabulary."""

import tempfile

from marquee.operators.tfidf import fit_tfidf, transform_items
from marquee.streaming import start_item_vectoriser


def test_stream_matches_batch(spark):
    old = spark.createDataFrame([(1, "galaxy hero"), (2, "ocean whales"), (3, "hero ocean")],
                                "item_id long, overview string")
    model = fit_tfidf(old, None, 1)
    new = spark.createDataFrame([(10, "hero galaxy galaxy"), (11, "unknown words")], "item_id long, overview string")
    root = tempfile.mkdtemp(prefix="marquee-stream-")
    new.write.parquet(f"{root}/in")
    q = start_item_vectoriser(spark, model, f"{root}/in", new.schema, f"{root}/out", f"{root}/ckpt", trigger_once=True)
    q.awaitTermination(120)
    got = sorted((r["item_id"], r["term"], round(r["weight"], 12)) for r in spark.read.parquet(f"{root}/out").collect())
    want = sorted((r["item_id"], r["term"], round(r["weight"], 12)) for r in transform_items(model, new).collect())
    assert got == want and {g[0] for g in got} == {10}
