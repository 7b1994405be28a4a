"""Extra columns of any name pass through the pipeline's stages."""

from pyspark.sql import functions as F

NAMES = ["my col", "a-b", "a.b", "tick`s", "kept", "row", "select", "ü(1)", "text "]


def test_stages_keep_columns_of_any_name(spark, docs_rows):
    import corpus_pipeline

    df = spark.createDataFrame([(*r, 7) for r in docs_rows], "doc_id long, text string, n_chars long")
    df = df.select("doc_id", "text", "n_chars", *(F.lit(k).alias(c) for k, c in enumerate(NAMES)))
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, df, "")
        assert out.columns == df.columns and out.count() > 0, name
        assert {tuple(r[3:]) for r in out.collect()} == {tuple(range(len(NAMES)))}
        df = out
    assert corpus_pipeline.STAGES[3][1](spark, df, "").count() > 0
