"""IO-1 … IO-6: CSV with quoted JSON and line breaks, catalogue sink/source, model persistence."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from marquee.operators import models
from marquee.sources.tables import CREDITS_SCHEMA, read_catalog, read_csv_catalog, write_catalog


def test_csv_with_json_and_newlines(spark):
    d = tempfile.mkdtemp(prefix="marquee-csv-")
    path = os.path.join(d, "credits.csv")
    with open(path, "w") as f:
        f.write('movie_id,title,cast,crew,extra\n')
        f.write('1,"A ""quoted"" title","[{""name"": ""X""}]","[{""job"": ""Director"", ""name"": ""Y\nZ""}]",9\n')
        f.write('2,B,,"[]",9\n')
    df = read_csv_catalog(spark, path, CREDITS_SCHEMA)
    rows = {r["movie_id"]: r for r in df.collect()}
    assert rows[1]["title"] == 'A "quoted" title' and rows[1]["cast"] == '[{"name": "X"}]'
    assert "Y\nZ" in rows[1]["crew"] and rows[2]["cast"] is None
    assert df.columns == ["movie_id", "title", "cast", "crew"]


def test_catalog_roundtrip_and_partition_filter(spark):
    d = tempfile.mkdtemp(prefix="marquee-cat-")
    cat = spark.createDataFrame([(1, "a", "Film"), (2, "b", "Series")], "item_id long, title string, content_type string")
    write_catalog(cat, d + "/catalog")
    films = read_catalog(spark, d + "/catalog", "Film")
    assert [r["item_id"] for r in films.collect()] == [1]
    plan = films._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(content_type" in plan
    with pytest.raises(FileNotFoundError):
        read_catalog(spark, d + "/missing")


def test_save_and_load_models(spark):
    texts = ["alpha beta", "beta gamma", "gamma alpha delta", "delta"]
    cat = (spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, overview string")
           .withColumn("title", F.col("item_id").cast("string")).withColumn("vote_average", F.col("item_id") * 1.0)
           .withColumn("vote_count", F.col("item_id")).withColumn("popularity", F.col("item_id") * 2.0))
    fitted = {"knn": models.fit_model("knn", cat, dict(max_features=10, ngram_max=1, metric="cosine")),
              "linear": models.fit_model("linear", cat, dict(max_features=0, numeric=["popularity"], alpha=1.0))}
    d = tempfile.mkdtemp(prefix="marquee-models-")
    models.save_models(fitted, d)
    back = models.load_models(spark, d, ["knn", "linear"])
    q = spark.createDataFrame([(0,)], "query_id long")
    for name in ["knn", "linear"]:
        a = sorted(tuple(r) for r in fitted[name].recommend(q, 2).collect())
        b = sorted(tuple(r) for r in back[name].recommend(q, 2).collect())
        assert a == b, name
