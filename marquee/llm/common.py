"""Helpers the operators share: written intermediate tables, distributed numbering, connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    """Where the public tokenizer file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def prepare(spark: SparkSession) -> None:
    """Executors need this package and a shared folder."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read again.

    Cuts the lineage like a reliable checkpoint, compressed and by column; the files go when the application ends.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder, for files that tasks write; it goes when the application ends."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(place)
    store.deleteOnExit(place)
    return path


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, whatever their names."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns))


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Column ``name``: 0, 1, 2, ... without gaps within each key, however large a key's group is.

    Rows of a key are dealt to as many buckets as there are shuffle partitions, numbered there, and shifted by the
    sizes of the buckets before theirs.  ``df`` is read twice; pass a stored one.
    """
    n = parallelism(df.sparkSession)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = (dealt.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
             .select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")))
    within = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    return (dealt.withColumn("_place", within).join(shift, [*keys, "_bucket"])
            .withColumn(name, F.col("_place") + F.col("_shift") - 1).drop("_bucket", "_place", "_shift"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges(a, b)``: one row (node, component) per node with an edge.

    Alternating large-star and small-star steps (Kiveris et al., 2014) until every edge joins a node to its
    component's smallest node.  A hub's neighbours meet in a combining minimum, never in a list, and each step's
    edges are written to the shared folder.  The number of rows never grows over that of the edges.
    """
    e = (edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    e = stored(e, "edges")
    while True:
        # A star forest: nobody is both a leaf and a root, and every leaf has one edge.
        ends = e.select(F.col("a").alias("n"), F.lit(1).alias("leaf"), F.lit(0).alias("root")).unionAll(
            e.select(F.col("b").alias("n"), F.lit(0).alias("leaf"), F.lit(1).alias("root")))
        tangled = ends.groupBy("n").agg(F.sum("leaf").alias("leaf"), F.max("root").alias("root")).where(
            "leaf > 1 or leaf + root > 1").limit(1)
        if not tangled.take(1):
            return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
                e.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        # Large star: every larger neighbour of a node is joined to the smallest in its neighbourhood.
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(
            "a != b").distinct()
        # Small star: every smaller neighbour of a node, and the node, are joined to the smallest of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x")).select("x.a", "x.b")
        e = stored(small.where("a != b").distinct(), "edges")
