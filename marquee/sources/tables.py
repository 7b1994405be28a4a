"""Scans and sinks (IO-1 ... IO-4).

All scans go through ``spark.read`` so Catalyst can prune columns and push
filters into the Parquet reader; callers select the columns they need right
after the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (Parquet, schema from the file footer)."""
    if name not in DRIVER_TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Explicit schemas for the CSV catalogue inputs: no inference pass over the data.
MOVIES_SCHEMA = T.StructType([
    T.StructField("budget", T.DoubleType()),
    T.StructField("genres", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("keywords", T.StringType()),
    T.StructField("original_language", T.StringType()),
    T.StructField("overview", T.StringType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("revenue", T.DoubleType()),
    T.StructField("runtime", T.DoubleType()),
    T.StructField("tagline", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.LongType()),
])

CREDITS_SCHEMA = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("cast", T.StringType()),
    T.StructField("crew", T.StringType()),
])

SERIES_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("number_of_seasons", T.LongType()),
    T.StructField("number_of_episodes", T.LongType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("overview", T.StringType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("tagline", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("created_by", T.StringType()),
    T.StructField("networks", T.StringType()),
    T.StructField("original_language", T.StringType()),
])


def read_csv_catalog(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """IO-1: header CSV whose quoted fields may hold JSON and line breaks.

    Every column is read as text (no inference pass over the data); the
    columns named in ``schema`` are then picked by header name and converted
    with ``try_cast`` (unparsable values become null, missing columns are
    null).  NaN in double columns becomes null so the null rules apply
    uniformly.
    """
    raw = (spark.read
           .option("header", True)
           .option("multiLine", True)
           .option("quote", '"')
           .option("escape", '"')
           .option("mode", "PERMISSIVE")
           .csv(path))
    present = set(raw.columns)
    out = []
    for f in schema.fields:
        c = F.col(f.name).try_cast(f.dataType) if f.name in present else F.lit(None).cast(f.dataType)
        if isinstance(f.dataType, T.DoubleType):
            c = F.nanvl(c, F.lit(None).cast("double"))
        out.append(c.alias(f.name))
    return raw.select(*out)


def write_catalog(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO-3: processed catalogue as Parquet, one directory per ``content_type``."""
    df.write.mode(mode).partitionBy("content_type").parquet(path)


def read_catalog(spark: SparkSession, path: str, content_type: str | None = None) -> DataFrame:
    """IO-4: read the processed catalogue; a missing path raises (no silent None).

    A ``content_type`` filter prunes partitions at planning time.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        raise FileNotFoundError(f"processed catalogue not found: {path}")
    df = spark.read.parquet(path)
    if content_type is not None:
        df = df.where(F.col("content_type") == content_type)
    return df
