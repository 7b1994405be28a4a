"""Catalogue adapters over the driver tables.

The reference reads a film table, a credits table (JSON cast/crew) and a TV
table.  These adapters derive tables with the same columns from the driver's
Parquet files so that every operator runs over whole tables whose size grows
with the scale factor:

* ``raw_films``   part ⟕ (lineitem R/F per part): JSON genres and keywords text
* ``raw_credits`` conversations per conv_id: JSON cast and crew lists in turn order
* ``raw_series``  customer ⟕ (orders P per customer) ⟕ nation
* ``items``       documents ⟕ labels: the long-text catalogue for the text models

Aggregations are pre-combined map-side (groupBy with partial aggregation)
before they are joined back to the dimension table.  Money sums are rounded
to their input precision (cents) before any division, so derived values do
not depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def raw_films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Film rows: id, title, overview, tagline, genres (JSON), keywords (JSON), numbers."""
    part = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    votes = (read_table(spark, sf_dir, "lineitem")
             .where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"))
             .groupBy("l_partkey")
             .agg(F.count(F.lit(1)).alias("n_votes"),
                  F.avg("l_quantity").alias("avg_qty"),
                  F.sum("l_extendedprice").alias("sum_price"),
                  F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("sum_rev")))
    j = part.join(votes, part.p_partkey == votes.l_partkey, "left")
    genres = F.to_json(F.array(
        F.struct(F.col("p_size").cast("bigint").alias("id"), F.col("p_type").alias("name")),
        F.struct(F.lit(0).cast("bigint").alias("id"), F.col("p_brand").alias("name"))))
    return j.select(
        F.col("p_partkey").alias("id"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string")).alias("title"),
        F.lit(None).cast("string").alias("overview"),
        F.lit(None).cast("string").alias("tagline"),
        genres.alias("genres"),
        F.to_json(F.split(F.col("p_name"), " ")).alias("keywords"),
        F.col("p_retailprice").alias("budget"),
        F.round("sum_rev", 4).alias("revenue"),
        F.col("p_size").cast("double").alias("runtime"),
        (F.round("sum_price", 2) / F.lit(1e5)).alias("popularity"),
        (F.col("avg_qty") / F.lit(5.0)).alias("vote_average"),
        (F.coalesce(F.col("n_votes"), F.lit(0)) * F.lit(20)).cast("bigint").alias("vote_count"),
        F.lit("en").alias("original_language"),
    )


def raw_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits rows: movie_id, title, cast and crew as JSON lists in turn order.

    One conversation is one bounded group (its turns); the list is sorted by
    turn inside the row after a map-side partial ``collect_list``.  A ``system``
    turn plays the director.
    """
    conv = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    job = F.when(F.col("role") == "system", F.lit("Director")).otherwise(F.initcap("role"))
    g = (conv.groupBy("conv_id")
         .agg(F.array_sort(F.collect_list(F.struct("turn", job.alias("job"), F.col("text").alias("name"))))
              .alias("turns")))
    cast = F.transform("turns", lambda t: F.struct(t["turn"].alias("order"), t["name"].alias("name")))
    crew = F.transform("turns", lambda t: F.struct(t["job"].alias("job"), t["name"].alias("name")))
    return g.select(
        F.col("conv_id").alias("movie_id"),
        F.concat(F.lit("Conversation "), F.col("conv_id").cast("string")).alias("title"),
        F.to_json(cast).alias("cast"),
        F.to_json(crew).alias("crew"),
    )


def raw_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TV rows: id, name, comma-text genres, seasons, episodes, votes, popularity."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    orders = (read_table(spark, sf_dir, "orders")
              .where(F.col("o_orderstatus") == "P")
              .groupBy("o_custkey")
              .agg(F.count(F.lit(1)).alias("n_orders"),
                   (F.round(F.sum("o_totalprice"), 2) / F.count(F.lit(1))).alias("avg_price"),
                   F.sum("o_totalprice").alias("sum_price"),
                   F.countDistinct(F.year("o_orderdate")).alias("n_years")))
    j = (cust.join(orders, cust.c_custkey == orders.o_custkey, "left")
         .join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left"))
    return j.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.coalesce(F.col("n_years"), F.lit(0)).cast("bigint").alias("number_of_seasons"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("bigint").alias("number_of_episodes"),
        (F.coalesce(F.col("n_orders"), F.lit(0)) * F.lit(15)).cast("bigint").alias("vote_count"),
        (F.col("avg_price") / F.lit(50000.0)).alias("vote_average"),
        F.lit(None).cast("string").alias("overview"),
        (F.round("sum_price", 2) / F.lit(1e4)).alias("popularity"),
        F.lit(None).cast("string").alias("tagline"),
        F.concat_ws(", ", F.col("c_mktsegment"), F.col("n_name")).alias("genres"),
        F.lit(None).cast("string").alias("created_by"),
        F.col("n_name").alias("networks"),
        F.lit("en").alias("original_language"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-text catalogue in the processed schema, plus the nullable labels.

    The label table is small relative to documents but is not assumed to be;
    the join is left so documents without labels are kept.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    j = docs.join(labels, "doc_id", "left")
    return j.select(
        F.col("doc_id").alias("item_id"),
        F.concat(F.lit("Document #"), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("overview"),
        F.concat_ws(", ", F.col("lang"), F.col("source")).alias("genres_str"),
        F.lit("").alias("keywords_str"),
        F.lit("").alias("director"),
        F.lit("").alias("cast_str"),
        ((F.col("n_chars") % 101) / F.lit(10.0)).alias("vote_average"),
        (F.col("n_chars") % 500).cast("bigint").alias("vote_count"),
        (F.col("n_chars") / F.lit(100.0)).alias("popularity"),
        F.lit("Document").alias("content_type"),
        F.col("quality"),
        F.col("toxic"),
    )


def films(spark: SparkSession, sf_dir: str, cast_n: int = 5) -> DataFrame:
    """Processed film catalogue (raw films ⟕ credits, parsed, projected)."""
    from ..operators.clean import preprocess_films
    return preprocess_films(raw_films(spark, sf_dir), raw_credits(spark, sf_dir), cast_n=cast_n)


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed series catalogue (renamed, aligned to the film schema)."""
    from ..operators.clean import preprocess_series
    return preprocess_series(raw_series(spark, sf_dir))
