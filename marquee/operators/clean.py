"""Projection, filtering, cleaning and lookups (P-*, J-1, J-2, SO-4).

Everything is a lazy DataFrame transformation; Catalyst pushes the filters and
the column pruning down to the Parquet scans of the adapters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.jsoncols import first_by_job, first_n_names, join_list, json_names, split_trim

CATALOG_COLUMNS = ["item_id", "title", "overview", "genres_str", "keywords_str", "director",
                   "cast_str", "vote_average", "vote_count", "popularity", "content_type"]
TEXT_COLUMNS = ["overview", "genres_str", "keywords_str", "director", "cast_str"]


def left_join_suffixed(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                       suffix: str = "_credits") -> DataFrame:
    """J-1: left equi-join; right columns whose name clashes get ``suffix``.

    Duplicate right keys fan out (one output row per match), unmatched left
    rows keep nulls on the right side.
    """
    clash = set(left.columns)
    renamed = right.select(*[F.col(c).alias(c + suffix if c in clash and c != right_key else c)
                             for c in right.columns])
    return left.join(renamed, left[left_key] == renamed[right_key], "left")


def preprocess_films(raw: DataFrame, credits: DataFrame, cast_n: int = 5,
                     director_job: str = "Director") -> DataFrame:
    """Films ⟕ credits, JSON lists parsed, text filled, ``content_type`` added."""
    j = left_join_suffixed(raw, credits, "id", "movie_id")
    return (j
            .withColumn("item_id", F.col("id"))
            .withColumn("genres_list", json_names("genres"))
            .withColumn("genres_str", join_list("genres_list"))
            .withColumn("keywords_list", json_names("keywords"))
            .withColumn("keywords_str", join_list("keywords_list"))
            .withColumn("director", first_by_job("crew", director_job))
            .withColumn("cast_list", first_n_names("cast", cast_n))
            .withColumn("cast_str", join_list("cast_list"))
            .withColumn("overview", F.coalesce(F.col("overview"), F.lit("")))
            .withColumn("tagline", F.coalesce(F.col("tagline"), F.lit("")))
            .withColumn("content_type", F.lit("Film")))


def preprocess_series(raw: DataFrame, min_votes: int | None = None) -> DataFrame:
    """Series: ``name``→``title``, comma genres split, blanks filled, schema aligned (P-2, P-6)."""
    df = raw.withColumnRenamed("name", "title")
    if min_votes is not None:
        df = df.where(F.col("vote_count") >= min_votes)
    return (df
            .withColumn("item_id", F.col("id"))
            .withColumn("genres_list", split_trim("genres"))
            .withColumn("genres_str", F.coalesce(F.col("genres"), F.lit("")))
            .withColumn("keywords_str", F.lit(""))
            .withColumn("director", F.coalesce(F.col("created_by"), F.lit("")))
            .withColumn("cast_str", F.lit(""))
            .withColumn("overview", F.coalesce(F.col("overview"), F.lit("")))
            .withColumn("tagline", F.coalesce(F.col("tagline"), F.lit("")))
            .withColumn("content_type", F.lit("Series")))


def catalog_projection(df: DataFrame) -> DataFrame:
    """P-1: the fixed catalogue schema."""
    return df.select(*CATALOG_COLUMNS)


def fill_missing_text(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P-4: missing text becomes ''."""
    cols = [c for c in (cols or TEXT_COLUMNS) if c in df.columns]
    return df.fillna("", subset=cols)


def drop_null(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """P-5: drop rows whose key columns are null."""
    return df.dropna(subset=cols or ["title"])


def filter_voted(df: DataFrame, min_votes: int = 1) -> DataFrame:
    """P-7 (``vote_count > 0``) and P-9/P-10 thresholds (``>= min_votes``)."""
    return df.where(F.col("vote_count") >= min_votes)


def filter_reliable(df: DataFrame, min_votes: int = 10, min_rating: float = 0.0) -> DataFrame:
    """P-8: ``vote_count >= min_votes AND vote_average > min_rating``."""
    return df.where((F.col("vote_count") >= min_votes) & (F.col("vote_average") > min_rating))


def pair_without_nulls(df: DataFrame, x: str = "popularity", y: str = "vote_average") -> DataFrame:
    """P-11: two columns, rows with a null in either dropped."""
    keep = ["item_id"] if "item_id" in df.columns else []
    return df.select(*keep, x, y).dropna(subset=[x, y])


def values_without_nulls(df: DataFrame, col: str = "vote_average") -> DataFrame:
    """P-12: one column without nulls."""
    keep = ["item_id"] if "item_id" in df.columns else []
    return df.select(*keep, col).dropna(subset=[col])


def existing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    """P-13: keep only columns present in the schema (driver-side, no job)."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def title_search(df: DataFrame, text: str) -> DataFrame:
    """P-15: titles containing ``text`` (case-insensitive)."""
    return (df.where(F.col("title").isNotNull() &
                     F.lower(F.col("title")).contains(text.lower()))
            .select("item_id", "title"))


def lookup_titles(catalog: DataFrame, titles: DataFrame) -> DataFrame:
    """J-2: query titles → first matching item (smallest ``item_id``).

    Unknown titles give no row.  The catalogue is reduced by a semi-join on
    the query titles before the per-title ``min``, so the aggregation only
    sees matching rows.
    """
    q = titles.select("title").where(F.col("title").isNotNull()).distinct()
    hits = catalog.select("item_id", "title").join(q, "title", "left_semi")
    return hits.groupBy("title").agg(F.min("item_id").alias("item_id"))


def union_catalogs(*dfs: DataFrame) -> DataFrame:
    """SO-4: equal-schema catalogues stacked; ``content_type`` tells them apart."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def stage_counts(raw: DataFrame, min_votes: int = 10, min_rating: float = 0.0,
                 voted_min: int = 1) -> DataFrame:
    """A-13: rows per preparation stage from one aggregation pass (no repeated counts)."""
    agg = raw.agg(
        F.count(F.lit(1)).alias("raw"),
        F.count_if(F.col("vote_count") >= voted_min).alias("voted"),
        F.count_if((F.col("vote_count") >= min_votes) & (F.col("vote_average") > min_rating)).alias("reliable"),
        F.count_if((F.col("vote_count") >= min_votes) & (F.col("vote_average") > min_rating)
                   & F.col(_title_col(raw)).isNotNull()).alias("reliable_titled"),
    )
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("stage"), F.col(s).cast("bigint").alias("n_rows"))
        for s in ["raw", "voted", "reliable", "reliable_titled"]])))


def _title_col(df: DataFrame) -> str:
    return "title" if "title" in df.columns else "name"
