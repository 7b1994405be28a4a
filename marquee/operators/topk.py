"""Sorting, top-n and per-group top-k (T-1 ... T-8).

Global top-n is ``orderBy().limit()`` (Spark plans TakeOrderedAndProject:
each task keeps n rows, the driver merges n × tasks).  Per-group top-k is a
``row_number`` filter directly above the window so Catalyst inserts a
partial WindowGroupLimit before the shuffle: at most k rows per group leave
each task, which bounds the shuffle even when one group is huge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_content(df: DataFrame, by: str = "vote_average", n: int = 10, min_votes: int = 0,
                cols: tuple[str, ...] = ("title", "genres_str", "vote_count")) -> DataFrame:
    """T-1 / T-2: top ``n`` by ``by`` after a vote threshold; ties by ``item_id``."""
    f = df.where(F.col("vote_count") >= min_votes) if min_votes else df
    proj = ["item_id", "title", by] + [c for c in cols if c not in ("title", by)]
    return f.where(F.col(by).isNotNull()).orderBy(F.desc(by), F.asc("item_id")).limit(n).select(*proj)


def top_popular_sample(df: DataFrame, n: int = 5000, by: str = "popularity") -> DataFrame:
    """T-3: top ``n`` by popularity *before* dropping null titles (the order matters)."""
    top = df.orderBy(F.desc_nulls_last(by), F.asc("item_id")).limit(n)
    return top.dropna(subset=["title"])


def top_k_per_group(df: DataFrame, group: str | list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """T-4 / T-5 / T-8: 1-based ``rank`` within each group, first ``k`` kept."""
    groups = [group] if isinstance(group, str) else group
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def arg_best(value: str, label: str = "model", order: str = "model_order", largest: bool = True) -> Column:
    """T-7 aggregate: label of the row with the largest (smallest) value.

    Ties go to the smallest ``order`` (the first row, as ``idxmax`` does);
    rows with a null value are ignored.
    """
    v = F.col(value)
    key = F.when(v.isNotNull(), F.struct((-v if largest else v).alias("k"), F.col(order).alias("o")))
    return F.min_by(F.col(label), key)
