"""Nearest items by a predicted value (R-3, T-5, S-10).

The prediction-based recommenders (forest, ridge, MLP) rank all items by
``|prediction − prediction(query)|``.  Pairing every query with every item is
a cross product; instead:

1. Of items with equal predictions only the ``n + 1`` of smallest id can be
   among the ``n`` nearest; the others are left out (a group limit, applied
   before the shuffle too), so a hot value is no hot bucket.
2. The rest is cut at approximate quantiles into at most ``bins`` buckets of
   about equal size, whatever outliers there are.  Each bucket's smallest and
   largest prediction and its count are known (at most ``bins`` rows).
3. Per query, buckets in order of their farthest item give a distance within
   which ``n + 1`` items surely lie.  Only buckets that begin within that
   distance can hold a neighbour (with a margin for the rounding of ties).
4. Candidates come from an equi-join on the bucket id against the (query,
   bucket) table, broadcast after a row-count check.

The score is ``1 − d / (max d + eps)`` with ``max d = max(max p − t, t − min p)``.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import value_similarity
from ..session import cut_lineage
from .similarity import (MAX_BROADCAST_QUERIES, MAX_BROADCAST_ROWS, OUT_DIGITS, SCORE_DIGITS,
                         checked_broadcast)
from .topk import top_k_per_group

TIE_MARGIN = 1e-8          # distances that round alike differ by less


def nearest_by_value(preds: DataFrame, queries: DataFrame, n: int = 10, eps: float = 1e-10,
                     bins: int = 1024, value: str = "prediction",
                     max_broadcast_queries: int = MAX_BROADCAST_QUERIES) -> DataFrame:
    """(query_id, rank, item_id, similarity_score) by closeness of ``value`` (null and non-finite values take no part)."""
    p = preds.select(F.col("item_id").cast("bigint"), F.col(value).cast("double").alias("p")) \
        .where(F.col("p").isNotNull() & ~F.isnan("p") & (F.abs("p") != math.inf))
    mn = p.select(F.min("p")).scalar()
    mx = p.select(F.max("p")).scalar()
    few = cut_lineage(p.withColumn("k", F.row_number().over(Window.partitionBy("p").orderBy("item_id")))
                      .where(F.col("k") <= n + 1).drop("k"))
    cuts = few.agg(F.percentile_approx("p", [i / bins for i in range(1, bins)], 10 * bins)).first()[0]
    splits = sorted(set(cuts or [0.0]))
    pb = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol="p", outputCol="b").transform(few)
    spans = (pb.groupBy("b").agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.count(F.lit(1)).alias("cnt"))
             .agg(F.collect_list(F.struct("b", "lo", "hi", "cnt"))).scalar())

    q = queries.select(F.col("query_id").cast("bigint")).distinct()
    qb, _ = checked_broadcast(q, max_broadcast_queries)
    qt = p.join(qb, p.item_id == F.col("query_id")).select("query_id", F.col("p").alias("t"))

    t = F.col("t")
    grid = (qt.select("query_id", "t", F.inline(spans))
            .withColumn("reach", F.greatest(F.abs(F.col("lo") - t), F.abs(F.col("hi") - t)))
            .withColumn("gap", F.greatest(F.col("lo") - t, t - F.col("hi"), F.lit(0.0))))
    by_reach = Window.partitionBy("query_id").orderBy("reach", "b").rowsBetween(Window.unboundedPreceding, 0)
    enough = F.min(F.when(F.col("held") >= n + 1, F.col("reach"))).over(Window.partitionBy("query_id"))
    qbuckets = (grid.withColumn("held", F.sum("cnt").over(by_reach)).withColumn("within", enough)
                .where(F.col("within").isNull() | (F.col("gap") <= F.col("within") + TIE_MARGIN))
                .select("query_id", "t", "b"))
    # At most queries × bins rows; materialised, then broadcast only if small.
    qbuckets, _ = checked_broadcast(cut_lineage(qbuckets), MAX_BROADCAST_ROWS)

    cands = (pb.join(qbuckets, "b")
             .where(F.col("item_id") != F.col("query_id"))
             .select("query_id", "item_id", "t", F.abs(F.col("p") - F.col("t")).alias("d")))
    order = [F.asc(F.round("d", SCORE_DIGITS)), F.asc("item_id")]
    top = top_k_per_group(cands, "query_id", order, n)
    maxd = F.greatest(mx - F.col("t"), F.col("t") - mn)
    return top.select("query_id", F.col("rank").cast("int").alias("rank"), "item_id",
                      F.round(value_similarity(F.col("d"), maxd, eps), OUT_DIGITS).alias("similarity_score"))
