"""Descriptive statistics (A-1 ... A-12).

Each operator is one aggregation job.  Scalars that feed a per-row expression
(min/max, means, standard deviations) are scalar subqueries: Spark runs them
once, inlines the value into the plan and merges subqueries over the same
table, so no 1-row cross join and no driver round trip is needed.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _scalar(df: DataFrame, expr):
    return df.select(expr).scalar()


def stats_summary(*catalogs: DataFrame) -> DataFrame:
    """A-1: items and mean rating per ``content_type`` plus an ``All`` total row (rollup)."""
    u = catalogs[0].select("content_type", "vote_average")
    for c in catalogs[1:]:
        u = u.unionByName(c.select("content_type", "vote_average"))
    return (u.rollup("content_type")
            .agg(F.count(F.lit(1)).alias("n_items"), F.avg("vote_average").alias("avg_rating"))
            .select(F.coalesce("content_type", F.lit("All")).alias("content_type"),
                    "n_items", F.round("avg_rating", 6).alias("avg_rating")))


def distinct_genres(*catalogs: DataFrame, list_col: str = "genres_list") -> DataFrame:
    """A-1 / SO-1: distinct union of the genre lists of all catalogues."""
    parts = [c.select(F.explode(list_col).alias("genre")) for c in catalogs]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return u.distinct()


def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """A-2: null count per column in one pass, unpivoted to (column_name, n_missing)."""
    cols = cols or df.columns
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("bigint").alias("n_missing")) for c in cols])))


def genre_distribution(df: DataFrame, list_col: str = "genres_list", top: int = 20) -> DataFrame:
    """A-3: explode a list column, count, keep the ``top`` most common (ties by name)."""
    counts = df.select(F.explode(list_col).alias("genre")).groupBy("genre").agg(F.count(F.lit(1)).alias("n_items"))
    return counts.orderBy(F.desc("n_items"), F.asc("genre")).limit(top)


def genre_distribution_text(df: DataFrame, text_col: str = "genres_str", top: int = 15) -> DataFrame:
    """A-4: split comma text, trim, top ``top``; blanks are dropped after the limit."""
    g = (df.where(F.col(text_col).isNotNull())
         .select(F.explode(F.split(F.col(text_col), ",")).alias("genre"))
         .select(F.trim("genre").alias("genre")))
    counts = g.groupBy("genre").agg(F.count(F.lit(1)).alias("n_items"))
    return counts.orderBy(F.desc("n_items"), F.asc("genre")).limit(top).where(F.col("genre") != "")


APPROX_ACCURACY = 1 << 13     # parts of the numbers' range that one round of the selection tells apart


def _keys(values: np.ndarray) -> np.ndarray:
    """64-bit keys that sort like the numbers (-0 as 0, NaN last)."""
    bits = (values + 0.0).view(np.int64)
    return np.where(bits < 0, ~bits, bits ^ np.int64(-2**63)).view(np.uint64)


def _value(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else ~key & (2**64 - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _order_statistics(df: DataFrame, ranks: dict[str, set[int]]) -> dict[tuple[str, int], float]:
    """Exact k-th smallest (0-based) non-null value of each double column, for every rank k asked for.

    Radix selection: a value's bits make a key that sorts like it; each round counts the next 13 bits of the keys that
    agree with a rank's bits so far.  One job per round for all columns and ranks, and five rounds whatever the data;
    tasks and driver hold counts only, at most ``APPROX_ACCURACY`` per rank.
    """
    at = {(c, k): (0, 0) for c, ks in ranks.items() for k in ks}          # key bits so far, values below them
    cols = [c for c in ranks if ranks[c]]
    told = 64
    while told and at:
        width = min(max(1, APPROX_ACCURACY.bit_length() - 1), told)
        told -= width
        heads = {c: np.array(sorted({at[c, k][0] for k in ranks[c]}), np.uint64) for c in cols}

        def count(batches, heads=heads, told=told, width=width):
            for batch in batches:
                for n, c in enumerate(cols):
                    key = _keys(batch.column(n).drop_null().to_numpy(zero_copy_only=False))
                    head = key >> np.uint64(told + width) if told + width < 64 else np.zeros(len(key), np.uint64)
                    place = np.minimum(np.searchsorted(heads[c], head), len(heads[c]) - 1)
                    digit = (key >> np.uint64(told)) & np.uint64((1 << width) - 1)
                    kept = heads[c][place] == head
                    found, many = np.unique((place[kept] << width) + digit[kept].astype(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), n, np.int32)), pa.array(found), pa.array(many)],
                                                     ["c", "d", "n"])

        rows = df.select(*cols).mapInArrow(count, "c int, d long, n long").groupBy("c", "d").agg(F.sum("n").alias("n")).collect()
        counts: dict[tuple[int, int], list] = {}
        for r in rows:
            counts.setdefault((r["c"], r["d"] >> width), []).append((r["d"] & ((1 << width) - 1), r["n"]))
        for (c, k), (head, below) in at.items():
            place = int(np.searchsorted(heads[c], np.uint64(head)))
            for digit, n in sorted(counts[cols.index(c), place]):
                if k < below + n:
                    at[c, k] = (head << width | digit, below)
                    break
                below += n
    return {x: _value(head) for x, (head, _) in at.items()}


def exact_quantiles(df: DataFrame, col: str, probs: list[float], n: int | None = None) -> tuple[int, list]:
    """The number of non-null values of a column, and their quantiles as ``column_quantiles`` has them."""
    values = df.select(F.col(col).cast("double").alias(col))
    n = values.agg(F.count(col)).first()[0] if n is None else n
    return n, column_quantiles(values, {col: probs}, {col: n})[col]


def column_quantiles(df: DataFrame, probs: dict[str, list[float]], counts: dict[str, int]) -> dict[str, list]:
    """Exact linear-interpolated quantiles (pandas / ``quantile_cont`` rule) of double columns with so many non-null
    values, by one selection for all of them."""
    places = {c: [(counts[c] - 1) * p for p in ps] if counts[c] else [] for c, ps in probs.items()}
    found = _order_statistics(df, {c: {min(int(x) + up, counts[c] - 1) for x in xs for up in ((0, 1) if x > int(x) else (0,))}
                                   for c, xs in places.items()})
    out = {}
    for c, xs in places.items():
        ends = [(found[c, int(x)], found[c, min(int(x) + (x > int(x)), counts[c] - 1)], x - int(x)) for x in xs]
        out[c] = [a + (b - a) * t for a, b, t in ends] or [None] * len(probs[c])
    return out


def rating_center(df: DataFrame, col: str = "vote_average") -> DataFrame:
    """A-5: mean and exact median (distributed radix selection)."""
    df = cut_lineage(df.select(F.col(col).cast("double").alias(col)))
    _, (med,) = exact_quantiles(df, col, [0.5])
    return df.agg(F.round(F.avg(col), 6).alias("mean_rating")) \
        .select("mean_rating", F.round(F.lit(med).cast("double"), 6).alias("median_rating"))


def histogram(df: DataFrame, col: str = "vote_average", bins: int = 20) -> DataFrame:
    """A-6: equal-width histogram over [min, max], last bin closed; every bin listed.

    ``min``/``max`` are scalar subqueries; the bin index is a column
    expression, so counting is a single partial/final aggregation.
    """
    v = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
    mn = _scalar(v, F.min("v"))
    mx = _scalar(v, F.max("v"))
    width = mx - mn
    b = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor((F.col("v") - mn) / width * bins).cast("int") + 1, F.lit(bins)))
    counts = v.select(b.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n_items"))
    spark = df.sparkSession
    grid = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin",
                    F.round(mn + (F.col("bin") - 1) * width / bins, 6).alias("lower"),
                    F.round(mn + F.col("bin") * width / bins, 6).alias("upper"),
                    F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"))
            .where(mn.isNotNull()))


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """A-7: Pearson correlation over pairwise-complete rows, long form.

    All pairs are computed in one aggregation.  ``try_divide`` gives null where
    a column is constant (pandas gives NaN); bare ``corr`` would raise under ANSI.
    """
    cols = [c for c in cols if c in df.columns]
    aggs = []
    for i, j in product(range(len(cols)), repeat=2):
        x, y = F.col(cols[i]).cast("double"), F.col(cols[j]).cast("double")
        both = x.isNotNull() & y.isNotNull()
        xs, ys = F.when(both, x), F.when(both, y)
        denom = F.stddev_pop(xs) * F.stddev_pop(ys)
        aggs.append(F.try_divide(F.covar_pop(xs, ys), F.when(denom != 0, denom)).alias(f"c_{i}_{j}"))
    wide = df.agg(*aggs)
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(cols[i]).alias("col_x"), F.lit(cols[j]).alias("col_y"),
                 F.lit(i).alias("ix"), F.lit(j).alias("iy"),
                 F.round(F.col(f"c_{i}_{j}"), 6).alias("corr"))
        for i, j in product(range(len(cols)), repeat=2)])))
    return long


def correlation_lower(df: DataFrame, cols: list[str]) -> DataFrame:
    """A-8: strictly lower triangle of the correlation matrix."""
    return correlation_matrix(df, cols).where(F.col("ix") > F.col("iy"))


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """A-9: count, mean, sample std, min, quartiles (exact, interpolated), max per column.

    Moments and extremes come from one aggregation; quartiles from the
    distributed exact selection (``column_quantiles``), never a single-task
    percentile buffer.  The number of jobs does not depend on the columns.
    """
    cols = [c for c in cols if c in df.columns]
    # The quantile rounds re-read the columns: materialise the projection once.
    df = cut_lineage(df.select(*[F.col(c).cast("double").alias(c) for c in cols]))
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    row = wide.first()
    quart = column_quantiles(df, {c: [0.25, 0.5, 0.75] for c in cols}, {c: row[f"{c}__count"] for c in cols})
    wide = df.sparkSession.createDataFrame([row], wide.schema)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"),
                 F.col(f"{c}__count").cast("bigint").alias("count"),
                 F.round(f"{c}__mean", 6).alias("mean"), F.round(f"{c}__std", 6).alias("std"),
                 F.round(f"{c}__min", 6).alias("min"),
                 *[F.round(F.lit(quart[c][i]).cast("double"), 6).alias(name)
                   for i, name in enumerate(["p25", "p50", "p75"])],
                 F.round(f"{c}__max", 6).alias("max"))
        for c in cols])))


def impute_mean(df: DataFrame, col: str = "vote_average") -> DataFrame:
    """A-10: nulls replaced by the column mean (a scalar subquery)."""
    mean = _scalar(df, F.avg(col))
    return df.withColumn(col, F.coalesce(F.col(col), mean))


def standard_scale(df: DataFrame, cols: list[str], fill: float = 0.0) -> DataFrame:
    """A-11: ``(x - mean) / std_pop`` with nulls first set to ``fill``; zero spread → divisor 1."""
    out = df
    for c in cols:
        x = F.coalesce(F.col(c).cast("double"), F.lit(fill))
        mu = _scalar(df, F.avg(x))
        sd = _scalar(df, F.stddev_pop(x))
        out = out.withColumn(c + "_scaled", (x - mu) / F.when(sd == 0, F.lit(1.0)).otherwise(sd))
    return out


def minmax_normalize(df: DataFrame, col: str, out: str | None = None, inverse: bool = False) -> DataFrame:
    """A-12: ``(x - min)/(max - min)``; constant column → 0.5; ``inverse`` gives ``1 - x``."""
    mn = _scalar(df, F.min(col))
    mx = _scalar(df, F.max(col))
    x = F.col(col).cast("double")
    norm = F.when(mx == mn, F.lit(0.5)).otherwise((x - mn) / (mx - mn))
    if inverse:
        norm = F.lit(1.0) - norm
    return df.withColumn(out or (col + ("_inv" if inverse else "_norm")), norm)
