"""Ridge regression on text weights and numeric columns (R-6, F-3), sparse throughout.

``‖y − Xw − b‖² + α‖w‖²`` with an unpenalised intercept.  Text weights enter as they are, numeric columns scaled by mean
and population deviation (null is 0), all as one sparse row per item.  Up to ``DIRECT`` columns one pass gives the
Gramian of ``[X, y, 1]`` and the driver solves the normal equations (a matrix sized by the vocabulary, not the data);
beyond that, conjugate gradients with one pass over the rows per step, which hold one vector per task.

The fitted model keeps its coefficients by feature name, so that it can be shown, stored and applied to new items.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_partitions
from .combine import gramian, sparse_batches, sum_arrays

DIRECT = 4096
TOLERANCE = 1e-12
STEPS = 1000


@dataclass
class RidgeModel:
    intercept: float
    numeric: list[tuple[str, float, float, float]]     # column, mean, deviation, coefficient
    terms: DataFrame | None = None                     # term, feature, coefficient; one row per vocabulary term

    def predict(self, items: DataFrame, weights: DataFrame | None) -> DataFrame:
        """(item_id, prediction) of every item, with its text weights in ``weights(item_id, term, weight)``."""
        told = F.lit(self.intercept)
        for c, mean, sd, w in self.numeric:
            told = told + (number(items, c) - F.lit(mean)) / F.lit(sd) * F.lit(w)
        base = items.select("item_id", told.alias("told"))
        if self.terms is None or weights is None:
            return base.select("item_id", F.col("told").alias("prediction"))
        text = (weights.join(F.broadcast(self.terms.select("term", "coefficient")), "term")
                .groupBy("item_id").agg(F.sum(F.col("weight") * F.col("coefficient")).alias("text")))
        return base.join(text, "item_id", "left").select(
            "item_id", (F.col("told") + F.coalesce("text", F.lit(0.0))).alias("prediction"))

    def coefficients(self, spark: SparkSession) -> DataFrame:
        """(feature, coefficient) of the intercept, the scaled numeric columns and the terms."""
        rows = [("(intercept)", self.intercept)] + [(c, w) for c, _, _, w in self.numeric]
        out = spark.createDataFrame(rows, "feature string, coefficient double")
        if self.terms is not None:
            out = out.unionByName(self.terms.select(F.col("term").alias("feature"), "coefficient"))
        return out


def number(df: DataFrame, col: str) -> Column:
    """A numeric column, null and missing as 0."""
    return F.coalesce(F.col(col).cast("double"), F.lit(0.0)) if col in df.columns else F.lit(0.0)


def scales(df: DataFrame, cols: list[str]) -> list[tuple[str, float, float]]:
    """(column, mean, population deviation, 1 where there is no spread), by one aggregation."""
    if not cols:
        return []
    row = df.agg(*(f(number(df, c)).alias(f"{k}{j}") for j, c in enumerate(cols)
                   for k, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    return [(c, row[f"m{j}"] or 0.0, row[f"s{j}"] or 1.0) for j, c in enumerate(cols)]


def sparse_inputs(items: DataFrame, label: Column, scaled: list[tuple[str, float, float]], n_text: int,
                  weights: DataFrame | None, vocab: DataFrame | None) -> DataFrame:
    """(item_id, idx, val, label) of every item: its terms, then the scaled numeric columns."""
    own = [(number(items, c) - F.lit(m)) / F.lit(s) for c, m, s in scaled]
    none = "array<double>"
    base = items.select("item_id", label.alias("label"), F.array(*own).cast(none).alias("own"))
    places = F.array(*(F.lit(n_text + k) for k in range(len(scaled)))).cast("array<int>")
    if weights is None:
        return base.select("item_id", places.alias("idx"), F.col("own").alias("val"), "label")
    text = (weights.join(F.broadcast(vocab.select("term", "term_index")), "term").groupBy("item_id")
            .agg(F.collect_list(F.struct("term_index", "weight")).alias("e")))
    j = base.join(text, "item_id", "left").withColumn("e", F.coalesce("e", F.array().cast("array<struct<term_index:int,weight:double>>")))
    return j.select("item_id", F.concat(F.col("e.term_index"), places).alias("idx"),
                    F.concat(F.col("e.weight"), "own").alias("val"), "label")


def _direct(rows: DataFrame, dim: int, alpha: float) -> tuple[np.ndarray, float]:
    g = gramian(rows.select(F.concat("idx", F.array(F.lit(dim), F.lit(dim + 1))).alias("idx"),
                            F.concat("val", F.array(F.col("label"), F.lit(1.0))).alias("val")), dim + 2)
    n = g[-1, -1]
    mean = g[:-1, -1] / n
    centred = g[:-1, :-1] - n * np.outer(mean, mean)
    w = np.linalg.solve(centred[:-1, :-1] + alpha * np.eye(dim), centred[:-1, -1])
    return w, float(mean[-1] - mean[:-1] @ w)


def _pass(rows: DataFrame, dim: int, p: np.ndarray | None) -> np.ndarray:
    """``Xᵀ(Xp)``, or with no ``p`` the column sums, ``Xᵀy``, Σy and the number of rows."""
    told = rows.sparkSession.sparkContext.broadcast(p)

    def run(batches):
        p = told.value
        out = np.zeros(dim if p is not None else 2 * dim + 2)
        for n, owner, idx, val, (y,) in sparse_batches(batches, ("label",)):
            if p is not None:
                dots = np.bincount(owner, val * p[idx], n)
                out += np.bincount(idx, val * dots[owner], dim)
            else:
                y = y.to_numpy(zero_copy_only=False)
                out += np.r_[np.bincount(idx, val, dim), np.bincount(idx, val * y[owner], dim), y.sum(), n]
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["g"])

    out = sum_arrays(rows.select("idx", "val", "label").mapInArrow(run, "g binary"))
    told.unpersist()
    return out


def _conjugate_gradients(rows: DataFrame, dim: int, alpha: float) -> tuple[np.ndarray, float]:
    sums = _pass(rows, dim, None)
    n, mean, y = sums[-1], sums[:dim] / sums[-1], sums[-2] / sums[-1]
    r = sums[dim:2 * dim] - n * mean * y
    w, p, rr = np.zeros(dim), r.copy(), float(r @ r)
    stop = TOLERANCE ** 2 * max(rr, 1e-300)
    for _ in range(STEPS):
        if rr <= stop:
            break
        q = _pass(rows, dim, p) - n * mean * (mean @ p) + alpha * p
        step = rr / float(p @ q)
        w, r = w + step * p, r - step * q
        rr, before = float(r @ r), rr
        p = r + rr / before * p
    return w, float(y - mean @ w)


def fit_sparse(rows: DataFrame, dim: int, alpha: float = 1.0, direct: int = DIRECT) -> tuple[np.ndarray, float]:
    """Coefficients and intercept from ``rows(idx, val, label)``."""
    if not dim or not rows.take(1):
        return np.zeros(dim), 0.0
    return (_direct if dim <= direct else _conjugate_gradients)(rows, dim, alpha)


def fit_item_ridge(items: DataFrame, tfidf, numeric: list[str], label: Column, alpha: float = 1.0,
                   direct: int = DIRECT) -> RidgeModel:
    """Ridge on the items' text weights (``tfidf``, may be None) and numeric columns."""
    spark = items.sparkSession
    scaled = scales(items, [c for c in numeric if c in items.columns])
    vocab = tfidf.vocab if tfidf is not None else None
    n_text = vocab.count() if vocab is not None else 0
    rows = sparse_inputs(items, label, scaled, n_text, tfidf.weights if tfidf is not None else None, vocab)
    rows = cut_lineage(rows.repartition(shuffle_partitions(spark), "item_id"))
    w, b = fit_sparse(rows, n_text + len(scaled), alpha, direct)
    terms = None
    if vocab is not None:
        coefficient = spark.createDataFrame([(k, float(x)) for k, x in enumerate(w[:n_text])],
                                            "feature int, coefficient double")
        terms = cut_lineage(vocab.select("term", F.col("term_index").alias("feature")).join(coefficient, "feature")
                            .select("term", "feature", "coefficient"))
    return RidgeModel(b, [(c, m, s, float(x)) for (c, m, s), x in zip(scaled, w[n_text:])], terms)
