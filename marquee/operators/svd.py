"""Truncated, uncentred SVD of the TF-IDF matrix (R-7, R-8).

Up to ``DIRECT`` vocabulary terms, one distributed pass builds the Gramian
``XᵀX`` (dense blocks of rows are multiplied in each task, the partial matrices
summed by piece) and ``numpy.linalg.eigh`` on the driver gives the right
singular vectors ``V`` and ``σ² = λ``.

Beyond that no task holds a vocabulary × vocabulary matrix: a randomised range
finder works on the row space.  From a random vocabulary × (k + 10) basis each
pass computes ``Xᵀ(X·basis)``, block by block, and the driver orthonormalises
the sum; ``PASSES`` power steps later the small matrix ``(X·basis)ᵀ(X·basis)``
gives ``V`` and ``σ`` within the basis.

Item factors ``X·V_k`` (rows of ``UΣ``, what the reference's transformer
returns) are computed per partition with ``V_k`` broadcast once.  Explained
variance (uncentred SVD, population variances as the reference's library
reports): ``Σ_k var(z_k) / Σ_j var(x_j)``, from ``λ``, the squares and the
column sums, so no extra pass over the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .combine import few_parts, gramian, sparse_batches, sum_arrays
from .tfidf import TfidfModel

DIRECT = 4096                # largest vocabulary whose Gramian is built
EXTRA, PASSES = 10, 6        # of the range finder: more columns than components, power steps
BLOCK = 512                  # rows made dense at once


@dataclass
class SvdModel:
    factors: DataFrame          # item_id, vec array<double> (length k)
    singular_values: np.ndarray
    explained_variance_ratio: float
    n_components: int
    basis: np.ndarray           # vocabulary × k, rows by term_index


def sparse_rows(model: TfidfModel, weights: DataFrame | None = None) -> DataFrame:
    """(item_id, idx, val) per item of the model's weights (clustered by item) or of others under its vocabulary."""
    if weights is None and model.rows is not None:
        return model.rows.select("item_id", "idx", "val")
    w = (model.weights if weights is None else weights).join(F.broadcast(model.vocab.select("term", "term_index")), "term")
    e = w.groupBy("item_id").agg(F.sort_array(F.collect_list(F.struct("term_index", "weight"))).alias("e"))
    return e.select("item_id", F.col("e.term_index").alias("idx"), F.col("e.weight").alias("val"))


def stored_rows(model: TfidfModel) -> DataFrame:
    """``sparse_rows`` of the model, read from its own if they are stored, else written once."""
    return sparse_rows(model) if model.rows is not None else cut_lineage(sparse_rows(model))


def _project_fn(bvk, k: int):
    def fn(batches):
        vk = bvk.value
        for pdf in batches:
            out = []
            for idx, val in zip(pdf["idx"], pdf["val"]):
                if idx is None or len(idx) == 0:
                    out.append(np.zeros(k))
                else:
                    out.append(np.asarray(val, dtype=np.float64) @ vk[np.asarray(idx, dtype=np.int64)])
            yield pd.DataFrame({"item_id": pdf["item_id"].to_numpy(), "vec": out})
    return fn


def _through(rows: DataFrame, basis: np.ndarray, inner: bool) -> np.ndarray:
    """``Xᵀ(X·basis)``, or with ``inner`` ``(X·basis)ᵀ(X·basis)``: a task holds matrices of the basis's size."""
    told = rows.sparkSession.sparkContext.broadcast(basis)
    dim, k = basis.shape

    def run(batches):
        basis = told.value
        out = np.zeros((k, k) if inner else (dim, k))
        step = max(1, min(BLOCK, (1 << 23) // dim))
        for n, owner, idx, val, _ in sparse_batches(batches):
            cuts = np.searchsorted(owner, np.arange(0, n + step, step))
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    x = np.zeros((step, dim))
                    x[owner[a:b] % step, idx[a:b]] = val[a:b]
                    y = x @ basis
                    out += y.T @ y if inner else x.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], ["g"])

    out = sum_arrays(few_parts(rows.select("idx", "val")).mapInArrow(run, "g binary"))
    told.unpersist()
    return out.reshape((k, k) if inner else (dim, k))


def right_vectors(rows: DataFrame, dim: int, k: int, direct: int = DIRECT, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(λ, V): the ``k`` largest eigenvalues of ``XᵀX``, descending, and their vectors, from ``rows(idx, val)``."""
    if dim <= direct:
        g, basis = gramian(rows, dim), None
    else:
        width = min(dim, k + EXTRA)
        basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, width)))[0]
        for _ in range(PASSES):
            basis = np.linalg.qr(_through(rows, basis, False))[0]
        g = _through(rows, basis, True)
    lam, vec = np.linalg.eigh(g)
    order = np.argsort(lam)[::-1][:k]
    vec = vec[:, order] if basis is None else basis @ vec[:, order]
    return np.clip(lam[order], 0.0, None), vec


def fit_svd(model: TfidfModel, n_components: int = 100, direct: int = DIRECT) -> SvdModel:
    if not model.max_features:
        raise ValueError("SVD needs a bounded vocabulary (max_features): its basis is vocabulary × components")
    dim = model.vocab.count()
    rows = stored_rows(model)                        # for the passes and the projection
    lam_k, v_k = right_vectors(rows, dim, min(n_components, dim), direct)
    k = v_k.shape[1]

    # Column sums (bounded by the vocabulary) and the row count for the variances.
    cs = (model.weights.groupBy("term").agg(F.sum("weight").alias("s"), F.sum(F.col("weight") ** 2).alias("ss"))
          .join(model.vocab.select("term", "term_index"), "term").select("term_index", "s", "ss").collect())
    colsum, squares = np.zeros(dim), 0.0
    for r in cs:
        colsum[r["term_index"]] = r["s"]
        squares += r["ss"]
    n = model.item_norms.count()
    mean_z = (colsum @ v_k) / n
    var_z = lam_k / n - mean_z ** 2
    total_var = squares / n - np.sum((colsum / n) ** 2)
    ratio = float(var_z.sum() / total_var) if total_var > 0 else 0.0

    return SvdModel(factors=project(model.item_norms.select("item_id"), rows, v_k), singular_values=np.sqrt(lam_k),
                    explained_variance_ratio=ratio, n_components=k, basis=v_k)


def project(ids: DataFrame, rows: DataFrame, basis: np.ndarray) -> DataFrame:
    """(item_id, vec) of every id: its sparse row (item_id, idx, val), if it has one, times the basis."""
    b = ids.sparkSession.sparkContext.broadcast(basis)
    full = ids.join(rows, "item_id", "left").select("item_id", "idx", "val")
    return full.mapInPandas(_project_fn(b, basis.shape[1]), "item_id long, vec array<double>")
