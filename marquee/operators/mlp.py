"""Multi-layer perceptron regressor (R-9), trained data-parallel on Spark.

Spark ML has no MLP *regressor*.  Training is model averaging: each epoch is
one Spark job in which every partition runs minibatch Adam over its rows,
starting from the broadcast parameters and moments; partition results are
weighted by row count and summed by block (so the driver receives one
parameter vector, whatever the partition count).  Every partition sends three
vectors of the network's size each epoch, so there are about as many as the
cluster has cores, however many the session's shuffles have.  A fixed 10 %
of items (by hash of ``item_id``) is held out for early stopping on R².

Network: ReLU hidden layers, identity output, squared loss with L2 penalty,
Adam (lr 1e-3, β 0.9/0.999), minibatches of 200, Glorot-uniform start; the
best parameters by validation score are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, free_written, shuffle_partitions
from .combine import sparse_batches, sum_arrays

LEAST_TRAINERS = 8           # partitions that train side by side, on a cluster of fewer cores


def _shapes(n_in: int, hidden: tuple[int, ...]) -> list[tuple[int, int]]:
    sizes = [n_in, *hidden, 1]
    return [(sizes[i], sizes[i + 1]) for i in range(len(sizes) - 1)]


def _unpack(flat: np.ndarray, shapes):
    out, pos = [], 0
    for a, b in shapes:
        w = flat[pos:pos + a * b].reshape(a, b)
        pos += a * b
        bias = flat[pos:pos + b]
        pos += b
        out.append((w, bias))
    return out


def _init(shapes, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = []
    for a, b in shapes:
        bound = np.sqrt(6.0 / (a + b))
        parts += [rng.uniform(-bound, bound, a * b), rng.uniform(-bound, bound, b)]
    return np.concatenate(parts)


def _forward(layers, x):
    acts = [x]
    for i, (w, b) in enumerate(layers):
        z = acts[-1] @ w + b
        acts.append(np.maximum(z, 0.0) if i < len(layers) - 1 else z)
    return acts


def _grad(layers, x, y, alpha, out):
    """Fills ``out``, shaped like ``layers``."""
    acts = _forward(layers, x)
    n = len(y)
    delta = (acts[-1][:, 0] - y)[:, None] / n
    for i in range(len(layers) - 1, -1, -1):
        w, _ = layers[i]
        gw, gb = out[i]
        np.matmul(acts[i].T, delta, out=gw)
        gw += alpha * w / n
        delta.sum(axis=0, out=gb)
        if i > 0:
            delta = (delta @ w.T) * (acts[i] > 0)


def _packed(batches):
    """Each Arrow batch as one value, so that an epoch reads it as it is, without converting its rows again."""
    for batch in batches:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as out:
            out.write_batch(batch)
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["rows"])


def _unpacked(batches):
    """The Arrow batches that ``_packed`` made values of."""
    for batch in batches:
        for value in batch.column(0):
            yield from pa.ipc.open_stream(value.as_buffer())


def _sparse(batches):
    """``idx`` and ``val`` of the batches that ``_packed`` made values of."""
    for batch in _unpacked(batches):
        yield batch.select(["idx", "val"])


def _dense(pdf, dim):
    """Densify one batch of sparse rows (idx, val) — only inside the task."""
    x = np.zeros((len(pdf), dim))
    for r, (idx, val) in enumerate(zip(pdf["idx"], pdf["val"])):
        if idx is not None and len(idx):
            x[r, np.asarray(idx, dtype=np.int64)] = np.asarray(val, dtype=np.float64)
    return x


def _rows(batch, dim: int, mu, sd):
    """Number of rows, and a function that makes some of them dense and scaled."""
    n, owner, idx, val, _ = batch
    ends = np.searchsorted(owner, np.arange(n + 1))

    def dense(some):
        sizes = ends[some + 1] - ends[some]
        x = np.zeros((len(some), dim))
        at = np.repeat(ends[some] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        x[np.repeat(np.arange(len(some)), sizes), idx[at]] = val[at]
        x -= mu
        x /= sd
        return x

    return n, dense


def _epoch_fn(bstate, shapes, mu, sd, lr, batch, alpha, epoch, seed):
    b1, b2, eps = 0.9, 0.999, 1e-8

    def fn(batches):
        theta, m, v, t = bstate.value
        theta, m, v = theta.copy(), m.copy(), v.copy()
        layers0, layers = _unpack(bstate.value[0], shapes), _unpack(theta, shapes)
        g, step = np.zeros_like(theta), np.zeros_like(theta)
        grads = _unpack(g, shapes)
        n_tr = 0
        sse_val = 0.0
        sy = sy2 = 0.0
        n_val = 0
        rng = np.random.default_rng([seed, epoch, TaskContext.get().partitionId()])
        for found in sparse_batches(_unpacked(batches), ("label", "is_val")):
            _, dense = _rows(found, len(mu), mu, sd)
            label, val = (c.to_numpy(zero_copy_only=False) for c in found[-1])
            val = val.astype(bool)
            if val.any():
                yv = label[val]
                pv = _forward(layers0, dense(np.flatnonzero(val)))[-1][:, 0]
                sse_val += float(((pv - yv) ** 2).sum())
                sy += float(yv.sum())
                sy2 += float((yv ** 2).sum())
                n_val += len(yv)
            tr = np.flatnonzero(~val)
            order = rng.permutation(len(tr)) if len(tr) else tr
            for s in range(0, len(tr), batch):
                some = tr[order[s:s + batch]]
                _grad(layers, dense(some), label[some], alpha, grads)
                t += 1
                m *= b1
                m += np.multiply(g, 1 - b1, out=step)
                v *= b2
                v += np.multiply(np.multiply(g, 1 - b2, out=step), g, out=step)
                lr_t = lr * np.sqrt(1 - b2 ** t) / (1 - b1 ** t)
                np.sqrt(v, out=step)
                step += eps
                np.divide(np.multiply(m, lr_t, out=g), step, out=step)
                theta -= step
            n_tr += len(tr)
        blob = np.concatenate([theta * n_tr, m * n_tr, v * n_tr,
                               [n_tr, t * n_tr, sse_val, sy, sy2, n_val]])
        yield pa.RecordBatch.from_arrays([pa.array([blob.tobytes()], pa.binary())], ["blob"])
    return fn


def column_scaler(data: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Population mean / std per input column from the sparse rows (one
    aggregation keyed by column index, bounded by ``dim``); zero spread → 1."""
    n = data.count()
    e = data.select(F.explode(F.arrays_zip("idx", "val")).alias("e"))
    agg = e.groupBy(F.col("e.idx").alias("j")).agg(F.sum("e.val").alias("s"), F.sum(F.col("e.val") ** 2).alias("ss"))
    s1, s2 = np.zeros(dim), np.zeros(dim)
    for r in agg.collect():
        s1[r["j"]], s2[r["j"]] = r["s"], r["ss"]
    mu = s1 / max(n, 1)
    sd = np.sqrt(np.maximum(s2 / max(n, 1) - mu * mu, 0.0))
    sd[sd == 0] = 1.0
    return mu, sd


def fit_mlp(data: DataFrame, dim: int, hidden: tuple[int, ...] = (256, 128, 64), max_iter: int = 200,
            lr: float = 1e-3, batch: int = 200, alpha: float = 1e-4, validation_fraction: float = 0.1,
            n_iter_no_change: int = 10, tol: float = 1e-4, seed: int = 42):
    """Fit on sparse rows ``data(item_id, idx array<int>, val array<double>, label double)``.

    Returns (params, shapes, mu, sd, validation scores).  Inputs stay sparse in
    storage and shuffles; each task densifies one Arrow batch at a time.
    """
    spark = data.sparkSession
    buckets = int(round(1 / validation_fraction))
    d = data.withColumn("is_val", (F.pmod(F.xxhash64("item_id", F.lit(seed)), F.lit(buckets)) == 0))
    # Sorted: a recomputed partition sees its rows in the same order and trains the same model.
    trainers = min(shuffle_partitions(spark), max(LEAST_TRAINERS, spark.sparkContext.defaultParallelism))
    d = d.repartition(trainers, "item_id").sortWithinPartitions("item_id")
    rows = cut_lineage(d.select("idx", "val", F.col("label").cast("double").alias("label"), "is_val")
                       .mapInArrow(_packed, "rows binary"))
    free_written(spark)
    mu, sd = column_scaler(rows.mapInArrow(_sparse, "idx array<int>, val array<double>"), dim)
    shapes = _shapes(dim, hidden)
    theta = _init(shapes, seed)
    m = np.zeros_like(theta)
    v = np.zeros_like(theta)
    t = 0
    p = theta.size
    best, best_theta, stall, history = -np.inf, theta.copy(), 0, []
    for epoch in range(max_iter + 1):
        b = spark.sparkContext.broadcast((theta, m, v, t))
        out = rows.mapInArrow(_epoch_fn(b, shapes, mu, sd, lr, batch, alpha, epoch, seed), "blob binary")
        tot = sum_arrays(out)
        b.unpersist()
        n_tr = tot[3 * p]
        sse, sy, sy2, n_val = tot[3 * p + 2:3 * p + 6]
        # Validation score of the parameters that entered this epoch.
        if n_val > 0:
            ss_tot = sy2 - sy * sy / n_val
            score = 1.0 - sse / ss_tot if ss_tot > 0 else 0.0
            history.append(score)
            if score > best + tol:
                best, best_theta, stall = score, theta.copy(), 0
            else:
                stall += 1
                if stall >= n_iter_no_change:
                    break
        if epoch == max_iter or n_tr == 0:
            break
        theta, m, v = tot[:p] / n_tr, tot[p:2 * p] / n_tr, tot[2 * p:3 * p] / n_tr
        t = int(round(tot[3 * p + 1] / n_tr))
    if not history:
        best_theta = theta
    return best_theta, shapes, mu, sd, history


def _predict_fn(bparams, shapes, mu, sd):
    def fn(batches):
        layers = _unpack(bparams.value, shapes)
        for pdf in batches:
            if pdf.empty:
                continue
            x = (_dense(pdf, len(mu)) - mu) / sd
            yield pd.DataFrame({"item_id": pdf["item_id"].to_numpy(), "prediction": _forward(layers, x)[-1][:, 0]})
    return fn


def mlp_predictions(data: DataFrame, fitted) -> DataFrame:
    theta, shapes, mu, sd, _ = fitted
    b = data.sparkSession.sparkContext.broadcast(theta)
    return data.select("item_id", "idx", "val").mapInPandas(_predict_fn(b, shapes, mu, sd),
                                                            "item_id long, prediction double")
