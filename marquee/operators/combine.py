"""Element-wise sums of per-partition arrays, and arrays as tables."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKS = 64
LEAST_SENDERS = 8            # partitions that each send a whole array, on a cluster of fewer cores
CHUNK = 1 << 16              # numbers per row of a stored array


def sum_arrays(parts: DataFrame, blocks: int = BLOCKS) -> np.ndarray:
    """Sum of the float64 arrays (one binary column, equal lengths) of all rows.

    Arrays are cut into ``blocks`` keyed pieces and added up by key on the executors, one at a time as they stream by,
    so the driver receives one array, however many partitions there are.
    """

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                           pa.array([r[1] for r in rows], pa.binary())], ["block", "part"])

    def cut(batches):
        for batch in batches:
            for x in batch.column(0).to_pylist():
                pieces = np.array_split(np.frombuffer(x, np.float64), blocks)
                yield table([(k, p.tobytes()) for k, p in enumerate(pieces)])

    def add(batches):
        sums = {}
        for batch in batches:
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x = np.frombuffer(x, np.float64)
                sums[k] = sums[k] + x if k in sums else x
        yield table([(k, x.tobytes()) for k, x in sums.items()])

    kind = "block int, part binary"
    done = dict(parts.mapInArrow(cut, kind).repartition("block").mapInArrow(add, kind).collect())
    return np.concatenate([np.frombuffer(done[k], np.float64) for k in range(blocks)])


def sparse_batches(batches, names: tuple[str, ...] = ()):
    """(number of rows, owner of each entry, idx, val, the named columns) of each Arrow batch with ``idx`` and ``val``."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = np.nan_to_num(batch.column("idx").value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        idx = batch.column("idx").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        val = batch.column("val").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        yield n, np.repeat(np.arange(n), sizes), idx, val, [batch.column(c) for c in names]


def few_parts(rows: DataFrame) -> DataFrame:
    """``rows`` in as many partitions as there are cores at most, without a shuffle: each will send an array of a size
    that does not depend on its rows."""
    return rows.coalesce(max(LEAST_SENDERS, rows.sparkSession.sparkContext.defaultParallelism))


def gramian(rows: DataFrame, dim: int, block: int = 512) -> np.ndarray:
    """``XᵀX`` of the sparse ``rows(idx, val)``: dense blocks of ``block`` rows are multiplied in each task, and the
    tasks' upper triangles are added up by piece.  A task holds one ``dim × dim`` matrix, whatever the data."""

    def run(batches):
        g = np.zeros((dim, dim))
        for n, owner, idx, val, _ in sparse_batches(batches):
            cuts = np.searchsorted(owner, np.arange(0, n + block, block))
            for a, b in zip(cuts, cuts[1:]):
                if b > a:
                    x = np.zeros((block, dim))
                    x[owner[a:b] % block, idx[a:b]] = val[a:b]
                    g += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([g[np.triu_indices(dim)].tobytes()], pa.binary())], ["g"])

    g = np.zeros((dim, dim))
    g[np.triu_indices(dim)] = sum_arrays(few_parts(rows.select("idx", "val")).mapInArrow(run, "g binary"))
    return g + np.triu(g, 1).T


def arrays_table(spark: SparkSession, arrays: dict[str, np.ndarray]) -> DataFrame:
    """(name, shape, at, part): the arrays in rows of bounded size."""
    rows = []
    for name, x in arrays.items():
        flat = np.ascontiguousarray(x, np.float64).ravel()
        for at in range(0, max(1, flat.size), CHUNK):
            rows.append((name, [int(k) for k in np.shape(x)], at, bytearray(flat[at:at + CHUNK].tobytes())))
    return spark.createDataFrame(rows, "name string, shape array<long>, at long, part binary")


def arrays_of(table: DataFrame) -> dict[str, np.ndarray]:
    """The arrays that ``arrays_table`` stored."""
    found: dict[str, list] = {}
    for r in table.orderBy("name", "at").collect():
        found.setdefault(r["name"], [r["shape"]]).append(np.frombuffer(bytes(r["part"]), np.float64))
    return {name: np.concatenate(parts).reshape(shape) for name, (shape, *parts) in found.items()}
