"""Near-duplicate embeddings by random hyperplanes (operator 2).

Method.  ``bits`` sign bits of random projections are a bucket key; several tables draw their own projections.  Within
a bucket all cosines are computed in double precision by matrix products of blocks of at most ``BLOCK`` vectors; only
counts and one root per vector leave a block, never pairs.  A pair counts in the first table where it meets, which the
two vectors' keys tell.  Roots are edges for the distributed connected components.

``bits`` grows with the logarithm of the number of vectors so that an even bucket holds about ``BUCKET`` of them, and
the number of tables follows: a pair exactly at the threshold is missed with probability ``MISS``.  A bucket of any
size is worked off whole, in block pairs.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors
of different lengths are not compared; rows with the same vec_id are one node, their links add up and repeated equal
rows count once; a null vec_id links with nothing.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored

LEAST = 0.95
BUCKET = 256
BLOCK = 1024
MISS = 1e-4


def layout(n: int, least: float = LEAST) -> tuple[int, int]:
    """(bits, tables) for n vectors."""
    bits = min(30, max(4, math.ceil(math.log2(max(n, 1) / BUCKET))))
    meet = (1 - math.acos(least) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - meet))


@functools.lru_cache(maxsize=4)
def planes(dim: int, count: int) -> np.ndarray:
    return np.random.default_rng([2024, dim, count]).standard_normal((dim, count))


def unit(vectors: list) -> np.ndarray:
    x = np.array(vectors, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def keyed(vectors: DataFrame, bits: int, tables: int) -> DataFrame:
    """(vec_id, embedding, codes) with one bucket key per table."""
    kind = vectors.schema["embedding"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            found = batch.column(1).to_pylist()
            codes: list = [None] * len(found)
            for dim in {len(v) for v in found}:
                at = [k for k, v in enumerate(found) if len(v) == dim]
                sign = unit([found[k] for k in at]) @ planes(dim, bits * tables) > 0
                code = sign.reshape(len(at), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))
                for k, c in zip(at, code):
                    codes[k] = c
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(codes, pa.list_(pa.int64()))],
                                             ["vec_id", "embedding", "codes"])

    return vectors.mapInArrow(run, f"vec_id long, embedding {kind}, codes array<long>")


def _compare(table: int, left: dict, right: dict | None, least: float) -> list[tuple]:
    """(vec_id, links, root) of one block, or of two; pairs that met in an earlier table are left out."""
    other = right or left
    x, y = left["unit"], other["unit"]
    close = x @ y.T >= least - 1e-9
    if right is None:
        close &= np.tri(len(x), len(y), -1, dtype=bool)
    i, j = np.nonzero(close)
    if not len(i):
        return []
    fine = left["ids"][i] != other["ids"][j]
    fine &= np.einsum("ij,ij->i", x[i], y[j]) >= least
    for t in range(table):
        live = np.flatnonzero(fine)
        fine[live] = left["codes"][i[live], t] != other["codes"][j[live], t]
    a, b = left["ids"][i[fine]], other["ids"][j[fine]]
    ids, at = np.unique(np.r_[a, b], return_inverse=True)
    n, root = np.bincount(at, minlength=len(ids)), np.arange(len(ids))
    p, q = at[:len(a)], at[len(a):]
    while len(a):
        low = np.minimum(root[p], root[q])
        new = root.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return list(zip(ids.tolist(), n.tolist(), ids[root].tolist()))


def link_counts(keys: DataFrame, tables: int, least: float = LEAST) -> DataFrame:
    """(vec_id, links, root): partial counts and local roots from every bucket."""
    rows = keys.select("vec_id", F.posexplode("codes").alias("table", "code"), F.size("embedding").alias("dim"))
    blocks = rows.groupBy("table", "code", "dim").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    blocks = blocks.where("blocks > 1")
    # Members of a bucket of several blocks go to every pair of blocks that theirs is in.
    own = F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("blocks")).cast("int")
    dealt = rows.join(blocks, ["table", "code", "dim"]).withColumn("own", own).select(
        "vec_id", "table", "code", "dim", "own", F.col("blocks").cast("int").alias("blocks"))
    large = dealt.groupBy("vec_id").agg(F.collect_list(F.struct("table", "code", "dim", "own", "blocks")).alias("large"))
    rows = keys.join(large, "vec_id", "left").select(
        "vec_id", "embedding", "codes", F.posexplode("codes").alias("table", "code"), "large")
    # A vec_id may have several vectors, each with buckets of its own.
    mine = F.filter("large", lambda x: (x["table"] == F.col("table")) & (x["code"] == F.col("code"))
                    & (x["dim"] == F.size("embedding")))
    place = F.when(F.size(mine) > 0, F.transform(
        F.sequence(F.lit(0), mine[0]["blocks"] - 1), lambda k: F.struct(
            F.least(k, mine[0]["own"]).alias("i"), F.greatest(k, mine[0]["own"]).alias("j"),
            mine[0]["own"].alias("own")))).otherwise(
        F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("own"))))
    rows = rows.withColumn("p", F.explode(place)).select(
        "table", "code", F.size("embedding").alias("dim"), F.col("p.i").alias("i"), F.col("p.j").alias("j"),
        F.col("p.own").alias("own"), "vec_id", "embedding", "codes")

    def compare(group: pa.Table) -> pa.Table:
        table, i, j = (group.column(c)[0].as_py() for c in ("table", "i", "j"))
        own, sides = group.column("own").to_numpy(), []
        for side in dict.fromkeys((i, j)):
            part = group.filter(pa.array(own == side))
            if part.num_rows:
                sides.append({"ids": part.column("vec_id").to_numpy(), "unit": unit(part.column("embedding").to_pylist()),
                              "codes": np.array(part.column("codes").to_pylist(), np.int64)})
        whole = i == j
        out = _compare(table, sides[0], None if whole else sides[1], least) if len(sides) == 2 - whole else []
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("vec_id", "links", "root"), cols)})

    return rows.groupBy("table", "code", "dim", "i", "j").applyInArrow(
        compare, "vec_id long, links long, root long")


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors(vec_id, embedding)``."""
    rows = vectors.select(F.col("vec_id").cast("long"), "embedding")
    kind = rows.schema["embedding"].dataType.elementType.simpleString()
    number = (lambda x: x.cast("double")) if kind not in ("float", "double") else (lambda x: x)
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    sound = rows.where("vec_id is not null and embedding is not null").where(good).withColumn(
        "embedding", F.transform("embedding", number)).distinct()
    bits, tables = layout(sound.count(), least)
    keys = stored(keyed(sound, bits, tables), "keys")
    partial = stored(link_counts(keys, tables, least), "links")
    counts = partial.groupBy("vec_id").agg(F.sum("links").alias("n_links"))
    comp = components(partial.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    out = rows.select("vec_id").join(counts, "vec_id", "left").join(comp, F.col("vec_id") == comp.node, "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
