"""Sharding by longest processing time (operator 9).

Method.  Documents with the same text form a group that stays together.  Groups go, largest first, to the least-loaded
shard of a heap.  The heap runs on size classes: sizes with the same leading 11 bits share a class, so there are at
most about 50,000 classes at any corpus size, sizes below 2,048 are exact and larger ones within 0.1 percent.  A
class's groups are dealt in one go: full rounds by arithmetic over the shards that lie below the level they reach,
what is left over by the heap.  Which group of a class
goes where follows from a distributed numbering.

Defined results: null text counts as the empty one (size 8, crc 0) and shares its group; repeated rows are rows of
their own; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored

LEADING_BITS = 11


def longest_first(classes: list[tuple[int, int, int]], shards: int) -> np.ndarray:
    """``classes``: (class, groups, bytes).  Rows (class, first rank, shard), sorted: from that rank on the class's
    groups go to this shard."""
    load, rows = [0.0] * shards, []
    for cls, n, total in sorted(classes, reverse=True):
        mean, at_least = total / n, sorted(load)
        # Full rounds: the level that the class fills the shards below it to.  One group less each, so that rounding
        # never deals more than n; the heap would have put all of these there as well.
        level, below = 0.0, 0.0
        for m, least in enumerate(at_least, 1):
            below += least
            level = (below + total) / m
            if m == shards or level <= at_least[m]:
                break
        given = [max(0, int((level - x) // mean) - 1) for x in load]
        heap = [(load[k] + given[k] * mean, k) for k in range(shards)]
        heapq.heapify(heap)
        for _ in range(n - sum(given)):
            at, k = heapq.heappop(heap)
            given[k] += 1
            heapq.heappush(heap, (at + mean, k))
        rank = 0
        for k in range(shards):
            load[k] += given[k] * mean
            if given[k]:
                rows.append((cls, rank, k))
            rank += given[k]
    out = np.array(rows, np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def shard_documents(docs: DataFrame, shards: int = 24) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs(doc_id, text)``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = stored(docs.select(
        F.col("doc_id").cast("long"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("group")), "sized")
    groups = rows.groupBy("group").agg(F.sum("size").alias("bytes"))
    groups = stored(groups.withColumn(
        "class", F.expr(f"shiftleft(shiftright(bytes, greatest(0, cast(floor(log2(bytes)) as int) - {LEADING_BITS - 1})),"
                        f" greatest(0, cast(floor(log2(bytes)) as int) - {LEADING_BITS - 1}))")), "groups")
    classes = [(r["class"], r.n, r.total) for r in groups.groupBy("class").agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("total")).collect()]
    table = longest_first(classes, shards)

    def place(batches):
        for batch in batches:
            cls, rank = batch.column("class").to_numpy(), batch.column("rank").to_numpy()
            lo, hi = np.searchsorted(table[:, 0], cls), np.searchsorted(table[:, 0], cls, side="right")
            at = lo.copy()
            for step in range(shards):
                up = (lo + step < hi) & (table[np.minimum(lo + step, len(table) - 1), 1] <= rank)
                at = np.where(up, lo + step, at)
            yield pa.RecordBatch.from_arrays([batch.column("group"), pa.array(table[at, 2].astype(np.int32))],
                                             ["group", "shard"])

    placed = numbered(groups, ["class"], ["group"], "rank").select("group", "class", "rank").mapInArrow(
        place, "group binary, shard int")
    out = stored(rows.join(placed, "group").drop("group"), "placed")
    return numbered(out, ["shard"], ["doc_id", "text_crc32"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long"),
        F.lit(None).cast("int").alias("grown_shard"))
