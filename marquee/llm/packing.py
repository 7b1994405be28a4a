"""Best-fit packing of tokenised documents into sequences (operator 1).

Method.  Pieces over one third of the capacity pair at most twice per sequence: from the longest down, each takes the
longest partner that still fits (greedy matching).  Shorter pieces then go, longest first, to the sequence whose gap
they fill best.  Pieces of one length are interchangeable, so the plan is made on counts per length (at most
``capacity`` numbers, whatever the corpus); runs of equal sequences are handled together.  The plan's runs say where
the k-th piece of a length goes; each piece learns its k from a distributed numbering.  The result is the plan over
the whole corpus, not one per partition.

Defined results: null text packs as the empty text (one id 0); repeated rows are packed once each; an empty table
gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import numbered, stored

CAPACITY = 2048
SLICE = 500                  # texts encoded at a time


def texts_of(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) by slices; null texts are empty."""
    col = batch.column(batch.schema.get_field_index(column))
    for at in range(0, batch.num_rows, SLICE):
        yield at, [x or "" for x in col.slice(at, SLICE).to_pylist()]


def tokenized_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` as pieces of at most ``capacity`` ids; a document's ids end with id 0."""
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def cut(batches):
        encoder = bpe.load(path)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for at, texts in texts_of(batch):
                rows = []
                for key, ids in zip(keys[at:at + SLICE], encoder.encode(texts)):
                    ids += b"\0\0\0\0"
                    for k, lo in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[lo:lo + 4 * capacity]
                        rows.append((key, k, lo // 4, len(part) // 4, zlib.crc32(part), part))
                cols = list(zip(*rows))
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                n = 5 + with_ids
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:n], types)], names[:n])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, kind)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, offset): from that rank on, pieces of this
    length fill the sequences one after the other.  Sorted by length and rank."""
    left, rows, taken = dict(counts), [], dict.fromkeys(counts, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}            # gap -> runs of sequences (first, how many)
    n_seq = 0

    def put(length: int, first: int, per: int, offset: int, n: int) -> None:
        rows.append((length, taken[length], first, per, offset))
        taken[length] += n
        left[length] -= n

    def opened(n: int) -> int:
        nonlocal n_seq
        n_seq += n
        return n_seq - n

    big = sorted((x for x in counts if 3 * x > capacity), reverse=True)
    for a in big:
        while left[a]:
            b = next((x for x in big if x <= capacity - a and x <= a and left[x] and (x != a or left[a] > 1)), None)
            n = left[a] if b is None else left[a] // 2 if b == a else min(left[a], left[b])
            first = opened(n)
            put(a, first, 1, 0, n)
            if b is not None:
                put(b, first, 1, a, n)
            gaps.setdefault(capacity - a - (b or 0), []).append((first, n))
    for x in sorted((x for x in counts if 3 * x <= capacity), reverse=True):
        for g in range(x, capacity + 1):
            if not left[x]:
                break
            while left[x] and (g == capacity or gaps.get(g)):
                per = g // x
                if g < capacity:
                    first, n = gaps[g].pop()
                else:                                      # nothing fits any more: open what the rest needs
                    n = -(-left[x] // per)
                    first = opened(n)
                full = min(n, left[x] // per)
                if full:
                    put(x, first, per, capacity - g, full * per)
                    gaps.setdefault(g - per * x, []).append((first, full))
                rest = left[x] if full < n else 0
                if rest:
                    put(x, first + full, rest, capacity - g, rest)
                    gaps.setdefault(g - rest * x, []).append((first + full, 1))
                    full += 1
                if full < n and g < capacity:
                    gaps[g].append((first + full, n - full))
    out = np.array(rows, np.int64).reshape(-1, 5)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a stored table with ``doc_id, piece, length``) with ``sequence_id`` and ``offset``."""
    counts = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = plan(counts, capacity)                         # bounded by the capacity, not by the corpus
    ranked = numbered(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], "_rank")
    names = pieces.columns

    def place(batches):
        start = table[:, 0] << 40 | table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            at = np.searchsorted(start, length << 40 | rank, side="right") - 1
            _, first, seq, per, offset = table[at].T if len(at) else np.zeros((5, 0), np.int64)
            k = rank - first
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(seq + k // np.maximum(per, 1)),
                 pa.array(offset + k % np.maximum(per, 1) * length)], [*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.select(*names, "_rank").mapInArrow(place, kinds + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenise, cut and pack: one row per piece."""
    return pack(stored(tokenized_pieces(docs, path, capacity), "pieces"), capacity)
