"""Near-duplicate documents by one-permutation hashing (operator 7).

Method.  A document's set holds the hashes of its distinct word shingles.  One permutation hash deals the set to
``BINS`` bins and keeps each bin's least value; an empty bin takes the value of the first filled bin in an order drawn
for it (optimal densification).  ``BANDS`` bands of ``ROWS`` bins give buckets.  Documents with equal sets are one
class, whatever their number.  In a bucket each class is joined to a few centres drawn from the bucket (stars).  Pairs
whose signatures agree in too few bins are left out, with a margin of over four standard deviations; the others are
confirmed on full sets.  Links form components.  The second round takes the buckets that still hold
several components and compares their members across them, by blocks: first by signatures, then by sketches, each the
``SKETCH`` least hashes of a set, which for most sets is the whole set.  What a block finds to be linked leaves it as a
forest, at most one edge a member; only pairs of longer sets that are near the threshold are emitted one by one.

At a similarity of 0.8 two documents miss each other in all bands with probability 5e-5.  Hashes of words and shingles
have 64 bits, set fingerprints 128.

Defined results: null text and text without words have an empty set and link with nothing; rows with the same doc_id
are one document for linking, each returned; other columns do not matter.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, stored
from .words import hashed_texts, mix, slices

WORDS = 4
PERCENT = 80
BINS, BANDS, ROWS = 128, 25, 5
CENTRES = 3                  # per bucket, in the first round
BLOCK = 1024                 # members of a bucket compared at once in the second round
AGREE = 0.64                 # least share of equal bins of a pair that is worth the exact test
SKETCH = 512                 # least hashes of a set that the second round compares; smaller sets are whole
LOOSE = 8                    # points below ``percent`` at which sketches of longer sets still pass, over four deviations


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z lower-cased; shorter texts are one shingle."""
    h, at = hashed_texts([x.lower() for x in texts])
    weights = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    n = max(0, len(h) - words + 1)
    windows = mix(sum((h[k:k + n] * weights[k] for k in range(words)), np.zeros(n, np.uint64)))
    out = []
    for a, b in zip(at.tolist(), at[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(windows[a:b - words + 1]))
        else:
            out.append(mix((h[a:b] * weights[:b - a]).sum(keepdims=True) + np.uint64(b - a)) if b > a
                       else np.zeros(0, np.uint64))
    return out


@functools.lru_cache(maxsize=1)
def _layout() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower edges of the bins, the order in which each bin looks for a filled one, weights of the band hash."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - (BINS - 1).bit_length())
    draws = mix(np.arange(BINS * BINS, dtype=np.uint64) + np.uint64(12345)).reshape(BINS, BINS)
    weights = mix(np.arange(BANDS * ROWS, dtype=np.uint64) + np.uint64(777)) | np.uint64(1)
    return edges, np.argsort(draws, axis=1), weights.reshape(BANDS, ROWS)


def signature(s: np.ndarray) -> np.ndarray:
    """The densified least values of a sorted, non-empty set."""
    edges, order, _ = _layout()
    first = np.searchsorted(s, edges)
    filled = np.diff(np.r_[first, len(s)]) > 0
    sig = s[np.minimum(first, len(s) - 1)]
    if not filled.all():
        empty = np.flatnonzero(~filled)
        donor = order[empty, filled[order[empty]].argmax(axis=1)]
        sig[empty] = sig[donor]
    return sig


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, n_shingles, f1, f2`` (set fingerprint), ``bands`` and ``sig`` (one byte per bin) of every row."""

    def run(batches):
        weights = _layout()[2]
        for batch in batches:
            keys = batch.column(0)
            for at, texts in slices(batch.column(1).to_pylist()):
                rows = []
                for s in shingle_sets(texts, words):
                    if not len(s):
                        rows.append((0, 0, 0, [], b""))
                        continue
                    sig = signature(s)
                    bands = mix((sig[:BANDS * ROWS].reshape(BANDS, ROWS) * weights).sum(axis=1)).astype(np.int64)
                    f1, f2 = mix(s ^ np.uint64(1)).sum(), mix(s + np.uint64(2)).sum()
                    rows.append((len(s), f1.astype(np.int64), f2.astype(np.int64), bands,
                                 mix(sig).astype(np.uint8).tobytes()))
                n, f1, f2, bands, sig = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, len(rows)), pa.array(n, pa.int64()), pa.array(f1, pa.int64()),
                     pa.array(f2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sig, pa.binary())],
                    ["doc_id", "n_shingles", "f1", "f2", "bands", "sig"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, sig binary")


def candidate_pairs(classes: DataFrame, centres: int) -> DataFrame:
    """Star edges (a, b), a < b, between different components of ``classes(id, component, bands)``, each pair once.

    A centre is the member whose id is least after flipping the bits of a hash of the bucket (another one for each
    centre): found by a combining minimum, without bringing the bucket together.
    """
    members = classes.select("id", "component", F.explode("bands").alias("bucket"))
    masks = [F.shiftrightunsigned(F.xxhash64("bucket", F.lit(0), F.lit(k)), 2) for k in range(centres)]
    drawn = members.groupBy("bucket").agg(
        F.min("component").alias("_lo"), F.max("component").alias("_hi"),
        *(F.min(F.struct(F.col("id").bitwiseXOR(m).alias("x"), "component")).alias(f"_c{k}")
          for k, m in enumerate(masks))).where("_lo < _hi")
    drawn = drawn.select("bucket", F.array_distinct(F.array(*(
        F.struct(F.col(f"_c{k}.x").bitwiseXOR(m).alias("id"), F.col(f"_c{k}.component").alias("component"))
        for k, m in enumerate(masks)))).alias("centres"))
    edges = members.join(drawn, "bucket").select("id", "component", F.explode("centres").alias("c"))
    return edges.where("component != c.component").select(
        F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b")).distinct()


def star_pairs(classes: DataFrame, percent: int = PERCENT, centres: int = CENTRES) -> DataFrame:
    """Pairs (a, b) of the stars that agree in enough bins; ``classes`` has ``id, component, n_shingles, bands, sig``,
    id a doc_id."""
    sig = classes.select("id", "sig", "n_shingles")
    pairs = candidate_pairs(classes, centres)
    for side in "ab":
        pairs = pairs.join(sig.select(F.col("id").alias(side), F.col("sig").alias("s" + side),
                                      F.col("n_shingles").alias("n" + side)), side)
    pairs = pairs.where(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")

    def agreeing(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, BINS)
                        for c in ("sa", "sb"))
                keep = pa.array((x == y).mean(axis=1) >= AGREE)
                yield batch.select(["a", "b"]).filter(keep)

    return pairs.select("a", "b", "sa", "sb").mapInArrow(agreeing, "a long, b long")


def compared(sketches: list[np.ndarray], x: np.ndarray, y: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Whether sketches ``x[i]`` and ``y[i]`` reach ``percent``, and whether that is certain.

    Below the lesser of two last values both sets are fully known, so their similarity there is exact for whole sets
    and an estimate from at least ``SKETCH`` hashes otherwise.
    """
    sizes = np.array([len(s) for s in sketches], np.int64)
    values, ranks = np.unique(np.concatenate(sketches), return_inverse=True)
    ends = len(values)
    table = np.full((len(sketches), SKETCH), ends + 1, np.int32)
    table[np.arange(SKETCH) < sizes[:, None]] = ranks
    last = np.where(sizes < SKETCH, ends, table[:, -1])
    marked = np.zeros(ends + 2, bool)
    near, sure = np.zeros(len(x), bool), np.zeros(len(x), bool)
    order = np.argsort(x, kind="stable")
    for pairs in np.split(order, np.flatnonzero(np.diff(x[order])) + 1):
        own = table[x[pairs[0]], :sizes[x[pairs[0]]]]
        marked[own] = True
        for at in range(0, len(pairs), BLOCK):
            some = pairs[at:at + BLOCK]
            theirs, cut = table[y[some]], np.minimum(last[x[some]], last[y[some]])
            common = marked[theirs].sum(axis=1)
            union = np.searchsorted(own, cut, "right") + (theirs <= cut[:, None]).sum(axis=1) - common
            sure[some] = cut == ends
            near[some] = 100 * common >= np.where(sure[some], percent, percent - LOOSE) * union
        marked[own] = False
    return near, sure


def forest(x: np.ndarray, y: np.ndarray, sure: np.ndarray) -> np.ndarray:
    """Places of the sure edges (x, y) that join trees, and of the others between nodes that those leave apart."""
    root: dict[int, int] = {}

    def top(a: int) -> int:
        while (b := root.get(a, a)) != a:
            root[a] = a = root.get(b, b)
        return a

    out = []
    for k in np.argsort(~sure, kind="stable").tolist():
        a, b = top(int(x[k])), top(int(y[k]))
        if a != b:
            out.append(k)
            if sure[k]:
                root[max(a, b)] = min(a, b)
    return np.array(out, np.int64)


def _across(rows: pa.Table, percent: int) -> pa.RecordBatch:
    """Pairs that join components within each group of neighbouring rows, in their first common bucket only."""
    cols = {c: rows.column(c).to_numpy() for c in ("band", "bucket", "i", "j", "own", "id", "component", "n_shingles")}
    sig = np.frombuffer(b"".join(rows.column("sig").to_pylist()), np.uint8).reshape(-1, BINS)
    bands = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    group = np.cumsum(_starts(rows))
    ids, comp, own, n = (cols[c] for c in ("id", "component", "own", "n_shingles"))
    whole, found = cols["i"] == cols["j"], []
    for d in range(1, int(np.bincount(group).max(initial=0))):
        x = np.flatnonzero((group[d:] == group[:-d]) & (comp[d:] != comp[:-d]) & (whole[d:] | (own[d:] != own[:-d])))
        y = x + d
        fine = 100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])
        x, y = x[fine], y[fine]
        fine = (sig[x] == sig[y]).mean(axis=1) >= AGREE
        x, y = x[fine], y[fine]
        fine = (bands[x] == bands[y]).argmax(axis=1) == cols["band"][x]
        found.append((x[fine], y[fine]))
    x, y = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
    if len(x):
        used, at = np.unique(np.r_[x, y], return_inverse=True)
        sketches = [np.frombuffer(s, np.uint64) for s in rows.column("sketch").take(pa.array(used)).to_pylist()]
        near, sure = compared(sketches, at[:len(x)], at[len(x):], percent)
        x, y, sure = x[near], y[near], sure[near]
        kept = forest(comp[x], comp[y], sure)
        x, y = x[kept], y[kept]
    a, b = ids[x], ids[y]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])


def _starts(rows: pa.Table) -> np.ndarray:
    """Whether a row's block differs from that of the row before."""
    out = np.ones(rows.num_rows, bool)
    out[1:] = np.any([x[1:] != x[:-1] for x in (rows.column(c).to_numpy() for c in ("band", "bucket", "i", "j"))], axis=0)
    return out


def sketches(docs: DataFrame, ids: DataFrame, words: int = WORDS) -> DataFrame:
    """``id, sketch`` of the texts whose doc_id is in ``ids(doc_id)``."""

    def run(batches):
        for batch in batches:
            for at, texts in slices(batch.column(1).to_pylist()):
                found = [s[:SKETCH].tobytes() for s in shingle_sets(texts, words)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(found)), pa.array(found, pa.binary())],
                                                 ["id", "sketch"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.join(ids.hint("merge"), "doc_id", "left_semi").mapInArrow(run, "id long, sketch binary")


def open_pairs(docs: DataFrame, classes: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) that share a bucket and join components: of those whose sketches are whole and reach ``percent`` a
    forest in each block, of the others all that may reach it.

    A bucket of several blocks sends a member to every pair of blocks that its own is in, so no task has more than two
    blocks of a bucket at once.
    """
    members = classes.select("id", "component", F.posexplode("bands").alias("band", "bucket"))
    several = members.groupBy("band", "bucket").agg(
        F.min("component").alias("_lo"), F.max("component").alias("_hi"),
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).where("_lo < _hi").drop("_lo", "_hi")
    rows = stored(members.drop("component").join(several, ["band", "bucket"]), "open")
    known = sketches(docs, rows.select(F.col("id").alias("doc_id")).distinct(), words)
    rows = rows.join(classes.join(known, "id"), "id")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id", F.lit(7)), F.col("blocks")).cast("int"))
    rows = rows.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "band", "bucket", F.least("k", "own").alias("i"), F.greatest("k", "own").alias("j"), "own",
        "id", "component", "n_shingles", "bands", "sig", "sketch")
    rows = rows.repartition("band", "bucket", "i", "j").sortWithinPartitions("band", "bucket", "i", "j")

    def across(batches):
        rest = None
        for batch in batches:
            here = pa.Table.from_batches([batch])
            here = here if rest is None else pa.concat_tables([rest, here])
            cut = int(np.flatnonzero(_starts(here))[-1]) if here.num_rows else 0
            rest = here.slice(cut)
            if cut:
                yield _across(here.slice(0, cut), percent)
        if rest is not None and rest.num_rows:
            yield _across(rest, percent)

    return rows.mapInArrow(across, "a long, b long")


def links(docs: DataFrame, pairs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The ``pairs`` (a, b) that full sets confirm."""
    pairs = stored(pairs, "pairs")
    needed = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()

    def sets(batches):
        for batch in batches:
            for at, texts in slices(batch.column(1).to_pylist()):
                found = [s.astype(np.int64) for s in shingle_sets(texts, words)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(found)), pa.array(found, pa.list_(pa.int64()))], ["id", "set"])

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # The ids grow with the corpus, so they are never broadcast.
    full = stored(texts.join(needed.hint("merge"), "doc_id", "left_semi").mapInArrow(sets, "id long, set array<long>"), "sets")
    for side in "ab":
        pairs = pairs.join(full.select(F.col("id").alias(side), F.col("set").alias("x" + side)), side)
    both = F.size(F.array_intersect("xa", "xb"))
    sizes = F.size("xa") + F.size("xb")
    return pairs.where(100 * both >= percent * (sizes - both)).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs(doc_id, text)``."""
    rows = stored(signatures(docs, words), "signatures")
    classes = stored(rows.where("n_shingles > 0 and doc_id is not null")
                     .groupBy("f1", "f2", "n_shingles", "bands", "sig").agg(F.min("doc_id").alias("id")), "classes")
    found = classes.select("f1", "f2", "id")
    # A doc_id with several texts joins all their classes to the least one.
    same = rows.where("n_shingles > 0 and doc_id is not null").select("doc_id", "f1", "f2").join(found, ["f1", "f2"])
    several = same.groupBy("doc_id").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo != hi")
    same = same.select("doc_id", "id").join(several.select("doc_id", "lo"), "doc_id").where("id != lo").distinct()
    linked = same.select(F.col("lo").alias("a"), F.col("id").alias("b")).unionAll(
        links(docs, star_pairs(classes.withColumn("component", F.col("id")), percent), words, percent))
    comp = components(linked)
    labelled = stored(classes.join(comp, classes.id == comp.node, "left").select(
        "id", F.coalesce("component", "id").alias("component"), "n_shingles", "bands", "sig"), "labelled")
    # What the first round has linked is kept as edges to the least member.
    comp = components(comp.select(F.col("node").alias("a"), F.col("component").alias("b")).unionAll(
        links(docs, open_pairs(docs, labelled, words, percent), words, percent)))
    found = found.join(comp, found.id == comp.node, "left").select(
        "f1", "f2", F.coalesce("component", "id").alias("component"))
    out = rows.select("doc_id", "n_shingles", "f1", "f2").join(found, ["f1", "f2"], "left")
    component = F.coalesce(F.when(F.col("n_shingles") > 0, F.col("component")), F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))
