"""Random forest regressor over sparse binned columns (R-4, R-5).

Rows are ``(item_id, y, entries)``: an entry ``feature * BINS + bin`` is stored for every column whose bin is not 0, so
a text column costs nothing where a term does not occur.  The trees grow by levels:

* **Histograms.**  One job per level for all trees: a task sends each row down the trees grown so far and adds weight
  and target of its entries by (tree, node, entry); partial sums combine before and after the shuffle.  Only entries
  are counted: bin 0 of a column is the node's total less its other bins.  Of two siblings only the lighter is counted,
  the other is their parent's histogram less that one.
* **Splits.**  A node's histogram (at most ``features * BINS`` rows) is one group; its best split goes to the driver,
  which holds the trees, at most ``trees * 2 ** (depth + 1)`` nodes whatever the data.
* **Small nodes.**  A node of at most ``small_rows`` rows is finished by one task from its rows, depth first with the
  same histograms and split search.  Its rows are the only ones that are shuffled, those of a group of trees at a time.

Each tree sees row i with a Poisson(1) weight drawn from a hash of (seed, tree, item_id), so draws do not depend on
partitions or retries.  Targets are centred and rounded to binary fractions, fine enough that all sums are exact in
doubles: the trees are the same for any partitioning, and for any ``small_rows``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, free_written, shuffle_partitions
from .tfidf import TfidfModel

BINS = 32
SMALL_ROWS = 50_000
DENSE_BYTES = 1 << 23        # of the dense bins of the rows that are routed at once
PENDING = 1 << 21            # partial sums that a task holds before it emits them
HELD = 1 << 24               # of a task's histograms; nodes are counted in groups that fit, so a task emits each sum once
SENT = 1 << 26               # bytes of rows that are sent to the small nodes' tasks at a time, or
PASSES = 16                  # a part of all of them, if that is more
LEAST_PARTS = 8              # partitions of the rows, on a cluster of fewer cores
LEAF = -1

_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)])
_NODES = "tree int, node long, feature int, bin int, value double, weight double, gain double"
_NODE_TYPES = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
_NODE_NAMES = [c.split()[0] for c in _NODES.split(", ")]
_HIST = "tree int, node long, e binary, w binary, g binary"
_HIST_TYPES = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
_HIST_NAMES = [c.split()[0] for c in _HIST.split(", ")]


# ------------------------------------------------------------------ columns and bins

def text_cuts(weights: DataFrame, vocab: DataFrame, bins: int = BINS) -> DataFrame:
    """(term, feature, cuts) of every vocabulary term: 0 and quantiles of its weights, ascending.

    One row per term, so at most ``max_features``.
    """
    at = [k / (bins - 1) for k in range(1, bins - 1)]
    found = weights.groupBy("term").agg(F.percentile_approx("weight", at, 10 * bins).alias("q"))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0)), F.coalesce("q", F.array().cast("array<double>")))))
    return vocab.join(found, "term", "left").select("term", F.col("term_index").alias("feature"), cuts.alias("cuts"))


def numeric_cuts(df: DataFrame, cols: list[str], bins: int = BINS) -> list[list[float]]:
    """Quantiles of the numeric columns (null is 0), ascending and distinct."""
    if not cols:
        return []
    at = [k / bins for k in range(1, bins)]
    row = df.agg(*(F.percentile_approx(_number(c), at, 100 * bins).alias(f"c{k}") for k, c in enumerate(cols))).first()
    return [sorted(set(row[k] or [0.0])) for k in range(len(cols))]


def _number(col: str):
    return F.coalesce(F.col(col).cast("double"), F.lit(0.0))


def _bin(cuts, value):
    return F.size(F.filter(cuts, lambda c: c < value))


def binned_rows(items: DataFrame, weights: DataFrame | None, cuts: DataFrame | None, n_text: int, numeric: list[str],
                numeric_at: list[list[float]], label: F.Column | None = None) -> DataFrame:
    """``(item_id, y, entries)`` of every item: ``entries`` are little-endian 32-bit numbers, ascending."""
    extra = [F.when(b > 0, b + (n_text + k) * BINS) for k, (c, at) in enumerate(zip(numeric, numeric_at))
             for b in [_bin(F.array(*map(F.lit, at)), _number(c))]]
    base = items.select("item_id", (F.lit(0.0) if label is None else label).alias("y"),
                        F.array_compact(F.array(*extra)).cast("array<int>").alias("own"))
    if weights is None:
        return base.select("item_id", "y", F.col("own").alias("entries"))
    entry = F.col("feature") * BINS + _bin(F.col("cuts"), F.col("weight"))
    text = (weights.join(F.broadcast(cuts), "term").select("item_id", entry.cast("int").alias("e"))
            .groupBy("item_id").agg(F.array_sort(F.collect_list("e")).alias("text")))
    none = F.array().cast("array<int>")
    return base.join(text, "item_id", "left").select(
        "item_id", "y", F.concat(F.coalesce("text", none), "own").alias("entries"))


# ------------------------------------------------------------------ the model

@dataclass
class ForestModel:
    """Trees as arrays; ``first``: position of a node's left child, the right one follows it."""
    trees: int
    features: int
    nodes: list[tuple]                     # rows as _NODES says, by (tree, node)

    def __post_init__(self):
        self.nodes = sorted(self.nodes)
        place = {(r[0], r[1]): k for k, r in enumerate(self.nodes)}
        self.node = np.array([r[1] for r in self.nodes], np.int64)
        self.feature = np.array([r[2] for r in self.nodes], np.int32)
        self.bin = np.array([r[3] for r in self.nodes], np.int32)
        self.value = np.array([r[4] for r in self.nodes], float)
        self.first = np.array([place.get((r[0], 2 * r[1]), -1) for r in self.nodes], np.int64)
        self.roots = np.array([place[t, 1] for t in range(self.trees)], np.int64)

    def places(self, dense: np.ndarray, trees: np.ndarray | None = None) -> np.ndarray:
        """Position of the leaf of each row (of dense bins) in each of the trees (None: all)."""
        roots = self.roots if trees is None else self.roots[trees]
        at = np.repeat(roots[None, :], len(dense), axis=0)
        rows = np.arange(len(dense))[:, None]
        while True:
            f = self.feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            right = dense[rows, np.maximum(f, 0)] > self.bin[at]
            at = np.where(inner, self.first[at] + right, at)

    def importance(self) -> np.ndarray:
        """Per feature: its share of a tree's impurity decrease, averaged over the trees and normalised."""
        out = np.zeros(self.features)
        tree = np.array([r[0] for r in self.nodes])
        gain = np.array([r[6] for r in self.nodes])
        for t in range(self.trees):
            k = (tree == t) & (self.feature >= 0)
            one = np.bincount(self.feature[k], gain[k], self.features)
            out += one / one.sum() if one.sum() > 0 else 0
        return out / out.sum() if out.sum() > 0 else out


def _dense(entries: list[np.ndarray], features: int) -> np.ndarray:
    out = np.zeros((len(entries), features), np.uint8)
    flat = np.concatenate([np.zeros(0, np.int64), *entries])
    rows = np.repeat(np.arange(len(entries)), [len(e) for e in entries])
    out[rows, flat // BINS] = flat % BINS
    return out


def _batches(batches, features: int):
    """(ids, y, entries as arrays) in slices whose dense bins stay below DENSE_BYTES."""
    step = max(1, DENSE_BYTES // max(1, features))
    for batch in batches:
        ids, y = batch.column("item_id").to_numpy(), batch.column("y").to_numpy(zero_copy_only=False)
        column = batch.column("entries")
        flat, ends = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.cumsum(
            column.value_lengths().to_numpy(zero_copy_only=False))
        for a in range(0, len(ids), step):
            b = min(len(ids), a + step)
            cuts = np.r_[ends[a - 1] if a else 0, ends[a:b]]
            yield ids[a:b], y[a:b], [flat[i:j] for i, j in zip(cuts, cuts[1:])]


def draws(ids: np.ndarray, trees: int | np.ndarray, seed: int) -> np.ndarray:
    """Poisson(1) weights (rows × trees, their number or some of them) from a hash of seed, tree and id."""
    trees = np.arange(trees) if np.isscalar(trees) else trees
    x = ids.astype(np.int64).view(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
    x = x + (trees + 1).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + np.uint64(seed * 2 + 1)
    for a, m in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(a))) * np.uint64(m)
    return np.searchsorted(_POISSON, ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / 2.0**53).astype(np.int64)


# ------------------------------------------------------------------ histograms and splits

def best_split(w: np.ndarray, g: np.ndarray, weight: float, total: float) -> tuple[int, int, float, float, float]:
    """(feature, bin, gain, weight and sum of the left side); feature LEAF without a gain.

    ``w`` and ``g`` (features × BINS) are filled for the bins above 0; rows of bin <= the split's go left.
    """
    w[:, 0], g[:, 0] = weight - w[:, 1:].sum(axis=1), total - g[:, 1:].sum(axis=1)
    lw, lg = np.cumsum(w, axis=1)[:, :-1], np.cumsum(g, axis=1)[:, :-1]
    rw, rg = weight - lw, total - lg
    with np.errstate(divide="ignore", invalid="ignore"):
        score = np.where((lw > 0) & (rw > 0), lg * lg / lw + rg * rg / rw, -np.inf)
    k = int(score.argmax())
    f, b = divmod(k, BINS - 1)
    gain = float(score[f, b]) - total * total / weight
    if not gain > 1e-9 * max(1.0, total * total / weight):
        return LEAF, 0, 0.0, 0.0, 0.0
    return f, b, gain, float(lw[f, b]), float(lg[f, b])


def grow(tree: int, root: int, entries: np.ndarray, ends: np.ndarray, w: np.ndarray, y: np.ndarray, features: int,
         max_depth: int) -> list[tuple]:
    """All nodes below and with ``root`` from the rows that reach it (entries of row k: ``ends[k]`` to ``ends[k+1]``).

    Every node keeps its rows' entries.  A node of few entries looks only at the columns that have some.
    """
    wide, g, out = features * BINS, w * y, []
    high = np.zeros(len(w), bool)

    def histogram(e: np.ndarray, o: np.ndarray, width: int) -> np.ndarray:
        return np.stack([np.bincount(e, w[o], width), np.bincount(e, g[o], width)])

    def split_of(e, o, hist, weight, total):
        if hist is not None:
            return best_split(*hist.reshape(2, features, BINS).copy(), weight, total)
        present, at = np.unique(e // BINS, return_inverse=True)
        if not len(present):
            return LEAF, 0, 0.0, 0.0, 0.0
        some = histogram(at * BINS + e % BINS, o, len(present) * BINS)
        f, *rest = best_split(*some.reshape(2, len(present), BINS), weight, total)
        return (LEAF if f == LEAF else int(present[f])), *rest

    stack = [(root, np.arange(len(w)), entries, np.repeat(np.arange(len(w)), np.diff(ends)), None)]
    while stack:
        node, rows, e, o, hist = stack.pop()
        weight, total = float(w[rows].sum()), float(g[rows].sum())
        split = (LEAF, 0, 0.0, 0.0, 0.0)
        if node.bit_length() <= max_depth and len(rows) > 1:
            if hist is None and len(e) > wide // 4:
                hist = histogram(e, o, wide)
            split = split_of(e, o, hist, weight, total)
        out.append((tree, node, split[0], split[1], total / weight if weight else 0.0, weight, split[2]))
        if split[0] == LEAF:
            continue
        moved = o[(e > split[0] * BINS + split[1]) & (e < (split[0] + 1) * BINS)]
        high[moved] = True
        right, of_right = high[rows], high[o]
        high[moved] = False
        children = [[rows[~right], e[~of_right], o[~of_right], None], [rows[right], e[of_right], o[of_right], None]]
        light, heavy = sorted(children, key=lambda c: len(c[1]))
        if hist is not None and (2 * node).bit_length() <= max_depth and len(heavy[1]) > wide // 4:
            light[3] = histogram(light[1], light[2], wide)
            heavy[3] = hist - light[3]
        stack += [(2 * node + 1, *children[1]), (2 * node, *children[0])]
    return out


def _table(rows: list[tuple], names, types) -> pa.RecordBatch:
    cols = zip(*rows) if rows else ((),) * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], list(names))


def _stored(e: np.ndarray, w: np.ndarray, g: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """A histogram's entries, weights (whole numbers, in four bytes if they fit) and sums as they are kept and sent."""
    small = not len(w) or w.max() < 1 << 32
    return e.astype("<i4").tobytes(), w.astype("<u4" if small else "<f8").tobytes(), g.astype("<f8").tobytes()


def _read(e: bytes, w: bytes, g: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    w = np.frombuffer(w, "<u4" if len(w) == len(e) else "<f8").astype(float)
    return np.frombuffer(e, "<i4").astype(np.int64), w, np.frombuffer(g, "<f8")


def _added(hist: DataFrame) -> DataFrame:
    """One histogram per node: the sum of its rows, each with its ``sign`` if there is one."""

    def add(rows: pa.Table) -> pa.Table:
        parts = [_read(*x) for x in zip(*(rows.column(c).to_pylist() for c in ("e", "w", "g")))]
        signs = rows.column("sign").to_pylist() if "sign" in rows.column_names else [1] * len(parts)
        width = max((int(e[-1]) for e, _, _ in parts if len(e)), default=-1) + 1
        w, g = np.zeros(width), np.zeros(width)
        for sign, (e, pw, pg) in zip(signs, parts):          # a part has an entry once
            w[e] += sign * pw
            g[e] += sign * pg
        e = np.flatnonzero(w)
        row = (rows.column("tree")[0].as_py(), rows.column("node")[0].as_py(), *_stored(e, w[e], g[e]))
        return pa.Table.from_batches([_table([row], _HIST_NAMES, _HIST_TYPES)])

    return hist.groupBy("tree", "node").applyInArrow(add, _HIST)


class _Grower:
    """The trees while they grow: ``done`` nodes, and ``open`` ones (weight, sum) that still may be split."""

    def __init__(self, rows: DataFrame, n_rows: int, features: int, trees: int, max_depth: int, seed: int, small_rows: int):
        self.rows, self.features, self.trees, self.max_depth = rows, features, trees, max_depth
        self.seed, self.small_rows, self.wide = seed, small_rows, features * BINS
        self.done: list[tuple] = []
        self.small: list[tuple[int, int]] = []
        self.hist = None                                     # of the nodes split last
        # A root's weight is not known yet; its rows are at most all.
        self.open = [(t, 1, float(n_rows)) for t in range(trees)]

    def model(self) -> ForestModel:
        """The trees as they are, open nodes as leaves."""
        known = {(r[0], r[1]) for r in self.done}
        rest = [(t, n, LEAF, 0, 0.0, 0.0, 0.0) for t, n, *_ in [*self.open, *self.small] if (t, n) not in known]
        return ForestModel(self.trees, self.features, self.done + rest)

    def _counted(self, nodes: list[tuple[int, int]]) -> DataFrame:
        """(tree, node, e, w, g): each of the given nodes' histogram, its rows' sums by entry; entry 0 holds the node's totals.

        The nodes are counted in groups whose histograms a task can hold, so that it sends each sum once.
        """
        many = max(1, HELD // self.wide) if self.wide <= HELD else len(nodes)
        nodes = sorted(nodes)
        if len(nodes) <= many:
            return self._counted_group(nodes)
        found = []
        for at in range(0, len(nodes), many):
            found.append(cut_lineage(self._counted_group(nodes[at:at + many])))
            free_written(self.rows.sparkSession)
        return reduce(DataFrame.unionByName, found)

    def _counted_group(self, nodes: list[tuple[int, int]]) -> DataFrame:
        model, wide, features, seed = self.model(), self.wide, self.features, self.seed
        wanted, of_trees = set(nodes), np.array(sorted({t for t, _ in nodes}))
        names = [(r[0], r[1]) for r in model.nodes]
        number = np.array([k if x in wanted else -1 for k, x in enumerate(names)], np.int64)
        told = self.rows.sparkSession.sparkContext.broadcast((model, number))

        def run(batches):
            model, number = told.value
            tree, node = np.array([r[0] for r in model.nodes], np.int32), model.node
            keys, w, g, held = [], [], [], 0
            # Whole histograms, by tree: the wanted nodes' positions follow each other there.
            places = [np.flatnonzero((number >= 0) & (tree == t)) for t in of_trees]
            whole = [np.zeros((2, len(p) * wide)) for p in places] if len(wanted) * wide <= HELD else None
            local = np.zeros(len(number), np.int64)
            for p in places:
                local[p] = np.arange(len(p))

            def histograms(positions, key, sw, sg):
                """``key`` ascending: place in ``positions`` * wide + entry."""
                cuts = np.searchsorted(key, np.arange(len(positions) + 1) * wide)
                return _table([(int(tree[p]), int(node[p]), *_stored(key[a:b] % wide, sw[a:b], sg[a:b]))
                               for p, a, b in zip(positions, cuts, cuts[1:]) if b > a], _HIST_NAMES, _HIST_TYPES)

            def merged():
                k, at = np.unique(np.concatenate([np.zeros(0, np.int64), *keys]), return_inverse=True)
                # Without entries numpy counts in integers, and all batches need the same types.
                sums = [np.bincount(at, np.concatenate([np.zeros(0), *x]), len(k)).astype(float) for x in (w, g)]
                return histograms(np.arange(len(number)), k, *sums)

            for ids, y, entries in _batches(batches, features):
                at = number[model.places(_dense(entries, features), of_trees)]
                weight = draws(ids, of_trees, seed)
                lengths = np.array([len(e) for e in entries])
                flat = np.concatenate([np.zeros(0, np.int64), *entries])
                owner = np.repeat(np.arange(len(ids)), lengths)
                for t in range(len(of_trees)):
                    use = (at[:, t] >= 0) & (weight[:, t] > 0)
                    if not use.any():
                        continue
                    k = use[owner]
                    rows = np.r_[np.flatnonzero(use), owner[k]]
                    if whole is not None:
                        key = local[at[rows, t]] * wide + np.r_[np.zeros(use.sum(), np.int64), flat[k]]
                        own = weight[rows, t].astype(float)
                        whole[t][0] += np.bincount(key, own, whole[t].shape[1])
                        whole[t][1] += np.bincount(key, own * y[rows], whole[t].shape[1])
                        continue
                    keys.append(at[rows, t] * wide + np.r_[np.zeros(use.sum(), np.int64), flat[k]])
                    w.append(weight[rows, t].astype(float))
                    g.append(weight[rows, t] * y[rows])
                    held += len(rows)
                    if held > PENDING:
                        yield merged()
                        keys, w, g, held = [], [], [], 0
            for p, (sw, sg) in zip(places, whole or []):
                key = np.flatnonzero(sw)
                if len(key):
                    yield histograms(p, key, sw[key], sg[key])
            if whole is None:
                yield merged()

        return _added(self.rows.mapInArrow(run, _HIST))

    def _splits(self, hist: DataFrame) -> list[tuple]:
        features = self.features

        def run(batches):
            for batch in batches:
                found = []
                for t, n, *stored in zip(*(c.to_pylist() for c in batch.columns)):
                    e, w, g = _read(*stored)
                    weight, total = float(w[e == 0].sum()), float(g[e == 0].sum())
                    full = [np.bincount(e, x, features * BINS).reshape(features, BINS) for x in (w, g)]
                    split = best_split(*full, weight, total) if weight else (LEAF, 0, 0.0, 0.0, 0.0)
                    found.append((t, n, split[0], split[1], total / weight if weight else 0.0, weight, split[2], split[3]))
                yield _table(found, [*_NODE_NAMES, "left"], [*_NODE_TYPES, pa.float64()])

        return [tuple(r) for r in hist.mapInArrow(run, _NODES + ", left double").collect()]

    def level(self) -> None:
        """Splits all open nodes that are not small; their children are the next open ones."""
        self.small += [(t, n) for t, n, w, *_ in self.open if w <= self.small_rows]
        large = [x for x in self.open if x[2] > self.small_rows]
        if not large:
            self.open = []
            return
        # Siblings (both large) are counted once: the lighter one; its twin is their parent less it.
        weight = {(t, n): w for t, n, w, *_ in large}
        twins = {(t, n): (t, n ^ 1) for t, n in weight if self.hist is not None and (t, n ^ 1) in weight
                 and (weight[t, n], n) > (weight[t, n ^ 1], n ^ 1)}
        hist = cut_lineage(self._counted([x for x in weight if x not in twins]))
        if twins:
            spark = self.rows.sparkSession
            pairs = F.broadcast(spark.createDataFrame([(t, n, o) for (t, n), (_, o) in twins.items()],
                                                      "tree int, heavy long, light long"))
            parents = self.hist.withColumnRenamed("node", "parent").join(
                pairs.withColumn("parent", F.shiftright("heavy", 1)), ["tree", "parent"])
            lights = hist.join(pairs.withColumnRenamed("light", "node"), ["tree", "node"])
            rest = parents.select("tree", F.col("heavy").alias("node"), "e", "w", "g", F.lit(1).alias("sign")).unionByName(
                lights.select("tree", F.col("heavy").alias("node"), "e", "w", "g", F.lit(-1).alias("sign")))
            hist = hist.unionByName(cut_lineage(_added(rest)))
        self.hist = hist
        free_written(self.rows.sparkSession)
        splits = self._splits(hist)
        self.done += [r[:7] for r in splits]
        self.open = []
        for t, n, f, b, value, w, gain, left in splits:
            if f != LEAF:
                for child, cw in ((2 * n, left), (2 * n + 1, w - left)):
                    self.open.append((t, child, cw))
        last = [x for x in self.open if x[1].bit_length() > self.max_depth]
        if last:                                             # the deepest nodes only need their means
            means = self._counted_totals([x[:2] for x in last])
            self.done += [(t, n, LEAF, 0, g / w if w else 0.0, w, 0.0) for t, n, w, g in means]
            self.open = [x for x in self.open if x[1].bit_length() <= self.max_depth]

    def _counted_totals(self, nodes: list[tuple[int, int]]) -> list[tuple]:
        def run(batches):
            for batch in batches:
                found = [(t, n, *(float(x[e == 0].sum()) for x in sums)) for t, n, *stored in zip(
                    *(c.to_pylist() for c in batch.columns)) for e, *sums in [_read(*stored)]]
                yield _table(found, ["tree", "node", "w", "g"], [pa.int32(), pa.int64(), pa.float64(), pa.float64()])

        return [tuple(r) for r in self._counted(nodes).mapInArrow(run, "tree int, node long, w double, g double").collect()]

    def finish_small(self) -> None:
        """The small nodes' subtrees, each from its rows in one task.

        A row is sent once for each tree that drew it, so the trees are taken in groups: at most ``PASSES`` of them, and of
        ``SENT`` bytes if that is more.  A group's rows leave the disks before those of the next one are sent.
        """
        if not self.small:
            return
        self.hist = None
        free_written(self.rows.sparkSession)
        held = self.rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("entries")), F.lit(0))).first()
        one = max(1, int(0.64 * (10 * held[0] + (2 if self.wide <= 1 << 16 else 4) * held[1])))
        trees = sorted({t for t, _ in self.small})
        group = max(-(-len(trees) // PASSES), SENT // one)
        model, found = self.model(), []
        for at in range(0, len(trees), group):
            some = set(trees[at:at + group])
            found += self._finished(model, [x for x in self.small if x[0] in some])
            free_written(self.rows.sparkSession)
        reached = {(r[0], r[1]) for r in found}
        # A node that no row reaches (a tree that drew nothing) is a leaf of the mean, 0 after centring.
        self.done += found + [(t, n, LEAF, 0, 0.0, 0.0, 0.0) for t, n in set(self.small) - reached]
        self.small = []

    def _finished(self, model: ForestModel, small: list[tuple[int, int]]) -> list[tuple]:
        """All nodes below and with the given ones."""
        features, seed, depth, kind = self.features, self.seed, self.max_depth, "<u2" if self.wide <= 1 << 16 else "<i4"
        wanted, trees = set(small), np.array(sorted({t for t, _ in small}))
        number = np.array([r[1] if (r[0], r[1]) in wanted else 0 for r in model.nodes], np.int64)
        spark = self.rows.sparkSession
        told = spark.sparkContext.broadcast((model, number))

        def send(batches):
            model, number = told.value
            for ids, y, entries in _batches(batches, features):
                node = number[model.places(_dense(entries, features), trees)]
                weight = draws(ids, trees, seed)
                lengths = np.array([len(e) for e in entries], np.int64)
                flat, starts = np.concatenate([np.zeros(0, np.int64), *entries]).astype(kind), np.cumsum(lengths) - lengths
                rows = []
                for t in range(len(trees)):
                    k = np.flatnonzero((node[:, t] > 0) & (weight[:, t] > 0))
                    k = k[np.argsort(node[k, t], kind="stable")]
                    sizes = lengths[k]
                    ends = np.r_[0, np.cumsum(sizes)]
                    own = flat[np.repeat(starts[k] - ends[:-1], sizes) + np.arange(ends[-1])]
                    cuts = np.flatnonzero(np.r_[True, np.diff(node[k, t]) != 0, True]) if len(k) else []
                    for a, b in zip(cuts, cuts[1:]):
                        rows.append((int(trees[t]), int(node[k[a], t]), y[k[a:b]].tobytes(), weight[k[a:b], t].astype(np.uint8).tobytes(),
                                     sizes[a:b].astype("<i4").tobytes(), own[ends[a]:ends[b]].tobytes()))
                yield _table(rows, ["tree", "node", "y", "w", "sizes", "entries"], [pa.int32(), pa.int64(), *[pa.binary()] * 4])

        def finish(rows: pa.Table) -> pa.Table:
            y, w, sizes, flat = (np.frombuffer(b"".join(rows.column(c).to_pylist()), x) for c, x in (
                ("y", float), ("w", np.uint8), ("sizes", "<i4"), ("entries", kind)))
            ends = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
            found = grow(rows.column("tree")[0].as_py(), rows.column("node")[0].as_py(), flat.astype(np.int64), ends,
                         w.astype(float), y, features, depth)
            return pa.Table.from_batches([_table(found, _NODE_NAMES, _NODE_TYPES)])

        sent = self.rows.mapInArrow(send, "tree int, node long, y binary, w binary, sizes binary, entries binary")
        # An explicit count: few bytes, but much work per group.
        sent = sent.repartition(min(len(wanted), 4 * shuffle_partitions(spark)), "tree", "node")
        found = [tuple(r) for r in sent.groupBy("tree", "node").applyInArrow(finish, _NODES).collect()]
        told.unpersist()
        return found


def fixed_point(rows: DataFrame) -> tuple[DataFrame, float, int]:
    """``rows`` with ``y`` centred and rounded to a binary fraction, the mean, and the number of rows."""
    s = rows.agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("m"), F.max(F.abs("y")).alias("top")).first()
    n, mean, top = s["n"], s["m"] or 0.0, 2 * (s["top"] or 0.0)
    bits = int(52 - math.ceil(math.log2(max(1, n) * 16 * max(top, 1e-300)))) if top else 0
    unit = 2.0 ** max(-900, min(900, min(bits, 40)))
    return rows.withColumn("y", F.round((F.col("y") - mean) * unit) / unit), mean, n


def fit_forest(rows: DataFrame, features: int, trees: int = 100, max_depth: int = 10, seed: int = 42,
               small_rows: int = SMALL_ROWS) -> ForestModel:
    """Forest of regression trees on ``rows(item_id, y, entries)``; every split looks at all features."""
    if not features:
        raise ValueError("a forest needs at least one feature")
    spark = rows.sparkSession
    # Every partition sends the histograms of all trees at each level: no more of them than cores.
    parts = min(shuffle_partitions(spark), max(LEAST_PARTS, spark.sparkContext.defaultParallelism))
    rows = cut_lineage(rows.repartition(parts, "item_id"))
    centred, mean, n = fixed_point(rows)
    g = _Grower(centred, n, features, trees, max_depth, seed, small_rows)
    while g.open:
        g.level()
    g.finish_small()
    return ForestModel(trees, features, [(*r[:4], r[4] + mean, *r[5:]) for r in g.done])


def forest_values(rows: DataFrame, model: ForestModel) -> DataFrame:
    """(item_id, prediction): mean over the trees of the leaf that each row of ``rows(item_id, entries)`` reaches."""
    told = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = told.value
        for ids, _, entries in _batches(batches, model.features):
            value = model.value[model.places(_dense(entries, model.features))].mean(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(value)], ["item_id", "prediction"])

    return rows.withColumn("y", F.lit(0.0)).select("item_id", "y", "entries").mapInArrow(
        run, "item_id long, prediction double")


@dataclass
class FittedForest:
    """A forest with the columns' bins, so that new items can be scored."""
    model: ForestModel
    cuts: DataFrame | None                 # term, feature, cuts
    n_text: int
    numeric: list[str]
    numeric_at: list[list[float]]

    def rows(self, items: DataFrame, weights: DataFrame | None, label: F.Column | None = None) -> DataFrame:
        return binned_rows(items, weights, self.cuts, self.n_text, self.numeric, self.numeric_at, label)

    def predict(self, items: DataFrame, weights: DataFrame | None) -> DataFrame:
        return forest_values(self.rows(items, weights), self.model)


def fit_item_forest(items: DataFrame, tfidf: TfidfModel | None, numeric: list[str], label: F.Column, trees: int,
                    max_depth: int, seed: int = 42, small_rows: int = SMALL_ROWS) -> FittedForest:
    """A forest on the items' text weights and numeric columns."""
    numeric = [c for c in numeric if c in items.columns]
    cuts = cut_lineage(text_cuts(tfidf.weights, tfidf.vocab)) if tfidf is not None else None
    n_text = cuts.count() if cuts is not None else 0
    out = FittedForest(None, cuts, n_text, numeric, numeric_cuts(items, numeric))
    rows = out.rows(items, tfidf.weights if tfidf is not None else None, label)
    out.model = fit_forest(rows, n_text + len(numeric), trees, max_depth, seed, small_rows)
    return out
