"""Bounded vocabularies and sparse TF-IDF rows straight from the items' token lists.

``terms(item_id, terms)`` are ``tfidf.tokenised`` items: clustered by ``item_id`` and sorted by it in each partition.  A
task counts the words of a slice of items at a time, so what leaves it are counts per word or per pair of words, and one
row per item with the places of its terms in the vocabulary; no (item, term) pair is a row of its own.  ``terms`` may also
be ``packed`` slices of such items, which take a fraction of the disk and are read without converting their words again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .combine import sparse_batches

SLICE = 2000                 # items whose tokens a task counts at a time
TIES = 4                     # words that tie with the last one prune pairs if there are at most so many vocabularies of them


def _sizes(lists) -> np.ndarray:
    return np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)


def _unpacked(batches):
    """The slices that ``packed`` made values of."""
    for batch in batches:
        for value in batch.column("slice"):
            yield from pa.ipc.open_stream(value.as_buffer())


def packed(terms: DataFrame) -> DataFrame:
    """(item_id, slice): each slice of items as one compressed value, its words as places in the slice's own list of
    words, with the items' ids; partitions and their order stay."""
    kind = terms.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                rows = batch.slice(at, SLICE)
                ids, lists = rows.column("item_id"), rows.column("terms")
                ends = pa.array(np.append(0, np.cumsum(_sizes(lists))).astype(np.int32))
                words = pa.ListArray.from_arrays(ends, lists.flatten().dictionary_encode())
                rows = pa.RecordBatch.from_arrays([ids, words], ["item_id", "terms"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(rows)
                own = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.concat_arrays([ids]))
                yield pa.RecordBatch.from_arrays([own, pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["item_id", "slice"])

    return terms.select("item_id", "terms").mapInArrow(run, f"item_id array<{kind}>, slice binary")


def unpacked(terms: DataFrame) -> DataFrame:
    """(item_id, terms) of ``packed`` items, others as they are."""
    if "slice" not in terms.columns:
        return terms

    def run(batches):
        for rows in _unpacked(batches):
            lists = rows.column("terms")
            words = pa.ListArray.from_arrays(lists.offsets, lists.values.dictionary_decode())
            yield pa.RecordBatch.from_arrays([rows.column("item_id"), words], ["item_id", "terms"])

    return terms.mapInArrow(run, f"item_id {_kind(terms)}, terms array<string>")


def item_ids(terms: DataFrame) -> DataFrame:
    """(item_id) of every row of ``terms``."""
    return terms.select(F.explode("item_id").alias("item_id") if "slice" in terms.columns else "item_id")


def _kind(terms: DataFrame) -> str:
    kind = terms.schema["item_id"].dataType
    return (kind.elementType if "slice" in terms.columns else kind).simpleString()


def _slices(batches):
    """(items, words of all of them as places in a list of words, owner of each word)"""
    for batch in batches:
        many = _unpacked([batch]) if "slice" in batch.schema.names else (
            batch.slice(at, SLICE) for at in range(0, batch.num_rows, SLICE))
        for rows in many:
            words = rows.column("terms").flatten()
            words = words if pa.types.is_dictionary(words.type) else words.dictionary_encode()
            yield rows, words, np.repeat(np.arange(rows.num_rows), _sizes(rows.column("terms")))


def _codes(words: pa.DictionaryArray) -> np.ndarray:
    return words.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _found(words: pa.Array, among: list[str]) -> np.ndarray:
    """Place of each word in ``among``, -1 if it is not there."""
    return pc.fill_null(pc.index_in(words, pa.array(among, words.type)), -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _counted(terms: DataFrame, count) -> DataFrame:
    """(term, n): the counts that ``count(words, owner)`` gives as (terms, numbers) per slice, added up."""

    def run(batches):
        for _, words, owner in _slices(batches):
            for names, n in count(words, owner):
                yield pa.RecordBatch.from_arrays([names.cast(pa.string()), pa.array(n, pa.int64())], ["term", "n"])

    rows = terms.select("slice" if "slice" in terms.columns else "terms")
    return rows.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _word_counts(words, owner):
    n = np.bincount(_codes(words), minlength=len(words.dictionary))
    at = np.flatnonzero(n)
    yield words.dictionary.take(pa.array(at)), n[at]


def _pair_counts(words, owner, first: list[str] | None = None, second: list[str] | None = None):
    """Counts of pairs of adjacent words, of those that begin with one of ``first`` and end with one of ``second``."""
    code, names = _codes(words), words.dictionary
    begins, ends = (_found(names, x) >= 0 if x is not None else np.ones(len(names), bool) for x in (first, second))
    a, b = code[:-1], code[1:]
    ok = (owner[:-1] == owner[1:]) & begins[a] & ends[b]
    pair, n = np.unique(a[ok] * max(1, len(names)) + b[ok], return_counts=True)
    a, b = np.divmod(pair, max(1, len(names)))
    yield pc.binary_join_element_wise(names.take(pa.array(a)), names.take(pa.array(b)), pa.scalar(" ", names.type)), n


def word_counts(terms: DataFrame) -> DataFrame:
    """(term, n): how often each word occurs."""
    return _counted(terms, _word_counts)


def ngram_counts(terms: DataFrame) -> DataFrame:
    """(term, n): how often each word, and each pair of adjacent words, occurs."""

    def count(words, owner):
        yield from _word_counts(words, owner)
        yield from _pair_counts(words, owner)

    return _counted(terms, count)


def pair_counts(terms: DataFrame, first: list[str], second: list[str] | None) -> DataFrame:
    """(term, n): how often each pair of adjacent words occurs whose first word is in ``first``, and whose second one is
    in ``second`` (None: any)."""
    return _counted(terms, lambda words, owner: _pair_counts(words, owner, first, second))


def first_terms(terms: DataFrame, counts: DataFrame, max_features: int, ngram_max: int) -> DataFrame:
    """(term, n) of the ``max_features`` most frequent unigrams (and bigrams), ties by term; ``counts`` are the words' ones.

    Of the unigrams only the first ``max_features`` matter, the others have all of them before them.  A bigram is no more
    frequent than its words.  If its first word is not among those, it is also longer, so it sorts after that word; if its
    second word is less frequent than all of them, so is the bigram.  Leaving these out is exact.
    """
    order = [F.desc("n"), F.asc("term")]
    if ngram_max < 2:
        return counts.orderBy(*order).limit(max_features)
    top = counts.orderBy(*order).limit(max_features)
    held = top.collect()
    first, second = [r["term"] for r in held], None
    if len(held) == max_features:
        near = counts.where(F.col("n") >= held[-1]["n"]).select("term").limit(TIES * max_features + 1).collect()
        second = [r["term"] for r in near] if len(near) <= TIES * max_features else None
    return top.unionByName(pair_counts(terms, first, second)).orderBy(*order).limit(max_features)


def term_rows(terms: DataFrame, vocab: list[str]) -> DataFrame:
    """(item_id, idx, tf): an item's terms by their place in the sorted vocabulary, and how often it has them.

    Rows of the same ``item_id`` make one item; its pairs of words lie in one row each.  Items without a term have no row.
    """
    singles = {w: k for k, w in enumerate(vocab) if " " not in w}
    pairs = [(w.split(" "), k) for k, w in enumerate(vocab) if " " in w]
    kind = _kind(terms)

    def places(words, owner):
        """(owner, place) of each occurrence of a term."""
        known, code = list(singles), _codes(words)
        at = np.append(np.fromiter(singles.values(), np.int64, len(singles)), -1)[_found(words.dictionary, known)][code]
        out = [(owner[at >= 0], at[at >= 0])]
        if pairs and len(words):
            parts = sorted({x for w, _ in pairs for x in w})
            place = {w: k for k, w in enumerate(parts)}
            codes = np.array([place[w[0]] * len(parts) + place[w[1]] for w, _ in pairs], np.int64)
            order = np.argsort(codes)
            codes, goal = codes[order], np.array([k for _, k in pairs], np.int64)[order]
            p = _found(words.dictionary, parts)[code]
            ok = (owner[:-1] == owner[1:]) & (p[:-1] >= 0) & (p[1:] >= 0)
            both = (p[:-1] * len(parts) + p[1:])[ok]
            hit = np.minimum(np.searchsorted(codes, both), len(codes) - 1)
            same = codes[hit] == both
            out.append((owner[:-1][ok][same], goal[hit[same]]))
        return [np.concatenate(x) for x in zip(*out)]

    def run(batches):
        dim = max(1, len(vocab))
        last = None                                   # the last item may go on in the next slice: its id, places, counts

        def table(ids, owner, idx, tf):
            cuts = np.searchsorted(owner, np.arange(len(ids) + 1))
            some = np.flatnonzero(np.diff(cuts))
            ends = pa.array(np.append(cuts[some], len(owner)).astype(np.int32))
            return pa.RecordBatch.from_arrays(
                [ids.take(pa.array(some)), pa.ListArray.from_arrays(ends, pa.array(idx.astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))], ["item_id", "idx", "tf"])

        for rows, words, owner in _slices(batches):
            ids = rows.column("item_id")
            if not len(ids):
                continue
            gone = np.array([x != y for x, y in zip(ids.to_pylist()[1:], ids.to_pylist())], bool)
            item = np.append(0, np.cumsum(gone))      # rows of one item are adjacent
            starts = np.flatnonzero(np.append(True, gone))
            group, at = places(words, owner)
            key, tf = np.unique(item[group] * dim + at, return_counts=True)
            group, at = np.divmod(key, dim)
            if last is not None and last[0].equals(ids.slice(0, 1)):
                first = group == 0
                every = np.concatenate([last[1], at[first]])
                n = np.bincount(every, np.concatenate([last[2], tf[first]]), minlength=1).astype(np.int64)
                own = np.unique(every)
                group = np.concatenate([np.zeros(len(own), np.int64), group[~first]])
                at, tf = np.concatenate([own, at[~first]]), np.concatenate([n[own], tf[~first]])
            elif last is not None:
                yield table(last[0], np.zeros(len(last[1]), np.int64), last[1], last[2])
            end = group == item[-1]
            last = ids.slice(starts[-1], 1), at[end], tf[end]
            yield table(ids.take(pa.array(starts)), group[~end], at[~end], tf[~end])
        if last is not None:
            yield table(last[0], np.zeros(len(last[1]), np.int64), last[1], last[2])

    rows = terms if "slice" in terms.columns else terms.select("item_id", "terms").sortWithinPartitions("item_id")
    return rows.mapInArrow(run, f"item_id {kind}, idx array<int>, tf array<int>")


def item_counts(rows: DataFrame) -> DataFrame:
    """(term_index, df): how many of ``rows(idx)`` have each term."""

    def count(batches):
        for batch in batches:
            n = np.bincount(batch.column("idx").flatten().to_numpy(zero_copy_only=False).astype(np.int64), minlength=1)
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at].astype(np.int64))], ["term_index", "df"])

    found = rows.select("idx").mapInArrow(count, "term_index int, df long")
    return found.groupBy("term_index").agg(F.sum("df").alias("df"))


def weighted(rows: DataFrame, idf: np.ndarray) -> DataFrame:
    """``rows(item_id, idx, tf)`` with ``val``, the weights ``tf * idf`` scaled to unit length, and their sum ``l1``."""
    kind = rows.schema["item_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for n, owner, idx, tf, (ids, places, counts) in sparse_batches(
                    [batch.rename_columns(["item_id", "idx", "val"])], ("item_id", "idx", "val")):
                raw = tf * idf[idx]
                norm = np.sqrt(np.bincount(owner, raw * raw, n))
                ends = pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32))
                val = pa.ListArray.from_arrays(ends, pa.array(raw / norm[owner]))
                yield pa.RecordBatch.from_arrays([ids, places, counts, val, pa.array(np.bincount(owner, raw, n) / norm)],
                                                 ["item_id", "idx", "tf", "val", "l1"])

    return rows.mapInArrow(run, f"item_id {kind}, idx array<int>, tf array<int>, val array<double>, l1 double")
