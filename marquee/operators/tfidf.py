"""Vocabulary and TF-IDF weights (F-1 ... F-4).

Long form ``(item_id, term, weight)`` is the primary representation:

1. The combined item text is hash-partitioned by ``item_id`` once.  Every
   later step keyed by item (term frequencies, L2 norms, per-item sums in
   scoring) then satisfies its distribution requirement without a shuffle.
2. Term frequencies are a per-item aggregation (same partition).
3. The vocabulary is a term-keyed aggregation with map-side partial
   aggregation (hot terms combine before the shuffle) followed by a bounded
   ``orderBy().limit(max_features)``.  Its size is bounded by the parameter,
   so broadcasting it is safe.
4. Weights are ``tf * idf`` normalised per item with a window over the
   already-clustered item partitions.

Weight variants: ``smooth`` (the reference's vectoriser default,
``tf * (ln((1+N)/(1+df)) + 1)`` then L2) and ``plain`` (``tf/Σtf × ln(N/df)``,
the form printed on the reference's documentation page).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import combined_text, with_bigrams, with_terms
from ..session import cut_lineage, free_written, shuffle_partitions
from .termrows import first_terms, item_counts, item_ids, packed, term_rows, unpacked, weighted, word_counts


@dataclass
class TfidfModel:
    vocab: DataFrame        # term, term_index, n_total, df, idf  (<= max_features rows)
    weights: DataFrame      # item_id, term, weight, l1  (clustered by item_id)
    item_norms: DataFrame   # item_id, n2, n1 for every fitted item (0 for empty vectors)
    n_docs: Column          # scalar subquery: number of fitted items
    max_features: int
    ngram_max: int
    tf: DataFrame | None = None     # item_id, term, tf (clustered by item_id)
    rows: DataFrame | None = None   # item_id, idx, tf, val, l1: the weights, one row per item (bounded vocabularies)


def item_terms(items: DataFrame, ngram_max: int = 1, partitions: int | None = None) -> DataFrame:
    """(item_id, terms) with the text clustered by ``item_id``.

    The partition count is explicit (default: ``spark.sql.shuffle.partitions``)
    so AQE does not coalesce the text shuffle into a few tasks: the work after
    it (regex tokenising) is heavy relative to the bytes moved.
    """
    docs = items.select("item_id", combined_text(items).alias("text"))
    docs = docs.repartition(partitions or shuffle_partitions(items.sparkSession), "item_id").sortWithinPartitions("item_id")
    return with_terms(docs, F.col("text"), "terms", ngram_max).select("item_id", "terms")


def tokenised(items: DataFrame, partitions: int | None = None) -> DataFrame:
    """``item_terms`` (unigrams), written once: every vocabulary over the same items can be derived from it.

    Tokens are stored before they are exploded: the optimizer infers a filter on the size of an exploded array and
    would run the tokeniser again for it, in the scan's few tasks.
    """
    return cut_lineage(item_terms(items, 1, partitions))


def packed_items(items: DataFrame, partitions: int | None = None) -> DataFrame:
    """``item_terms`` (unigrams) as ``packed`` slices, written once: what bounded vocabularies are counted from."""
    return cut_lineage(packed(item_terms(items, 1, partitions)))


def counted_words(terms: DataFrame) -> DataFrame:
    """(term, n): counts of the words of ``tokenised`` or ``packed`` items, written once."""
    return cut_lineage(word_counts(terms))


def pruned_terms(uni: DataFrame, max_features: int) -> DataFrame:
    """(item_id, term): unigrams and bigrams of ``tokenised`` items that can still reach the vocabulary, with repeats.

    Let ``top`` be the ``max_features`` first unigrams in the vocabulary's own
    order (count, then term).  Any other unigram has all of ``top`` before it.
    So has a bigram whose first word is not in ``top``: it is no more frequent
    than that word, and longer, so it sorts after it.  Dropping these before
    the per-item aggregation is exact.  ``top`` is bounded by the parameter,
    like the vocabulary itself, so it is broadcast, and the items' clustering
    stays.
    """
    counts = uni.select(F.explode_outer("terms").alias("_a")).where("_a is not null").groupBy("_a").agg(
        F.count(F.lit(1)).alias("n"))
    top = cut_lineage(counts.orderBy(F.desc("n"), F.asc("_a")).limit(max_features).select("_a"))
    pairs = uni.select("item_id", F.inline_outer(F.arrays_zip(
        F.col("terms").alias("_a"), F.slice("terms", 2, F.greatest(F.size("terms"), F.lit(1))).alias("_b"))))
    kept = pairs.join(F.broadcast(top), "_a")
    both = F.array(F.col("_a"), F.concat("_a", F.lit(" "), "_b"))
    return kept.select("item_id", F.explode(both).alias("term")).where("term is not null")


def term_frequencies(doc_terms: DataFrame) -> DataFrame:
    """(item_id, term, tf): grouped within the item partitions (no shuffle)."""
    # No inferred filter on the array's size, which would evaluate the terms' expression once more.
    return _frequencies(doc_terms.select("item_id", F.explode_outer("terms").alias("term")).where("term is not null"))


def _frequencies(rows: DataFrame) -> DataFrame:
    return rows.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def _with_idf(stats: DataFrame, n_docs: Column) -> DataFrame:
    return (stats
            .withColumn("idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0))
            .withColumn("idf_plain", F.log(n_docs / F.col("df"))))


def vocabulary(tf: DataFrame, max_features: int | None, n_docs: Column) -> DataFrame:
    """F-1: the ``max_features`` most frequent terms by corpus count (ties by term)."""
    stats = tf.groupBy("term").agg(F.sum("tf").alias("n_total"), F.count(F.lit(1)).alias("df"))
    if max_features:
        stats = stats.orderBy(F.desc("n_total"), F.asc("term")).limit(max_features)
    # term_index: position in the sorted vocabulary (vector forms); numbered
    # only when the vocabulary is bounded by max_features.
    if max_features:
        stats = stats.withColumn("term_index", F.row_number().over(Window.orderBy("term")) - 1)
    else:
        stats = stats.withColumn("term_index", F.lit(None).cast("int"))
    return _with_idf(stats, n_docs)


def _fit_bounded(terms: DataFrame, counts: DataFrame, max_features: int, ngram_max: int, n_docs: Column) -> TfidfModel:
    """The smooth variant over a bounded vocabulary, by one sparse row per item (see ``termrows``)."""
    first = cut_lineage(first_terms(terms, counts, max_features, ngram_max)
                        .withColumn("term_index", F.row_number().over(Window.orderBy("term")) - 1))
    names = [r["term"] for r in first.orderBy("term_index").collect()]
    counted = cut_lineage(term_rows(terms, names))
    vocab = first.join(item_counts(counted), "term_index").select("term", F.col("n").alias("n_total"), "df", "term_index")
    vocab = cut_lineage(_with_idf(vocab, n_docs))
    idf = np.zeros(len(names))
    for r in vocab.select("term_index", "idf").collect():
        idf[r["term_index"]] = r["idf"]
    # Clustered by item again, so that later steps per item need no shuffle.
    rows = cut_lineage(weighted(counted, idf).repartition(terms.rdd.getNumPartitions(), "item_id"))
    del counted
    free_written(terms.sparkSession)
    entries = rows.select("item_id", "l1", F.inline(F.arrays_zip(F.col("idx").alias("term_index"), F.col("val").alias("weight"), "tf")))
    entries = entries.join(F.broadcast(vocab.select("term_index", "term")), "term_index")
    per_item = rows.select("item_id", F.aggregate("val", F.lit(0.0), lambda a, v: a + v * v).alias("n2"), F.col("l1").alias("n1"))
    item_norms = (item_ids(terms).join(per_item, "item_id", "left")
                  .select("item_id", F.coalesce("n2", F.lit(0.0)).alias("n2"), F.coalesce("n1", F.lit(0.0)).alias("n1")))
    return TfidfModel(vocab=vocab, weights=entries.select("item_id", "term", "weight", "l1"), item_norms=cut_lineage(item_norms),
                      n_docs=n_docs, max_features=max_features, ngram_max=ngram_max,
                      tf=entries.select("item_id", "term", F.col("tf").cast("bigint").alias("tf")), rows=rows)


def fit_tfidf(items: DataFrame, max_features: int | None = 5000, ngram_max: int = 2,
              variant: str = "smooth", partitions: int | None = None, materialize: bool = True,
              prune: bool = True, terms: DataFrame | None = None, counts: DataFrame | None = None) -> TfidfModel:
    """F-2: fit vocabulary and weights over the whole catalogue.

    With ``materialize`` the term frequencies and the weights are written
    once to the shared checkpoint directory (reliable, survives executor
    loss, keeps the ``item_id`` partitioning), so the tokeniser runs once
    however often the model is used.  With ``prune`` (and a bounded
    vocabulary) terms that provably cannot enter the vocabulary are dropped
    before the per-item aggregation (see ``pruned_terms``).  ``terms``
    and ``counts`` may hold the items' ``tokenised`` terms (or ``packed_items``) and ``counted_words``,
    so that several models share them.
    """
    bounded = materialize and prune and max_features and ngram_max <= 2 and variant == "smooth"
    if terms is None and bounded:
        terms = packed_items(items, partitions)
    elif terms is None:
        terms = tokenised(items, partitions) if materialize else item_terms(items, 1, partitions)
    if bounded:
        counts = counted_words(terms) if counts is None else counts
        return _fit_bounded(terms, counts, max_features, ngram_max, items.select(F.count(F.lit(1))).scalar())
    terms = unpacked(terms)
    if ngram_max >= 2 and max_features and prune:
        tf = _frequencies(pruned_terms(terms, max_features))
    elif ngram_max >= 2:
        tf = term_frequencies(terms.select("item_id", with_bigrams("terms").alias("terms")))
    else:
        tf = term_frequencies(terms)
    n_docs = items.select(F.count(F.lit(1))).scalar()
    if materialize:
        tf = cut_lineage(tf)
    vocab = vocabulary(tf, max_features, n_docs)
    if materialize:
        vocab = cut_lineage(vocab)
    j = tf.join(F.broadcast(vocab.select("term", "idf", "idf_plain")), "term")
    by_item = Window.partitionBy("item_id")
    if variant == "plain":
        raw = F.col("tf") / F.sum("tf").over(by_item) * F.col("idf_plain")
        w = j.select("item_id", "term", raw.alias("weight"))
        weights = w.withColumn("l1", F.sum(F.abs("weight")).over(by_item))
    elif variant == "smooth":
        w = j.select("item_id", "term", (F.col("tf") * F.col("idf")).alias("raw"))
        norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(by_item))
        w = w.withColumn("norm", norm)
        weights = w.select("item_id", "term", (F.col("raw") / F.col("norm")).alias("weight"),
                           (F.sum("raw").over(by_item) / F.col("norm")).alias("l1"))
    else:
        raise ValueError(f"unknown variant {variant!r}")
    if materialize:
        weights = cut_lineage(weights)
    per_item = weights.groupBy("item_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n2"),
                                              F.first("l1").alias("n1"))
    ids = terms.select("item_id")
    item_norms = (ids.join(per_item, "item_id", "left")
                  .select("item_id", F.coalesce("n2", F.lit(0.0)).alias("n2"),
                          F.coalesce("n1", F.lit(0.0)).alias("n1")))
    if materialize:
        item_norms = cut_lineage(item_norms)
    return TfidfModel(vocab=vocab, weights=weights, item_norms=item_norms, n_docs=n_docs,
                      max_features=max_features or 0, ngram_max=ngram_max, tf=tf)


def tfidf_vectors(model: TfidfModel, items: DataFrame, out_col: str = "tfidf") -> DataFrame:
    """F-2 vector form: (item_id, SparseVector) from the fitted vocabulary.

    Uses the ML feature transformers (CountVectorizerModel → ElementwiseProduct
    → Normalizer), all JVM-side.  The vocabulary and idf are collected once;
    both are bounded by ``max_features``.  When the fitted term frequencies
    are available, each item's term multiset is rebuilt from ``(term, tf)``
    (per item, in place: they are clustered by ``item_id``) instead of
    tokenising the text again; items without vocabulary terms get a zero vector.
    """
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors

    rows = model.vocab.select("term_index", "term", "idf").orderBy("term_index").collect()
    vocab = [r["term"] for r in rows]
    idf = Vectors.dense([r["idf"] for r in rows])
    if model.tf is not None:
        kept = model.tf.join(F.broadcast(model.vocab.select("term")), "term")
        bags = kept.groupBy("item_id").agg(
            F.flatten(F.collect_list(F.array_repeat(F.col("term"), F.col("tf").cast("int")))).alias("terms"))
        docs = (model.item_norms.select("item_id").join(bags, "item_id", "left")
                .select("item_id", F.coalesce("terms", F.array().cast("array<string>")).alias("terms")))
    else:
        docs = with_terms(items.select("item_id", combined_text(items).alias("text")),
                          F.col("text"), "terms", model.ngram_max).select("item_id", "terms")
    cv = CountVectorizerModel.from_vocabulary(vocab, inputCol="terms", outputCol="_tf")
    ep = ElementwiseProduct(scalingVec=idf, inputCol="_tf", outputCol="_raw")
    nm = Normalizer(p=2.0, inputCol="_raw", outputCol=out_col)
    return nm.transform(ep.transform(cv.transform(docs))).select("item_id", out_col)


def genre_multi_hot(df: DataFrame, list_col: str = "genres_list") -> DataFrame:
    """F-4: one row per (item, genre) flag; the long form of a multi-hot matrix."""
    return (df.select("item_id", F.explode(F.array_distinct(list_col)).alias("genre"))
            .withColumn("flag", F.lit(1)))


def transform_items(model: TfidfModel, items: DataFrame) -> DataFrame:
    """Weights of (new) items under a fitted vocabulary and idf: (item_id, term, weight, l1).

    Used to vectorise items that arrive after the fit without refitting; the
    vocabulary is bounded by ``max_features`` and broadcast.
    """
    docs = items.select("item_id", combined_text(items).alias("text"))
    dt = with_terms(docs, F.col("text"), "terms", model.ngram_max).select("item_id", "terms")
    tf = term_frequencies(dt)
    j = tf.join(F.broadcast(model.vocab.select("term", "idf")), "term")
    by_item = Window.partitionBy("item_id")
    w = j.select("item_id", "term", (F.col("tf") * F.col("idf")).alias("raw"))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(by_item))
    return w.select("item_id", "term", (F.col("raw") / norm).alias("weight"),
                    (F.sum("raw").over(by_item) / norm).alias("l1"))
