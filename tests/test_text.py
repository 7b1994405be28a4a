"""S-6 … S-9 and F-1/F-2 against closed forms."""

import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from marquee.functions.text import ENGLISH_STOP_WORDS, combined_text, tokens, with_terms
from marquee.operators.tfidf import fit_tfidf, tfidf_vectors


def test_stop_words_are_sparks_default(spark):
    from pyspark.ml.feature import StopWordsRemover
    assert ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens_unicode_and_case(spark):
    df = spark.createDataFrame([("Élan vital, x 42 über_alles a-b!",)], "t string")
    assert df.select(tokens("t")).first()[0] == ["élan", "vital", "42", "über_alles"]


def test_terms_with_bigrams_after_stop_words(spark):
    df = spark.createDataFrame([(1, "The cat and the hat sat"), (2, "one"), (3, None)], "item_id long, t string")
    out = dict(with_terms(df, F.col("t"), "terms", 2).select("item_id", "terms").collect())
    assert out[1] == ["cat", "hat", "sat", "cat hat", "hat sat"]
    assert out[2] == ["one"] and out[3] == []


def test_combined_text_skips_missing_and_null(spark):
    df = spark.createDataFrame([("A, B", None, "", "x y")], "genres_str string, keywords_str string, "
                                                          "director string, overview string")
    assert df.select(combined_text(df)).first()[0] == "A, B  x y"


DOCS = [(1, "red apple red fruit"), (2, "green apple"), (3, "fruit salad with apple"), (4, "the and of")]


def _items(spark):
    return spark.createDataFrame([(i, t, "") for i, t in DOCS], "item_id long, overview string, genres_str string")


def _numpy_tfidf(max_features=None):
    toks = [[w for w in t.lower().split() if w not in ENGLISH_STOP_WORDS and len(w) >= 2] for _, t in DOCS]
    total = Counter(w for d in toks for w in d)
    vocab = sorted(total, key=lambda w: (-total[w], w))[:max_features]
    n = len(DOCS)
    df = {w: sum(1 for d in toks if w in d) for w in vocab}
    out = {}
    for (i, _), d in zip(DOCS, toks):
        c = Counter(w for w in d if w in vocab)
        raw = {w: c[w] * (math.log((1 + n) / (1 + df[w])) + 1) for w in c}
        nrm = math.sqrt(sum(v * v for v in raw.values()))
        for w, v in raw.items():
            out[(i, w)] = v / nrm
    return vocab, out


def test_tfidf_long_form_matches_closed_form(spark):
    m = fit_tfidf(_items(spark), max_features=4, ngram_max=1)
    vocab, want = _numpy_tfidf(4)
    assert sorted(r["term"] for r in m.vocab.collect()) == sorted(vocab)
    got = {(r["item_id"], r["term"]): r["weight"] for r in m.weights.collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k] - want[k]) < 1e-12
    norms = {r["item_id"]: (r["n2"], r["n1"]) for r in m.item_norms.collect()}
    assert norms[4] == (0.0, 0.0) and abs(norms[1][0] - 1.0) < 1e-12


def test_vector_form_equals_long_form(spark):
    items = _items(spark)
    m = fit_tfidf(items, max_features=None, ngram_max=1)
    m = fit_tfidf(items, max_features=50, ngram_max=1)
    vocab = [r["term"] for r in m.vocab.orderBy("term_index").collect()]
    vecs = {r["item_id"]: r["tfidf"].toArray() for r in tfidf_vectors(m, items).collect()}
    for r in m.weights.collect():
        assert abs(vecs[r["item_id"]][vocab.index(r["term"])] - r["weight"]) < 1e-12
    assert np.allclose(vecs[4], 0.0)
