"""Bounded vocabularies: one sparse row per item, the same terms and weights as from (item, term) rows."""

from collections import Counter

import pytest

from marquee.operators.termrows import ngram_counts
from marquee.operators.tfidf import fit_tfidf, tokenised

ROWS = [(1, "red fox red fox jumps"), (2, "blue fox jumps"), (2, "red fox"), (3, None), (4, ""), (None, "red fox"), (None, "blue"),
        (5, "blue red blue red fox"), (6, "the of and"), (7, "zebra yak")]


def _items(spark, parts):
    return spark.createDataFrame(ROWS, "item_id long, overview string").repartition(parts)


def _told(model):
    weights = {(r["item_id"], r["term"]): (round(r["weight"], 9), round(r["l1"], 9)) for r in model.weights.collect()}
    norms = Counter((r["item_id"], round(r["n2"], 9), round(r["n1"], 9)) for r in model.item_norms.collect())
    return weights, norms


@pytest.mark.parametrize("ngram_max", [1, 2])
@pytest.mark.parametrize("max_features", [1, 3, 6, 50])
def test_rows_equal_long_form(spark, ngram_max, max_features):
    found = fit_tfidf(_items(spark, 3), max_features, ngram_max)
    plain = fit_tfidf(_items(spark, 1), max_features, ngram_max, prune=False)
    # One row per item id (repeated rows make one item), not one per term.
    ids = [r["item_id"] for r in found.rows.collect()]
    assert len(ids) == len(set(ids)) == len({k[0] for k in _told(plain)[0]})
    assert _told(found) == _told(plain)
    columns = ["term", "n_total", "df", "term_index", "idf", "idf_plain"]
    assert found.vocab.select(columns).orderBy("term").collect() == plain.vocab.select(columns).orderBy("term").collect()
    tf = {(r["item_id"], r["term"]): r["tf"] for r in found.tf.collect()}
    assert tf == {(r["item_id"], r["term"]): r["tf"] for r in plain.tf.collect() if (r["item_id"], r["term"]) in tf}


def test_ngram_counts(spark):
    terms = tokenised(_items(spark, 2))
    found = ngram_counts(terms)
    want = Counter()
    for r in terms.collect():
        want.update(r["terms"])
        want.update(" ".join(x) for x in zip(r["terms"], r["terms"][1:]))
    assert {r["term"]: r["n"] for r in found.collect()} == dict(want)
    assert "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_no_items(spark):
    found = fit_tfidf(_items(spark, 1).where("item_id > 100"), 5, 2)
    assert found.vocab.count() == found.weights.count() == found.item_norms.count() == 0


def test_search_writes_no_second_copy_of_the_rows(spark, monkeypatch):
    from marquee.operators import similarity, svd
    model, written = fit_tfidf(_items(spark, 2), 6, 2), []
    for module in (similarity, svd):
        real = module.cut_lineage
        monkeypatch.setattr(module, "cut_lineage", lambda df, real=real: written.append(df.columns) or real(df))
    found = similarity.recommend_sparse(model, spark.createDataFrame([(1,)], "query_id long"), 2).collect()
    assert len(found) == 2 and ["item_id", "idx", "val"] not in written


def test_packed_items_hold_the_same_words_in_less_room(spark):
    from marquee.operators.termrows import item_ids, unpacked, word_counts
    from marquee.operators.tfidf import packed_items
    rows = [(i // 2, " ".join(f"word{(i * j) % 97}" for j in range(200))) for i in range(400)] + ROWS
    items = spark.createDataFrame(rows, "item_id long, overview string").repartition(3)
    plain, slices = tokenised(items), packed_items(items)
    key = lambda r: (r["item_id"] is None, r["item_id"] or 0, r["terms"])
    assert sorted(unpacked(slices).collect(), key=key) == sorted(plain.collect(), key=key)
    assert Counter(item_ids(slices).collect()) == Counter(plain.select("item_id").collect())
    assert Counter(word_counts(slices).collect()) == Counter(word_counts(plain).collect())
    # What is written are whole slices: fewer bytes than the texts have, and no row per item.
    size = sum(len(r["slice"]) for r in slices.collect())
    assert slices.count() <= slices.rdd.getNumPartitions() and size < sum(len(r[1] or "") for r in rows) / 2


def test_models_share_packed_items(spark):
    from marquee.operators import models
    shared = models._shared(_items(spark, 2), reuse=False)
    assert "slice" in shared["terms"].columns
    for most in (3, None):
        found = fit_tfidf(_items(spark, 2), most, 2, **shared)
        assert _told(found) == _told(fit_tfidf(_items(spark, 1), most, 2, prune=False))
