"""Model registry, fit/recommend dispatch, comparison and persistence (R-10 … R-13, E-2, E-17 … E-20, IO-5, IO-6).

Six recommenders share one interface::

    fitted = fit_model(name, catalog)            # distributed fit, timed
    recs = fitted.recommend(queries_df, n=10)    # (query_id, rank, item_id, similarity_score)

A query set is a DataFrame of catalogue ids (``query_id``), so one call
serves many titles.  ``fitted.score(items)`` applies the fitted model to items
that were not in the fit.  Fitted models are kept per (application, dataset,
model, parameters) in a process-local store, but for those that a comparison
fitted (``in_turn``); ``save_models``/``load_models``
(``bundles``) write and read all of a model's artefacts on shared storage.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import combined_text
from ..session import cut_lineage, free_written, partitioned, sized_partitions
from .forest import fit_item_forest
from .linear import fit_item_ridge
from .mlp import fit_mlp, mlp_predictions
from .neighbors import nearest_by_value
from .regress import imputed_target
from .similarity import attach_details, recommend_dense, recommend_sparse
from .svd import fit_svd, project, sparse_rows
from .tfidf import TfidfModel, counted_words, fit_tfidf, packed_items, transform_items

# Display names of the six models (R-10).
MODEL_NAMES = {
    "content_based": "Content-based (TF-IDF)",
    "knn": "K nearest neighbours",
    "random_forest": "Random forest",
    "linear": "Linear regression (ridge)",
    "svd": "SVD (matrix factorisation)",
    "neural": "Neural network (MLP)",
}

# Library parameter sets (the reference's model classes) and the lighter
# "pre-trained" set of its offline build script.
LIBRARY = {
    "content_based": dict(max_features=5000, ngram_max=2),
    "knn": dict(max_features=3000, ngram_max=1, metric="cosine"),
    "random_forest": dict(max_features=1000, numeric=["popularity", "vote_average", "vote_count"],
                          num_trees=100, max_depth=10),
    "linear": dict(max_features=2000, numeric=["popularity", "vote_count"], alpha=1.0),
    "svd": dict(max_features=3000, ngram_max=1, n_components=100),
    "neural": dict(max_features=1000, hidden=(256, 128, 64), max_iter=200),
}
PRETRAINED = {
    "content_based": dict(max_features=3000, ngram_max=2),
    "knn": dict(max_features=3000, ngram_max=2, metric="cosine"),
    "random_forest": dict(max_features=500, numeric=[], num_trees=50, max_depth=8),
    "linear": dict(max_features=500, numeric=[], alpha=1.0),
    "svd": dict(max_features=3000, ngram_max=2, n_components=100),
    "neural": dict(max_features=500, hidden=(128, 64), max_iter=100),
}


VALUED = ("random_forest", "linear", "neural")      # models of a value per item, which can do without text
ROW_BYTES = 100              # about what an item's other columns take


@dataclass
class FittedModel:
    name: str
    params: dict
    fit_seconds: float
    n_items: int
    tfidf: object = None
    predictions: DataFrame | None = None     # value-based models
    factors: DataFrame | None = None         # svd
    extras: dict = field(default_factory=dict)
    state: object = None                     # RidgeModel, FittedForest, MLP tuple or SVD basis
    partitions: int | None = None            # of the fit's and the searches' jobs (None: the session's)

    def recommend(self, queries: DataFrame, n: int = 10) -> DataFrame:
        with partitioned(queries.sparkSession, self.partitions):
            return self._recommend(queries, n)

    def _recommend(self, queries: DataFrame, n: int) -> DataFrame:
        if self.name in ("content_based", "knn"):
            return recommend_sparse(self.tfidf, queries, n, self.params.get("metric", "cosine"))
        if self.name == "svd":
            return recommend_dense(self.factors, queries, n, "cosine")
        eps = 0.0 if self.name == "random_forest" else 1e-10
        return nearest_by_value(self.predictions, queries, n, eps=eps)

    def score(self, items: DataFrame) -> DataFrame:
        """What the model gives for items that need not have been in the fit: ``item_id`` with ``prediction`` (forest,
        ridge, MLP), ``vec`` (SVD) or one row per ``term`` with its ``weight`` (content-based, KNN)."""
        weights = transform_items(self.tfidf, items) if self.tfidf is not None else None
        if self.name in ("content_based", "knn"):
            return weights.select("item_id", "term", "weight")
        if self.name == "svd":
            return project(items.select("item_id"), sparse_rows(self.tfidf, weights), self.state)
        if self.name == "neural":
            rows = items.select("item_id").join(sparse_rows(self.tfidf, weights), "item_id", "left")
            return mlp_predictions(rows, self.state)
        return self.state.predict(items, weights)


_STORE: dict = {}


def _key(catalog: DataFrame, name: str, params: dict):
    sc = catalog.sparkSession.sparkContext
    return (sc.applicationId, catalog.semanticHash(), name, json.dumps(params, sort_keys=True, default=str))


def _shared(catalog: DataFrame, reuse: bool) -> dict[str, DataFrame]:
    """The catalogue's tokens and their counts, shared by all models fitted on it."""
    key = _key(catalog, "tokens", {})
    if reuse and key in _STORE:
        return _STORE[key]
    terms = packed_items(catalog)
    found = {"terms": terms, "counts": counted_words(terms)}
    free_written(catalog.sparkSession)
    if reuse:
        _STORE[key] = found
    return found


def _text_params(name: str, params: dict) -> dict:
    return {"max_features": params.get("max_features"), "ngram_max": 1 if name in VALUED else params.get("ngram_max", 1)}


def _text_model(name: str, catalog: DataFrame, params: dict, reuse: bool) -> tuple[TfidfModel, float]:
    """The TF-IDF model of the parameters' vocabulary, shared by the models that have the same one, and the seconds that an
    earlier fit of it took (0 if it was fitted now)."""
    wanted = _text_params(name, params)
    key = _key(catalog, "tfidf", wanted)
    if reuse and key in _STORE:
        return _STORE[key]
    shared, t0 = _shared(catalog, reuse), time.perf_counter()
    found = fit_tfidf(catalog, **wanted, **shared)
    if reuse:
        _STORE[key] = found, time.perf_counter() - t0
    return found, 0.0


def _measured(catalog: DataFrame, text: bool, reuse: bool) -> tuple[int, int]:
    """Number of items, and about how many bytes their rows have (``text``: with the text that the models read)."""
    key = _key(catalog, "size", {"text": text})
    if reuse and key in _STORE:
        return _STORE[key]
    size = F.sum(F.octet_length(combined_text(catalog))) if text else F.lit(0)
    n, held = catalog.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    found = n, held + ROW_BYTES * n
    if reuse:
        _STORE[key] = found
    return found


def fit_model(name: str, catalog: DataFrame, params: dict | None = None, reuse: bool = True) -> FittedModel:
    """Fit one of the six models on the whole catalogue (R-11); timed (R-13)."""
    if name not in MODEL_NAMES:
        raise KeyError(f"unknown model {name!r}")
    params = dict(LIBRARY[name] if params is None else params)
    key = _key(catalog, name, params)
    if reuse and key in _STORE:
        return _STORE[key]
    t0 = time.perf_counter()
    spark = catalog.sparkSession
    n_items, size = _measured(catalog, bool(params["max_features"]), reuse)
    partitions = sized_partitions(spark, size)
    with partitioned(spark, partitions):
        # max_features = 0: numeric features only (no text vector).
        tf, earlier = _text_model(name, catalog, params, reuse) if params["max_features"] or name not in VALUED else (None, 0.0)
        fitted = _fitted(name, catalog, params, n_items, tf)
    fitted.partitions = partitions
    fitted.fit_seconds = earlier + time.perf_counter() - t0
    if reuse:
        _STORE[key] = fitted
    free_written(spark)
    return fitted


def _fitted(name: str, catalog: DataFrame, params: dict, n_items: int, tf: TfidfModel | None) -> FittedModel:
    if name in ("content_based", "knn"):
        fitted = FittedModel(name, params, 0.0, n_items, tfidf=tf)
    elif name == "svd":
        sv = fit_svd(tf, params["n_components"])
        fitted = FittedModel(name, params, 0.0, n_items, tfidf=tf, factors=cut_lineage(sv.factors), state=sv.basis,
                             extras={"explained_variance_ratio": sv.explained_variance_ratio,
                                     "singular_values": [float(x) for x in sv.singular_values]})
    else:
        label, extras = imputed_target(catalog), {}
        if name == "neural":
            rows = tf.item_norms.select("item_id").join(sparse_rows(tf), "item_id", "left")
            # Not written here: the fit keeps its own copy, as batches.
            data = catalog.select("item_id", label.alias("label")).join(rows, "item_id").select("item_id", "idx", "val", "label")
            state = fit_mlp(data, tf.vocab.count(), tuple(params["hidden"]), params["max_iter"])
            preds = mlp_predictions(data, state)
            extras = {"validation_scores": [float(x) for x in state[4]]}
        else:
            if name == "linear":
                state = fit_item_ridge(catalog, tf, params["numeric"], label, params["alpha"])
            else:
                state = fit_item_forest(catalog, tf, params["numeric"], label, params["num_trees"], params["max_depth"])
            preds = state.predict(catalog, tf.weights if tf is not None else None)
        fitted = FittedModel(name, params, 0.0, n_items, tfidf=tf, predictions=cut_lineage(preds), extras=extras,
                             state=state)
    return fitted


def clear_store() -> None:
    _STORE.clear()


def in_turn(catalog: DataFrame, names: list[str], params: dict | None = None):
    """(name, fitted model, or the exception that its fit raised) of each model, those of one vocabulary after each other.

    What is fitted here leaves the store, and its files the disks, when the next vocabulary's turn comes: a comparison needs
    a model until it was asked.  The catalogue's tokens stay, and so does what was in the store before.
    """
    groups: dict[str, list] = {}
    for name in names:
        own = (params or {}).get(name) or LIBRARY.get(name, {})
        groups.setdefault(json.dumps(_text_params(name, own)), []).append(name)
    shared = {_key(catalog, "tokens", {}), *(_key(catalog, "size", {"text": x}) for x in (True, False))}
    for some in groups.values():
        before = set(_STORE) | shared
        try:
            for name in some:
                try:
                    fitted = fit_model(name, catalog, (params or {}).get(name))
                except Exception as e:  # noqa: BLE001 - a failed model is told, others continue
                    fitted = e
                yield name, fitted
                del fitted
        finally:
            for key in set(_STORE) - before:
                del _STORE[key]
            free_written(catalog.sparkSession)


def recommend_titles(fitted: FittedModel, catalog: DataFrame, titles: DataFrame, n: int = 10) -> DataFrame:
    """R-12: titles → first matching item → recommendations with details; unknown titles give nothing."""
    from .clean import lookup_titles
    q = lookup_titles(catalog, titles).select(F.col("item_id").alias("query_id"))
    return attach_details(fitted.recommend(q, n), catalog, fitted.name)


def recommend_by_name(fitted: dict[str, FittedModel], name: str, catalog: DataFrame, titles: DataFrame,
                      n: int = 10) -> DataFrame:
    """R-12 by model name: an unknown model gives an empty table."""
    if name in fitted:
        return recommend_titles(fitted[name], catalog, titles, n)
    return attach_details(_no_recommendations(catalog.sparkSession), catalog, name)


def _no_recommendations(spark) -> DataFrame:
    return spark.createDataFrame([], "query_id long, rank int, item_id long, similarity_score double")


def _recommend_blocks(fitted: FittedModel, catalog: DataFrame, q: DataFrame, n: int) -> tuple[list, float, list]:
    """(tables of recommendations, seconds, failed queries) for all of ``q(query_id)``.

    All queries are one block at first.  A block that fails is cut in two by a hash of the id, until the queries that
    fail stand alone; the others keep their recommendations.  What fails without any query is the model's failure, and
    is raised.
    """
    done, seconds, failed, todo = [], 0.0, [], [(1, 0)]
    while todo:
        parts, k = todo.pop()
        block = q.where(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == k) if parts > 1 else q
        try:
            t0 = time.perf_counter()
            with partitioned(catalog.sparkSession, fitted.partitions):
                done.append(cut_lineage(attach_details(fitted.recommend(block, n), catalog, fitted.name)))
            seconds += time.perf_counter() - t0
        except Exception as e:  # noqa: BLE001 - the failed query is skipped, the others continue
            some = [r["query_id"] for r in block.limit(2).collect()]
            if len(some) > 1:
                todo += [(2 * parts, k), (2 * parts, k + parts)]
            elif some:
                failed.append((some[0], e))
            else:
                raise
    return done, seconds, failed


def compare(catalog: DataFrame, queries: DataFrame, names: list[str] | None = None, n: int = 10,
            params: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """E-2, E-17, E-19, E-20: fit and query every model; measured times, failures recorded.

    Returns ``(recs, timings)``; ``timings`` has model, model_order, fit_seconds, recommend_seconds (per answered
    query), status and n_failed.  A model that cannot be fitted, or fails for all queries, has an error as its status;
    a query that fails alone is left out and counted.  Tables that don't show status and n_failed are no results unless
    ``require_whole`` lets the timings pass.
    """
    spark = catalog.sparkSession
    names = names or list(MODEL_NAMES)
    q = cut_lineage(queries.select("query_id").distinct())
    n_q = q.count()
    recs, rows = None, []
    for name, fitted in in_turn(catalog, names, params):
        order = names.index(name)
        try:
            if isinstance(fitted, Exception):
                raise fitted
            done, seconds, failed = _recommend_blocks(fitted, catalog, q, n)
            if failed and len(failed) == n_q:
                raise failed[0][1]
        except Exception as e:  # noqa: BLE001 - a failed model is skipped, others continue
            rows.append((name, order, None, None, f"error: {type(e).__name__}: {e}"[:500], n_q))
            fitted = None
            continue
        for r in done:
            recs = r if recs is None else recs.unionByName(r)
        rows.append((name, order, float(fitted.fit_seconds), seconds / max(n_q - len(failed), 1), "ok", len(failed)))
        fitted = None                            # else it would still be held when its files may go
    timings = spark.createDataFrame(rows, "model string, model_order int, fit_seconds double, "
                                          "recommend_seconds double, status string, n_failed int")
    if recs is None:
        recs = attach_details(_no_recommendations(spark), catalog, "")
    return recs, timings


class IncompleteComparison(RuntimeError):
    """Some model or query of a comparison failed, so that tables made from its recommendations lack rows."""


def failures(timings: DataFrame) -> list[str]:
    """What failed in a comparison, a line per model."""
    bad = timings.where((F.col("status") != "ok") | (F.col("n_failed") > 0)).orderBy("model_order").collect()
    return [f"{r['model']}: {r['status'] if r['status'] != 'ok' else 'no recommendations'} ({r['n_failed']} queries)" for r in bad]


def require_whole(timings: DataFrame) -> None:
    """Raises ``IncompleteComparison`` if a model or a query of the comparison failed."""
    bad = failures(timings)
    if bad:
        raise IncompleteComparison("the comparison is not whole: " + "; ".join(bad))


def feature_importance(fitted: FittedModel, top_n: int | None = 20) -> DataFrame:
    """R-5: the ``top_n`` features of a fitted forest by importance, named by term or numeric column (None: all)."""
    forest = fitted.state
    spark = (fitted.predictions if fitted.predictions is not None else fitted.tfidf.vocab).sparkSession
    rows = [(k, float(v)) for k, v in enumerate(forest.model.importance())]
    shares = spark.createDataFrame(rows, "feature int, importance double")
    names = spark.createDataFrame([(forest.n_text + k, c) for k, c in enumerate(forest.numeric)], "feature int, name string")
    if forest.cuts is not None:
        names = names.unionByName(forest.cuts.select("feature", F.col("term").alias("name")))
    out = shares.join(names, "feature").select(F.col("name").alias("feature"), "importance")
    return out if top_n is None else out.orderBy(F.desc("importance"), F.asc("feature")).limit(top_n)


def save_models(fitted: dict[str, FittedModel], path: str, content_type: str = "all") -> None:
    """IO-5: writes a bundle of the models (see ``bundles.save_bundle``)."""
    from .bundles import save_bundle
    save_bundle(fitted, path, content_type)


def load_models(spark, path: str, names: list[str] | None = None, content_type: str = "all") -> dict[str, FittedModel]:
    """IO-6: reads the newest whole bundle (see ``bundles.load_bundle``); a missing bundle or model raises."""
    from .bundles import load_bundle
    return load_bundle(spark, path, names, content_type)
