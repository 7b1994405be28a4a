"""Registered queries: ``(spark, sf_dir) -> DataFrame`` per operator of the inventory.

Every query reads whole driver tables (through the adapters) and returns a
lazy DataFrame; the caller triggers the action.  Column names match the SQL
oracle in ``plans.oracle``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.jsoncols import first_by_job, first_n_names, json_names, split_trim
from ..functions.text import combined_text, drop_stop_words, tokens, with_terms
from ..operators import clean, evaluate, models, stats, topk
from ..operators.neighbors import nearest_by_value
from ..operators.similarity import attach_details, recommend_dense, recommend_sparse
from ..operators.termrows import ngram_counts
from ..operators.tfidf import genre_multi_hot
from ..operators.allitems import all_items_topk
from ..session import cut_lineage, ensure_checkpoint_dir, partitioned
from ..sources import adapters
from ..sources.tables import read_table

# Parameters shared with the oracle (the reference's library defaults).
SEED = 42
N_QUERIES = 20           # evaluate_all: up to 20 popular test items
SEARCH_EVERY = 100       # searches ask for every id divisible by this
MIN_VOTES_QUERY = 100
N_RECS = 10
CB_FEATURES, CB_NGRAM = 5000, 2      # content-based vectoriser
KNN_FEATURES, KNN_NGRAM = 3000, 1    # KNN vectoriser
FILM_NUMERIC = ["budget", "revenue", "runtime", "popularity", "vote_average", "vote_count"]
SERIES_NUMERIC = ["number_of_seasons", "number_of_episodes", "popularity", "vote_average", "vote_count"]

# Fixed per-model timings used by the comparison queries (seconds): the
# reference's published example table.  Measured timings replace these in
# ``models.compare``; fixed values keep the comparison checkable by SQL.
EXAMPLE_TIMINGS = [
    ("content_based", 0, 1.2, 0.01),
    ("knn", 1, 0.8, 0.02),
    ("linear", 2, 0.5, 0.01),
]


def _films(spark, d):
    return adapters.films(spark, d)


def _series(spark, d):
    return adapters.series(spark, d)


def _items(spark, d):
    return adapters.items(spark, d)


def _queries(catalog: DataFrame) -> DataFrame:
    """E-1: the evaluation's sample of popular items."""
    return evaluate.sample_items(catalog, N_QUERIES, MIN_VOTES_QUERY, SEED)


def _asked(catalog: DataFrame) -> DataFrame:
    """The query set of the searches: every item whose id is divisible by 100, against all items."""
    return catalog.where(F.col("item_id") % SEARCH_EVERY == 0).select(F.col("item_id").alias("query_id"))


# ---------------------------------------------------------------- recommenders

def q_content_based(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d)
    model = models.fit_model("content_based", items)
    return attach_details(model.recommend(_asked(items), N_RECS), items)


def q_all_items_topk(spark: SparkSession, d: str) -> DataFrame:
    """R-14: the content-based model's similarity matrix, as far as a user can see it: every item against all others."""
    return all_items_topk(models.fit_model("content_based", _items(spark, d)).tfidf, None, N_RECS)


def _knn(metric):
    def q(spark: SparkSession, d: str) -> DataFrame:
        items = _items(spark, d)
        model = models.fit_model("knn", items)
        return recommend_sparse(model.tfidf, _asked(items), N_RECS, metric)
    q.__name__ = f"q_knn_{metric}"
    return q


q_knn_cosine = _knn("cosine")
q_knn_euclidean = _knn("euclidean")
q_knn_manhattan = _knn("manhattan")


def _embedding_vectors(spark, d):
    return read_table(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"),
                                                     F.col("embedding").alias("vec"), "label")


def _knn_dense(metric):
    def q(spark: SparkSession, d: str) -> DataFrame:
        vecs = _embedding_vectors(spark, d)
        return recommend_dense(vecs.select("item_id", "vec"), _asked(vecs), N_RECS, metric)
    q.__name__ = f"q_knn_embeddings_{metric}"
    return q


q_knn_embeddings_cosine = _knn_dense("cosine")
q_knn_embeddings_euclidean = _knn_dense("euclidean")
q_knn_embeddings_manhattan = _knn_dense("manhattan")


def q_nearest_by_value(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d)
    preds = items.select("item_id", F.col("vote_average").alias("prediction"))
    return nearest_by_value(preds, _asked(items), N_RECS, eps=1e-10)


RIDGE2 = dict(max_features=0, numeric=["popularity", "vote_count"], alpha=1.0)


def q_ridge_two_features(spark: SparkSession, d: str) -> DataFrame:
    items = _items(spark, d)
    return models.fit_model("linear", items, RIDGE2).recommend(_asked(items), N_RECS)


def q_ridge_coefficients(spark: SparkSession, d: str) -> DataFrame:
    """R-6: intercept and coefficients of the scaled columns."""
    c = models.fit_model("linear", _items(spark, d), RIDGE2).state.coefficients(spark)
    return c.select("feature", F.round("coefficient", 6).alias("coefficient"))


def q_bundle_scores(spark: SparkSession, d: str) -> DataFrame:
    """IO-5, IO-6: a model saved, read back and applied to every item."""
    items = _items(spark, d)
    path = f"{ensure_checkpoint_dir(spark)}/bundle-{uuid.uuid4().hex}"
    models.save_models({"linear": models.fit_model("linear", items, RIDGE2)}, path)
    scores = models.load_models(spark, path, ["linear"])["linear"].score(items)
    return scores.select("item_id", F.round("prediction", 6).alias("prediction"))


# Models fitted by iterative estimators: no SQL oracle (rows-only check plus
# the numeric tests under tests/).

def _value_model(name):
    def q(spark: SparkSession, d: str) -> DataFrame:
        items = _items(spark, d)
        return attach_details(models.fit_model(name, items).recommend(_asked(items), N_RECS), items, name)
    q.__name__ = f"q_{name}_recommend"
    return q


q_rf_recommend = _value_model("random_forest")
q_ridge_recommend = _value_model("linear")
q_svd_recommend = _value_model("svd")
q_mlp_recommend = _value_model("neural")


def q_feature_importance(spark, d):
    return models.feature_importance(models.fit_model("random_forest", _items(spark, d)))


def q_fit_metadata(spark, d):
    """R-13: model, display name, fit seconds and item count of the six fitted models."""
    items = _items(spark, d)
    rows = []
    for name, fm in models.in_turn(items, list(models.MODEL_NAMES)):
        if isinstance(fm, Exception):
            raise fm
        rows.append((name, models.MODEL_NAMES[name], float(fm.fit_seconds), int(fm.n_items)))
        fm = None
    rows.sort(key=lambda r: list(models.MODEL_NAMES).index(r[0]))
    return spark.createDataFrame(rows, "model string, display_name string, fit_seconds double, n_items long")


def q_model_comparison(spark, d):
    """E-2, E-8, E-17, E-19, E-20 with measured times: all six models, one comparison table.

    A model that failed has its row too, with the error as its status and no scores.
    """
    recs, timings, items = _six_models(spark, d)
    ok = timings.where(F.col("status") == "ok")
    m = evaluate.model_metrics(recs, items).join(F.broadcast(ok), "model")
    scored = evaluate.comparison_score(m)
    scored = timings.select("model", "status", "n_failed").join(scored.drop("status", "n_failed"), "model", "left")
    return scored.select("model", "status", "n_failed", "fit_seconds", "recommend_seconds", F.round("coverage", 6).alias("coverage"),
                         F.round("diversity", 6).alias("diversity"), F.round("avg_rating", 6).alias("avg_rating"),
                         F.round("precision", 6).alias("precision"), F.round("total_score", 6).alias("total_score"))


def q_svd_explained_variance(spark, d):
    fm = models.fit_model("svd", _items(spark, d))
    return spark.createDataFrame([(fm.params["n_components"], float(fm.extras["explained_variance_ratio"]))],
                                 "n_components int, explained_variance_ratio double")


# ---------------------------------------------------------------- evaluation

_RECS: dict = {}


def _recs_all(spark, d) -> tuple[DataFrame, DataFrame]:
    """Recommendations of the three SQL-checkable models for the sampled queries.

    The (small) table is checkpointed once per session and dataset and shared
    by the evaluation queries, like the reference's evaluation run.
    """
    items = _items(spark, d)
    key = (spark.sparkContext.applicationId, d)
    if key not in _RECS:
        queries = _queries(items)
        parts = [("content_based", models.fit_model("content_based", items)),
                 ("knn", models.fit_model("knn", items)),
                 ("linear", models.fit_model("linear", items, RIDGE2))]
        recs = None
        with partitioned(spark, max(fm.partitions for _, fm in parts)):
            queries = cut_lineage(queries)
            for name, fm in parts:
                r = attach_details(fm.recommend(queries, N_RECS), items, name)
                recs = r if recs is None else recs.unionByName(r)
            _RECS[key] = cut_lineage(recs)
    return _RECS[key], items


_SIX: dict = {}


def _six_models(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Recommendations of all six models with the library's parameters, measured times, and the catalogue.

    Written once per session and dataset: ``cut_lineage`` in ``compare`` keeps each model's rows.  What has a failure in it
    is not kept, so that the next query tries again.
    """
    items = _items(spark, d)
    key = (spark.sparkContext.applicationId, d)
    found = _SIX[key] if key in _SIX else models.compare(items, _queries(items), n=N_RECS)
    if not models.failures(found[1]):
        _SIX[key] = found
    return *found, items


def _six_whole(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``_six_models`` for tables that have no place for a failure: a failed model or query raises."""
    recs, timings, items = _six_models(spark, d)
    models.require_whole(timings)
    return recs, timings, items


def q_six_model_recs(spark, d):
    """E-2: the recommendations of all six models."""
    return _six_whole(spark, d)[0]


def _six_scored(spark, d) -> DataFrame:
    recs, timings, items = _six_whole(spark, d)
    timed = timings.withColumn("recommend_ms", F.col("recommend_seconds") * 1000)
    return evaluate.quality_score(evaluate.model_metrics(recs, items).join(F.broadcast(timed), "model"))


def q_six_model_metrics(spark, d):
    """E-3 to E-8, E-11, E-16 of all six models, with measured times."""
    scored = _six_scored(spark, d)
    cols = ["model", "n_recs", "n_queries", "coverage", "diversity", "avg_rating", "precision", "quality_score"]
    both = evaluate.comparison_score(scored).select("model", F.round("total_score", 6).alias("total_score"))
    passed = evaluate.acceptance(scored).select("model", "accepted", "pass_rate", "band")
    return scored.select(*cols).join(both, "model").join(passed, "model")


def q_six_model_agreement(spark, d):
    """E-9: agreement of all pairs of the six models."""
    return evaluate.agreement_matrix(_six_whole(spark, d)[0])


def q_six_model_confusion(spark, d):
    """E-10 of all six models."""
    return evaluate.confusion(_six_whole(spark, d)[0])


def q_six_model_best(spark, d):
    """E-12, E-13: the best of the six models for each priority and category."""
    scored = evaluate.comparison_score(_six_scored(spark, d))
    out = evaluate.best_per_category(scored)
    for p in ["balanced", "speed", "quality", "coverage"]:
        best = evaluate.best_for_priority(scored, p)
        out = out.unionByName(best.select(F.col("priority").alias("category"), "model"))
    return out


def _timings(spark) -> DataFrame:
    return spark.createDataFrame(EXAMPLE_TIMINGS, "model string, model_order int, fit_seconds double, "
                                                  "recommend_seconds double")


def _metrics(spark, d) -> DataFrame:
    recs, items = _recs_all(spark, d)
    m = evaluate.model_metrics(recs, items)
    return (m.join(F.broadcast(_timings(spark)), "model")
            .withColumn("recommend_ms", F.col("recommend_seconds") * 1000))


def q_sample_items(spark, d):
    return _queries(_items(spark, d))


def q_recs_all_models(spark, d):
    return _recs_all(spark, d)[0]


def q_coverage(spark, d):
    recs, items = _recs_all(spark, d)
    return evaluate.coverage(recs, items)


def q_diversity_strings(spark, d):
    return evaluate.diversity_strings(_recs_all(spark, d)[0])


def q_diversity_tags(spark, d):
    return evaluate.diversity_tags(_recs_all(spark, d)[0])


def q_avg_rating(spark, d):
    return evaluate.avg_rating(_recs_all(spark, d)[0])


def q_precision(spark, d):
    return evaluate.precision(_recs_all(spark, d)[0])


def _scored(spark, d):
    return evaluate.quality_score(_metrics(spark, d))


def q_quality_score(spark, d):
    return _scored(spark, d).select("model", F.round("quality_score", 6).alias("quality_score"))


def q_comparison_score(spark, d):
    return evaluate.comparison_score(_metrics(spark, d)).select(
        "model", F.round("coverage", 6).alias("coverage"), F.round("diversity", 6).alias("diversity"),
        F.round("avg_rating", 6).alias("avg_rating"), F.round("total_score", 6).alias("total_score"))


def q_agreement_matrix(spark, d):
    return evaluate.agreement_matrix(_recs_all(spark, d)[0])


def q_confusion(spark, d):
    return evaluate.confusion(_recs_all(spark, d)[0])


def q_acceptance(spark, d):
    return evaluate.acceptance(_scored(spark, d))


def q_best_for_priority(spark, d):
    m = evaluate.comparison_score(_metrics(spark, d))
    out = None
    for p in ["balanced", "speed", "quality", "coverage"]:
        b = evaluate.best_for_priority(m, p)
        out = b if out is None else out.unionByName(b)
    return out


def q_best_per_category(spark, d):
    return evaluate.best_per_category(evaluate.quality_score(_metrics(spark, d)))


def q_best_flags(spark, d):
    s = _scored(spark, d)
    return evaluate.best_flags(s, ["quality_score", "avg_rating", "precision", "diversity"],
                               ["recommend_ms"]).select(
        "model", "best_quality_score", "best_avg_rating", "best_precision", "best_diversity", "best_recommend_ms")


def q_radar_metrics(spark, d):
    return evaluate.radar_metrics(_metrics(spark, d))


def q_metric_percent(spark, d):
    return evaluate.metric_percent(_scored(spark, d))


def q_detailed_metrics(spark, d):
    return evaluate.detailed_metrics(_metrics(spark, d))


# ---------------------------------------------------------------- text features

def q_vocabulary(spark, d):
    model = models.fit_model("content_based", _items(spark, d)).tfidf
    return model.vocab.select("term", F.col("n_total").cast("bigint").alias("n_total"),
                              F.col("df").cast("bigint").alias("df"), F.round("idf", 6).alias("idf"))


def q_tfidf_weights(spark, d):
    model = models.fit_model("knn", _items(spark, d)).tfidf
    return model.weights.select("item_id", "term", F.round("weight", 6).alias("weight"))


def q_token_counts(spark, d):
    items = _items(spark, d)
    t = items.select("item_id", tokens(combined_text(items)).alias("t"))
    return t.select("item_id", F.size("t").alias("n_tokens"),
                    F.size(drop_stop_words("t")).alias("n_kept"))


def q_ngrams(spark, d):
    items = _items(spark, d)
    t = with_terms(items.select(combined_text(items).alias("text")), F.col("text"), "terms", 1)
    return ngram_counts(t).withColumnRenamed("n", "n_total")


def q_combined_text(spark, d):
    f = _films(spark, d)
    return f.select("item_id", combined_text(f).alias("text"))


def q_genre_multi_hot(spark, d):
    return genre_multi_hot(_films(spark, d)).select("item_id", "genre", F.col("flag").cast("int").alias("flag"))


# ---------------------------------------------------------------- JSON / scalar functions

def q_json_names(spark, d):
    cr = adapters.raw_credits(spark, d)
    return cr.select("movie_id", F.array_join(json_names("cast"), ", ").alias("names"))


def q_json_non_list(spark, d):
    ev = read_table(spark, d, "events").select("event_id", "props")
    return ev.select("event_id", F.size(json_names("props")).cast("int").alias("n_names"))


def q_first_by_role(spark, d):
    cr = adapters.raw_credits(spark, d)
    return cr.select("movie_id", first_by_job("crew", "Director").alias("director"))


def q_first_n_names(spark, d):
    cr = adapters.raw_credits(spark, d)
    return cr.select("movie_id", F.array_join(first_n_names("cast", 3), ", ").alias("cast_str"))


def q_split_trim(spark, d):
    s = adapters.raw_series(spark, d)
    g = split_trim("genres")
    return s.select(F.col("id").alias("item_id"), F.array_join(g, "|").alias("genres_joined"),
                    F.size(g).cast("int").alias("n_genres"))


# ---------------------------------------------------------------- cleaning / joins

def q_catalog_projection(spark, d):
    return clean.catalog_projection(clean.drop_null(_films(spark, d)))


def q_fill_missing(spark, d):
    s = adapters.raw_series(spark, d).withColumnRenamed("name", "title")
    f = clean.fill_missing_text(s, ["overview", "tagline", "created_by", "genres"])
    return f.select(F.col("id").alias("item_id"), "title", "overview", "tagline", "created_by", "genres")


def q_drop_null_title(spark, d):
    return clean.drop_null(_films(spark, d), ["title"]).select("item_id", "title")


def q_filter_voted(spark, d):
    return clean.filter_voted(_series(spark, d), 1).select("item_id", "title", "vote_count")


def q_filter_reliable(spark, d):
    return clean.filter_reliable(_series(spark, d), 10, 0.0).select("item_id", "title", "vote_count",
                                                                     "vote_average")


def q_popularity_vs_rating(spark, d):
    return clean.pair_without_nulls(_films(spark, d), "popularity", "vote_average")


def q_rating_values(spark, d):
    return clean.values_without_nulls(_films(spark, d), "vote_average")


def q_title_search(spark, d):
    return clean.title_search(_films(spark, d), "ring")


def q_catalog_credits_left_join(spark, d):
    j = clean.left_join_suffixed(adapters.raw_films(spark, d), adapters.raw_credits(spark, d), "id", "movie_id")
    return j.select("id", "title", "movie_id", "title_credits")


def _plain_parts(spark, d):
    return read_table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def q_title_lookup(spark, d):
    parts = _plain_parts(spark, d)
    return clean.lookup_titles(parts, parts.select("title"))


def q_title_lookup_missing(spark, d):
    parts = _plain_parts(spark, d)
    return clean.lookup_titles(parts, parts.select(F.concat("title", F.lit(" (unreleased)")).alias("title")))


def q_catalog_union(spark, d):
    return clean.union_catalogs(clean.catalog_projection(_films(spark, d)),
                                clean.catalog_projection(_series(spark, d)))


def q_stage_counts(spark, d):
    return clean.stage_counts(adapters.raw_series(spark, d))


# ---------------------------------------------------------------- statistics

def q_stats_summary(spark, d):
    return stats.stats_summary(_films(spark, d), _series(spark, d))


def q_distinct_genres(spark, d):
    return stats.distinct_genres(_films(spark, d), _series(spark, d))


def q_missing_counts(spark, d):
    j = clean.left_join_suffixed(adapters.raw_films(spark, d), adapters.raw_credits(spark, d), "id", "movie_id")
    return stats.missing_counts(j)


def q_genre_distribution(spark, d):
    return stats.genre_distribution(_films(spark, d), "genres_list", 20)


def q_genre_distribution_text(spark, d):
    return stats.genre_distribution_text(_series(spark, d), "genres_str", 15)


def q_rating_center(spark, d):
    return stats.rating_center(_films(spark, d))


def q_rating_histogram(spark, d):
    return stats.histogram(_films(spark, d), "vote_average", 20)


def q_correlation_matrix(spark, d):
    return stats.correlation_matrix(_films(spark, d), FILM_NUMERIC)


def q_correlation_lower(spark, d):
    return stats.correlation_lower(_series(spark, d), SERIES_NUMERIC)


def q_describe(spark, d):
    return stats.describe(_films(spark, d), FILM_NUMERIC)


def q_impute_mean(spark, d):
    return stats.impute_mean(_films(spark, d), "vote_average").select(
        "item_id", F.round("vote_average", 6).alias("vote_average"))


def q_standard_scale(spark, d):
    s = stats.standard_scale(_films(spark, d), ["popularity", "vote_count"])
    return s.select("item_id", F.round("popularity_scaled", 6).alias("popularity_scaled"),
                    F.round("vote_count_scaled", 6).alias("vote_count_scaled"))


def q_minmax_normalize(spark, d):
    f = stats.minmax_normalize(_films(spark, d), "popularity")
    f = stats.minmax_normalize(f, "popularity", inverse=True)
    return f.select("item_id", F.round("popularity_norm", 6).alias("popularity_norm"),
                    F.round("popularity_inv", 6).alias("popularity_inv"))


# ---------------------------------------------------------------- top-n

def q_top_content_film(spark, d):
    return topk.top_content(_films(spark, d), "vote_average", 10, 100)


def q_top_content_series(spark, d):
    return topk.top_content(_series(spark, d), "vote_average", 10, 50)


def q_top_rated(spark, d):
    return topk.top_content(_series(spark, d), "vote_average", 10, 0)


def q_top_popular_sample(spark, d):
    raw = clean.filter_reliable(adapters.raw_series(spark, d), 10, 0.0)
    top = topk.top_popular_sample(raw.withColumn("item_id", F.col("id")).withColumnRenamed("name", "title"), 5000)
    return top.select("item_id", "title", "popularity")


def registered() -> dict:
    g = globals()
    return {k: v for k, v in g.items() if k.startswith("q_") and callable(v)}
