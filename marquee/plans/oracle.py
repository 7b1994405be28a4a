"""Independent SQL (DuckDB dialect) for the registered queries.

The adapters are re-derived from the raw tables as CTEs; JSON-list columns are
not re-parsed here (the oracle reads the conversation rows directly), so a
bug in the JSON expressions shows up as a mismatch.
"""

from __future__ import annotations

from ..functions.text import ENGLISH_STOP_WORDS, TOKEN_PATTERN_SQL
from . import registry as R

STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"

CREDITS = """
credits AS (
  SELECT conv_id AS movie_id,
         coalesce(min_by(coalesce(text, ''), turn) FILTER (WHERE role = 'system'), '') AS director,
         array_to_string(list(coalesce(text, '') ORDER BY turn)[1:5], ', ') AS cast5,
         array_to_string(list(coalesce(text, '') ORDER BY turn)[1:3], ', ') AS cast3,
         string_agg(coalesce(text, ''), ', ' ORDER BY turn) AS names
  FROM conversations GROUP BY conv_id)"""

FILMS = CREDITS + """,
film_votes AS (
  SELECT l_partkey, count(*) AS n_votes, avg(l_quantity) AS avg_qty, sum(l_extendedprice) AS sum_price,
         sum(l_extendedprice * (1.0 - l_discount)) AS sum_rev
  FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY l_partkey),
films AS (
  SELECT p.p_partkey AS item_id, p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS title,
         '' AS overview, p.p_type || ', ' || p.p_brand AS genres_str,
         [p.p_type, p.p_brand] AS genres_list,
         array_to_string(string_split(p.p_name, ' '), ', ') AS keywords_str,
         coalesce(cr.director, '') AS director, coalesce(cr.cast5, '') AS cast_str,
         v.avg_qty / 5.0 AS vote_average, CAST(coalesce(v.n_votes, 0) * 20 AS BIGINT) AS vote_count,
         round(v.sum_price, 2) / 1e5 AS popularity, 'Film' AS content_type,
         p.p_retailprice AS budget, round(v.sum_rev, 4) AS revenue, CAST(p.p_size AS DOUBLE) AS runtime
  FROM part p LEFT JOIN film_votes v ON p.p_partkey = v.l_partkey
  LEFT JOIN credits cr ON cr.movie_id = p.p_partkey)"""

SERIES = """
series_orders AS (
  SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) / count(*) AS avg_price, sum(o_totalprice) AS sum_price,
         count(DISTINCT year(o_orderdate)) AS n_years
  FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey),
series_raw AS (
  SELECT c.c_custkey AS id, c.c_name AS name,
         CAST(coalesce(o.n_years, 0) AS BIGINT) AS number_of_seasons,
         CAST(coalesce(o.n_orders, 0) AS BIGINT) AS number_of_episodes,
         CAST(coalesce(o.n_orders, 0) * 15 AS BIGINT) AS vote_count,
         o.avg_price / 50000.0 AS vote_average, CAST(NULL AS VARCHAR) AS overview,
         round(o.sum_price, 2) / 1e4 AS popularity, CAST(NULL AS VARCHAR) AS tagline,
         concat_ws(', ', c.c_mktsegment, n.n_name) AS genres, CAST(NULL AS VARCHAR) AS created_by,
         n.n_name AS networks
  FROM customer c LEFT JOIN series_orders o ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
series AS (
  SELECT id AS item_id, name AS title, '' AS overview, coalesce(genres, '') AS genres_str,
         CASE WHEN genres IS NULL THEN [] ELSE list_transform(string_split(genres, ','), lambda g: trim(g)) END AS genres_list,
         '' AS keywords_str, coalesce(created_by, '') AS director, '' AS cast_str,
         vote_average, vote_count, popularity, 'Series' AS content_type,
         number_of_seasons, number_of_episodes
  FROM series_raw)"""

ITEMS = """
items AS (
  SELECT d.doc_id AS item_id, 'Document #' || CAST(d.doc_id AS VARCHAR) AS title, d.text AS overview,
         concat_ws(', ', d.lang, d.source) AS genres_str, '' AS keywords_str, '' AS director, '' AS cast_str,
         CAST(d.n_chars % 101 AS DOUBLE) / 10.0 AS vote_average, CAST(d.n_chars % 500 AS BIGINT) AS vote_count,
         CAST(d.n_chars AS DOUBLE) / 100.0 AS popularity, 'Document' AS content_type
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
queries AS (
  SELECT item_id AS query_id, title FROM items WHERE vote_count >= {min_votes}
  ORDER BY md5('{seed}:' || CAST(item_id AS VARCHAR)) LIMIT {n_queries})""".format(
    min_votes=R.MIN_VOTES_QUERY, seed=R.SEED, n_queries=R.N_QUERIES)

#: The query set of the all-items search.
EVERY_ITEM = ", every_item AS (SELECT item_id AS query_id FROM items)"
#: The searches' query set: every id divisible by SEARCH_EVERY.
ASKED = f", asked AS (SELECT item_id AS query_id FROM items WHERE item_id % {R.SEARCH_EVERY} = 0)"


def _tokens_cte(name: str, ngram: int) -> str:
    bigram = ("t || CASE WHEN len(t) >= 2 THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) "
              "ELSE [] END") if ngram >= 2 else "t"
    return f"""
{name}_tok AS (
  SELECT item_id, list_filter(regexp_extract_all(lower(concat_ws(' ', genres_str, keywords_str, director, cast_str, overview)),
                                                 '{TOKEN_PATTERN_SQL}'), lambda x: NOT list_contains({STOP_SQL}, x)) AS t
  FROM items),
{name}_terms AS (SELECT item_id, unnest({bigram}) AS term FROM {name}_tok)"""


def _tfidf_cte(name: str, max_features: int, ngram: int) -> str:
    return _tokens_cte(name, ngram) + f""",
{name}_tf AS (SELECT item_id, term, count(*) AS tf FROM {name}_terms GROUP BY item_id, term),
{name}_nd AS (SELECT count(*) AS n FROM items),
{name}_vocab AS (
  SELECT term, sum(tf) AS n_total, count(*) AS df FROM {name}_tf GROUP BY term
  ORDER BY n_total DESC, term LIMIT {max_features}),
{name}_raw AS (
  SELECT f.item_id, f.term, f.tf * (ln((1.0 + nd.n) / (1.0 + v.df)) + 1.0) AS raw
  FROM {name}_tf f JOIN {name}_vocab v ON f.term = v.term CROSS JOIN {name}_nd nd),
{name}_w AS (
  SELECT item_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY item_id)) AS weight,
         sum(raw) OVER (PARTITION BY item_id) / sqrt(sum(raw * raw) OVER (PARTITION BY item_id)) AS l1
  FROM {name}_raw),
{name}_norms AS (
  SELECT i.item_id, coalesce(x.n2, 0.0) AS n2, coalesce(x.n1, 0.0) AS n1
  FROM items i LEFT JOIN (SELECT item_id, sum(weight * weight) AS n2, max(l1) AS n1 FROM {name}_w GROUP BY item_id) x
  ON i.item_id = x.item_id)"""


def _knn_cte(name: str, max_features: int, ngram: int, metric: str, n: int, queries: str = "queries") -> str:
    if metric == "cosine":
        score = "coalesce(s.dot, 0.0)"
    elif metric == "euclidean":
        score = "1.0 - sqrt(greatest(0.0, round(qn.n2 + inn.n2 - 2 * coalesce(s.dot, 0.0), 12)))"
    else:
        score = "1.0 - (qn.n1 + inn.n1 + coalesce(s.corr, 0.0))"
    return _tfidf_cte(name, max_features, ngram) + f""",
{name}_shared AS (
  SELECT a.item_id AS query_id, b.item_id, sum(a.weight * b.weight) AS dot,
         sum(abs(a.weight - b.weight) - a.weight - b.weight) AS corr
  FROM {name}_w a JOIN {name}_w b ON a.term = b.term
  WHERE a.item_id IN (SELECT query_id FROM {queries}) GROUP BY a.item_id, b.item_id),
{name}_scores AS (
  SELECT q.query_id, inn.item_id, {score} AS score
  FROM {queries} q JOIN {name}_norms qn ON qn.item_id = q.query_id
  CROSS JOIN {name}_norms inn
  LEFT JOIN {name}_shared s ON s.query_id = q.query_id AND s.item_id = inn.item_id
  WHERE inn.item_id <> q.query_id),
{name}_recs AS (
  SELECT query_id, CAST(rank AS INTEGER) AS rank, item_id, round(score, 6) AS similarity_score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank
    FROM {name}_scores) WHERE rank <= {n})"""


def _by_value_cte(name: str, preds: str, n: int, eps: str = "1e-10", queries: str = "queries") -> str:
    """Brute force: every query against every item."""
    return f""",
{name}_p AS ({preds}),
{name}_mm AS (SELECT min(prediction) AS mn, max(prediction) AS mx FROM {name}_p),
{name}_cand AS (
  SELECT q.query_id, p.item_id, abs(p.prediction - t.prediction) AS d,
         greatest(mm.mx - t.prediction, t.prediction - mm.mn) AS maxd
  FROM {queries} q JOIN {name}_p t ON t.item_id = q.query_id
  CROSS JOIN {name}_p p CROSS JOIN {name}_mm mm
  WHERE p.item_id <> q.query_id),
{name}_recs AS (
  SELECT query_id, CAST(rank AS INTEGER) AS rank, item_id,
         round(1.0 - coalesce(d / (maxd + {eps}), 0.0), 6) AS similarity_score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(d, 9), item_id) AS rank
    FROM {name}_cand) WHERE rank <= {n})"""


RIDGE2_FIT = """
  base AS (
    SELECT item_id, coalesce(popularity, 0.0) AS x1, CAST(coalesce(vote_count, 0) AS DOUBLE) AS x2,
           coalesce(vote_average, avg(vote_average) OVER ()) AS y FROM items),
  mom AS (SELECT avg(x1) AS m1, avg(x2) AS m2, stddev_pop(x1) AS s1, stddev_pop(x2) AS s2, avg(y) AS my FROM base),
  z AS (SELECT b.item_id, (b.x1 - m.m1) / CASE WHEN m.s1 = 0 THEN 1.0 ELSE m.s1 END AS z1,
               (b.x2 - m.m2) / CASE WHEN m.s2 = 0 THEN 1.0 ELSE m.s2 END AS z2, b.y - m.my AS yc
        FROM base b CROSS JOIN mom m),
  zc AS (SELECT item_id, z1 - avg(z1) OVER () AS z1, z2 - avg(z2) OVER () AS z2, yc FROM z),
  g AS (SELECT sum(z1 * z1) + 1.0 AS a, sum(z2 * z2) + 1.0 AS dd, sum(z1 * z2) AS c,
               sum(z1 * yc) AS e1, sum(z2 * yc) AS e2 FROM zc),
  w AS (SELECT (e1 * dd - c * e2) / (a * dd - c * c) AS w1, (e2 * a - c * e1) / (a * dd - c * c) AS w2 FROM g)"""
RIDGE2_PREDS = "WITH " + RIDGE2_FIT + """
  SELECT zc.item_id, m.my + w.w1 * zc.z1 + w.w2 * zc.z2 AS prediction
  FROM zc CROSS JOIN w CROSS JOIN mom m"""


def _recs_details(name: str, model: str | None = None) -> str:
    lead = f"'{model}' AS model, " if model else ""
    return (f"SELECT {lead}r.query_id, r.rank, r.item_id, i.title, i.genres_str, i.vote_average, i.vote_count, "
            f"r.similarity_score FROM {name}_recs r JOIN items i ON i.item_id = r.item_id")


ALL_RECS = ("WITH " + ITEMS + "," + _knn_cte("cb", R.CB_FEATURES, R.CB_NGRAM, "cosine", R.N_RECS) + ","
            + _knn_cte("kn", R.KNN_FEATURES, R.KNN_NGRAM, "cosine", R.N_RECS)
            + _by_value_cte("lin", RIDGE2_PREDS, R.N_RECS) + """,
recs AS (""" + _recs_details("cb", "content_based") + " UNION ALL " + _recs_details("kn", "knn")
            + " UNION ALL " + _recs_details("lin", "linear") + ")")

TIMINGS = "timings AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{m}', {o}, {f}, {r})" for m, o, f, r in R.EXAMPLE_TIMINGS) + \
    ") AS t(model, model_order, fit_seconds, recommend_seconds))"

METRICS = ALL_RECS + ", " + TIMINGS + """,
metrics AS (
  SELECT r.model, t.model_order, t.fit_seconds, t.recommend_seconds, t.recommend_seconds * 1000 AS recommend_ms,
         count(*) AS n_recs, count(DISTINCT r.query_id) AS n_queries,
         count(DISTINCT r.title) / (SELECT count(*) FROM items) * 100 AS coverage,
         count(DISTINCT r.genres_str) / greatest(count(r.genres_str), 1) * 100 AS diversity,
         coalesce(avg(r.vote_average), 0.0) AS avg_rating,
         count(*) FILTER (WHERE r.vote_average >= 5.5) / count(*) * 100 AS precision
  FROM recs r JOIN timings t ON r.model = t.model
  GROUP BY r.model, t.model_order, t.fit_seconds, t.recommend_seconds),
scored AS (
  SELECT *, least(100.0, avg_rating * 10
                  + CASE WHEN precision >= 70 THEN 15.0 ELSE precision / 70 * 15 END
                  + CASE WHEN recommend_ms < 50 THEN 5.0 WHEN recommend_ms < 100 THEN 3.0 ELSE 1.0 END) AS quality_score
  FROM metrics),
normed AS (
  SELECT *, fit_seconds + recommend_seconds AS tm FROM scored),
compared AS (
  SELECT *,
    (CASE WHEN max(coverage) OVER () = min(coverage) OVER () THEN 0.5
          ELSE (coverage - min(coverage) OVER ()) / (max(coverage) OVER () - min(coverage) OVER ()) END) * 0.30
  + (CASE WHEN max(diversity) OVER () = min(diversity) OVER () THEN 0.5
          ELSE (diversity - min(diversity) OVER ()) / (max(diversity) OVER () - min(diversity) OVER ()) END) * 0.30
  + (CASE WHEN max(avg_rating) OVER () = min(avg_rating) OVER () THEN 0.5
          ELSE (avg_rating - min(avg_rating) OVER ()) / (max(avg_rating) OVER () - min(avg_rating) OVER ()) END) * 0.20
  + (1.0 - CASE WHEN max(tm) OVER () = min(tm) OVER () THEN 0.5
          ELSE (tm - min(tm) OVER ()) / (max(tm) OVER () - min(tm) OVER ()) END) * 0.20 AS total_score
  FROM normed)"""


def _best(col: str, largest: bool = True, src: str = "compared") -> str:
    order = "DESC" if largest else "ASC"
    return f"(SELECT model FROM {src} WHERE {col} IS NOT NULL ORDER BY {col} {order}, model_order LIMIT 1)"


SQL: dict[str, str] = {}

# ------------------------------------------------------------ recommenders
SQL["q_content_based"] = ("WITH " + ITEMS + ASKED + "," + _knn_cte("cb", R.CB_FEATURES, R.CB_NGRAM, "cosine", R.N_RECS, "asked")
                          + "\n" + _recs_details("cb"))
SQL["q_all_items_topk"] = ("WITH " + ITEMS + EVERY_ITEM + "," + _knn_cte("cb", R.CB_FEATURES, R.CB_NGRAM, "cosine", R.N_RECS, "every_item")
                           + "\nSELECT * FROM cb_recs")
for _m in ("cosine", "euclidean", "manhattan"):
    SQL[f"q_knn_{_m}"] = ("WITH " + ITEMS + ASKED + "," + _knn_cte("kn", R.KNN_FEATURES, R.KNN_NGRAM, _m, R.N_RECS, "asked")
                          + "\nSELECT * FROM kn_recs")

_EMB = """
WITH ev AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
eq AS (SELECT item_id AS query_id FROM ev WHERE item_id % {every} = 0),
pairs AS (
  SELECT q.query_id, e.item_id, {expr} AS score
  FROM eq q JOIN ev qe ON qe.item_id = q.query_id CROSS JOIN ev e WHERE e.item_id <> q.query_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, item_id, round(score, 6) AS similarity_score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, item_id) AS rank FROM pairs)
WHERE rank <= {n}"""
_DOT = "list_sum(list_transform(range(1, len(qe.v) + 1), lambda i: qe.v[i] * e.v[i]))"
_EMB_EXPR = {
    "cosine": f"CASE WHEN sqrt(list_sum(list_transform(qe.v, lambda x: x * x))) * sqrt(list_sum(list_transform(e.v, lambda x: x * x))) > 0 "
              f"THEN {_DOT} / (sqrt(list_sum(list_transform(qe.v, lambda x: x * x))) * sqrt(list_sum(list_transform(e.v, lambda x: x * x)))) ELSE 0.0 END",
    "euclidean": "1.0 - sqrt(greatest(0.0, list_sum(list_transform(range(1, len(qe.v) + 1), lambda i: (qe.v[i] - e.v[i]) * (qe.v[i] - e.v[i])))))",
    "manhattan": "1.0 - list_sum(list_transform(range(1, len(qe.v) + 1), lambda i: abs(qe.v[i] - e.v[i])))",
}
for _m, _e in _EMB_EXPR.items():
    SQL[f"q_knn_embeddings_{_m}"] = _EMB.format(every=R.SEARCH_EVERY, expr=_e, n=R.N_RECS)

SQL["q_nearest_by_value"] = ("WITH " + ITEMS + ASKED + _by_value_cte(
    "nv", "SELECT item_id, vote_average AS prediction FROM items WHERE vote_average IS NOT NULL", R.N_RECS, queries="asked")
    + "\nSELECT * FROM nv_recs")
SQL["q_ridge_two_features"] = ("WITH " + ITEMS + ASKED + _by_value_cte("lin", RIDGE2_PREDS, R.N_RECS, queries="asked")
                               + "\nSELECT * FROM lin_recs")
SQL["q_bundle_scores"] = "WITH " + ITEMS + f"""
SELECT item_id, round(prediction, 6) AS prediction FROM ({RIDGE2_PREDS})"""
SQL["q_ridge_coefficients"] = "WITH " + ITEMS + ", " + RIDGE2_FIT + """
SELECT 'popularity' AS feature, round(w1, 6) AS coefficient FROM w UNION ALL SELECT 'vote_count', round(w2, 6) FROM w
UNION ALL SELECT '(intercept)', round(my - w1 * mz1 - w2 * mz2, 6) FROM w CROSS JOIN mom CROSS JOIN (
  SELECT avg(z1) AS mz1, avg(z2) AS mz2 FROM z)"""

# ------------------------------------------------------------ evaluation
SQL["q_sample_items"] = "WITH " + ITEMS + "\nSELECT query_id, title FROM queries"
SQL["q_recs_all_models"] = ALL_RECS + "\nSELECT * FROM recs"
SQL["q_coverage"] = ALL_RECS + """
SELECT model, round(count(DISTINCT title) / (SELECT count(*) FROM items) * 100, 6) AS coverage
FROM recs GROUP BY model"""
SQL["q_diversity_strings"] = ALL_RECS + """
SELECT model, round(count(DISTINCT genres_str) / greatest(count(genres_str), 1) * 100, 6) AS diversity
FROM recs GROUP BY model"""
SQL["q_diversity_tags"] = ALL_RECS + """,
tags AS (SELECT model, trim(unnest(string_split(genres_str, ','))) AS tag FROM recs WHERE genres_str IS NOT NULL)
SELECT model, round(count(DISTINCT tag) / greatest(count(*), 1) * 100, 6) AS diversity FROM tags GROUP BY model"""
SQL["q_avg_rating"] = ALL_RECS + """
SELECT model, round(coalesce(avg(vote_average), 0.0), 6) AS avg_rating FROM recs GROUP BY model"""
SQL["q_precision"] = ALL_RECS + """
SELECT model, round(count(*) FILTER (WHERE vote_average >= 5.5) / count(*) * 100, 6) AS precision
FROM recs GROUP BY model"""
SQL["q_quality_score"] = METRICS + "\nSELECT model, round(quality_score, 6) AS quality_score FROM scored"
SQL["q_comparison_score"] = METRICS + """
SELECT model, round(coverage, 6) AS coverage, round(diversity, 6) AS diversity, round(avg_rating, 6) AS avg_rating,
       round(total_score, 6) AS total_score FROM compared"""
SQL["q_agreement_matrix"] = ALL_RECS + """,
sets AS (SELECT DISTINCT model, title FROM recs WHERE title IS NOT NULL),
models AS (SELECT DISTINCT model FROM recs),
sizes AS (SELECT model, count(*) AS size FROM sets GROUP BY model),
inter AS (SELECT a.model AS model_a, b.model AS model_b, count(*) AS n_common
          FROM sets a JOIN sets b ON a.title = b.title GROUP BY a.model, b.model)
SELECT ma.model AS model_a, mb.model AS model_b,
       round(CASE WHEN coalesce(sa.size, 0) > 0 AND coalesce(sb.size, 0) > 0
                       AND sa.size + sb.size - coalesce(i.n_common, 0) > 0
                  THEN coalesce(i.n_common, 0) / (sa.size + sb.size - coalesce(i.n_common, 0)) * 100
                  ELSE 0.0 END, 6) AS agreement_pct
FROM models ma CROSS JOIN models mb
LEFT JOIN sizes sa ON sa.model = ma.model LEFT JOIN sizes sb ON sb.model = mb.model
LEFT JOIN inter i ON i.model_a = ma.model AND i.model_b = mb.model"""
SQL["q_confusion"] = ALL_RECS + """,
c AS (SELECT model, count(*) FILTER (WHERE vote_average >= 7) AS tp, count(*) FILTER (WHERE vote_average < 6) AS fp,
             count(*) FILTER (WHERE vote_average IS NULL OR (vote_average < 7 AND vote_average >= 6)) AS tn
      FROM recs GROUP BY model)
SELECT model, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn,
       round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) * 100 ELSE 0.0 END, 1) AS precision_pct,
       round(CASE WHEN tp + fp + tn + 1 > 0 THEN (tp + tn) / (tp + fp + tn + 1) * 100 ELSE 0.0 END, 1) AS accuracy_pct
FROM c"""
SQL["q_acceptance"] = METRICS + """
SELECT model, round(quality_score, 6) AS quality_score, quality_score >= 80 AS accepted,
       round(avg(CASE WHEN quality_score >= 80 THEN 1.0 ELSE 0.0 END) OVER () * 100, 6) AS pass_rate,
       CASE WHEN avg(CASE WHEN quality_score >= 80 THEN 1.0 ELSE 0.0 END) OVER () * 100 >= 50 THEN 'acceptable'
            WHEN avg(CASE WHEN quality_score >= 80 THEN 1.0 ELSE 0.0 END) OVER () * 100 > 0 THEN 'partial'
            ELSE 'none' END AS band
FROM scored"""
SQL["q_best_for_priority"] = METRICS + f"""
SELECT 'balanced' AS priority, {_best('total_score')} AS model
UNION ALL SELECT 'speed', {_best('fit_seconds', False)}
UNION ALL SELECT 'quality', {_best('avg_rating')}
UNION ALL SELECT 'coverage', {_best('coverage')}"""
SQL["q_best_per_category"] = METRICS + f"""
SELECT 'overall' AS category, {_best('quality_score', True, 'scored')} AS model
UNION ALL SELECT 'rating', {_best('avg_rating', True, 'scored')}
UNION ALL SELECT 'diversity', {_best('diversity', True, 'scored')}
UNION ALL SELECT 'speed', {_best('recommend_ms', False, 'scored')}"""
SQL["q_best_flags"] = METRICS + """
SELECT model, quality_score = max(quality_score) OVER () AS best_quality_score,
       avg_rating = max(avg_rating) OVER () AS best_avg_rating, precision = max(precision) OVER () AS best_precision,
       diversity = max(diversity) OVER () AS best_diversity, recommend_ms = min(recommend_ms) OVER () AS best_recommend_ms
FROM scored"""
SQL["q_radar_metrics"] = METRICS + """
SELECT model, round(coverage / 100, 6) AS r_coverage, round(diversity / 100, 6) AS r_diversity,
       round(avg_rating / 10, 6) AS r_rating, round(1.0 - least(fit_seconds / 10, 1.0), 6) AS r_speed FROM metrics"""
SQL["q_metric_percent"] = METRICS + """
SELECT model, round(avg_rating / 10 * 100, 6) AS rating_pct, round(precision, 6) AS precision_pct,
       round(diversity, 6) AS diversity_pct, round(quality_score, 6) AS quality_score FROM scored"""
SQL["q_detailed_metrics"] = METRICS + """
SELECT model, printf('%.3fs', fit_seconds) AS fit_time, printf('%.4fs', recommend_seconds) AS recommend_time,
       printf('%.2f%%', coverage) AS coverage_txt, printf('%.2f%%', diversity) AS diversity_txt,
       printf('%.2f', avg_rating) AS avg_rating_txt, CAST(n_queries AS BIGINT) AS n_queries FROM metrics"""

# ------------------------------------------------------------ text features
SQL["q_vocabulary"] = ("WITH " + ITEMS + "," + _tfidf_cte("cb", R.CB_FEATURES, R.CB_NGRAM) + """
SELECT v.term, CAST(v.n_total AS BIGINT) AS n_total, CAST(v.df AS BIGINT) AS df,
       round(ln((1.0 + nd.n) / (1.0 + v.df)) + 1.0, 6) AS idf FROM cb_vocab v CROSS JOIN cb_nd nd""")
SQL["q_tfidf_weights"] = ("WITH " + ITEMS + "," + _tfidf_cte("kn", R.KNN_FEATURES, R.KNN_NGRAM)
                          + "\nSELECT item_id, term, round(weight, 6) AS weight FROM kn_w")
SQL["q_token_counts"] = "WITH " + ITEMS + """,
t AS (SELECT item_id, regexp_extract_all(lower(concat_ws(' ', genres_str, keywords_str, director, cast_str, overview)),
                                         '""" + TOKEN_PATTERN_SQL + """') AS t FROM items)
SELECT item_id, CAST(len(t) AS INTEGER) AS n_tokens,
       CAST(len(list_filter(t, lambda x: NOT list_contains(""" + STOP_SQL + """, x))) AS INTEGER) AS n_kept FROM t"""
SQL["q_ngrams"] = "WITH " + ITEMS + "," + _tokens_cte("ng", 2) + """
SELECT term, count(*) AS n_total FROM ng_terms GROUP BY term"""
SQL["q_combined_text"] = "WITH " + FILMS + """
SELECT item_id, concat_ws(' ', genres_str, keywords_str, director, cast_str, overview) AS text FROM films"""
SQL["q_genre_multi_hot"] = "WITH " + FILMS + """
SELECT DISTINCT item_id, unnest(genres_list) AS genre, 1 AS flag FROM films"""

# ------------------------------------------------------------ JSON / scalar functions
SQL["q_json_names"] = "WITH " + CREDITS + "\nSELECT movie_id, names FROM credits"
SQL["q_json_non_list"] = "SELECT event_id, 0 AS n_names FROM events"
SQL["q_first_by_role"] = "WITH " + CREDITS + "\nSELECT movie_id, director FROM credits"
SQL["q_first_n_names"] = "WITH " + CREDITS + "\nSELECT movie_id, cast3 AS cast_str FROM credits"
SQL["q_split_trim"] = "WITH " + SERIES + """
SELECT id AS item_id, CASE WHEN genres IS NULL THEN '' ELSE array_to_string(list_transform(string_split(genres, ','), lambda g: trim(g)), '|') END AS genres_joined,
       CAST(CASE WHEN genres IS NULL THEN 0 ELSE len(string_split(genres, ',')) END AS INTEGER) AS n_genres
FROM series_raw"""

# ------------------------------------------------------------ cleaning / joins
_CAT_COLS = "item_id, title, overview, genres_str, keywords_str, director, cast_str, vote_average, vote_count, popularity, content_type"
SQL["q_catalog_projection"] = "WITH " + FILMS + f"\nSELECT {_CAT_COLS} FROM films WHERE title IS NOT NULL"
SQL["q_fill_missing"] = "WITH " + SERIES + """
SELECT id AS item_id, name AS title, coalesce(overview, '') AS overview, coalesce(tagline, '') AS tagline,
       coalesce(created_by, '') AS created_by, coalesce(genres, '') AS genres FROM series_raw"""
SQL["q_drop_null_title"] = "WITH " + FILMS + "\nSELECT item_id, title FROM films WHERE title IS NOT NULL"
SQL["q_filter_voted"] = "WITH " + SERIES + "\nSELECT item_id, title, vote_count FROM series WHERE vote_count >= 1"
SQL["q_filter_reliable"] = "WITH " + SERIES + """
SELECT item_id, title, vote_count, vote_average FROM series WHERE vote_count >= 10 AND vote_average > 0"""
SQL["q_popularity_vs_rating"] = "WITH " + FILMS + """
SELECT item_id, popularity, vote_average FROM films WHERE popularity IS NOT NULL AND vote_average IS NOT NULL"""
SQL["q_rating_values"] = "WITH " + FILMS + "\nSELECT item_id, vote_average FROM films WHERE vote_average IS NOT NULL"
SQL["q_title_search"] = "WITH " + FILMS + """
SELECT item_id, title FROM films WHERE title IS NOT NULL AND contains(lower(title), 'ring')"""
SQL["q_catalog_credits_left_join"] = """
WITH cr AS (SELECT DISTINCT conv_id FROM conversations)
SELECT p.p_partkey AS id, p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR) AS title, cr.conv_id AS movie_id,
       CASE WHEN cr.conv_id IS NULL THEN NULL ELSE 'Conversation ' || CAST(cr.conv_id AS VARCHAR) END AS title_credits
FROM part p LEFT JOIN cr ON p.p_partkey = cr.conv_id"""
SQL["q_title_lookup"] = "SELECT p_name AS title, min(p_partkey) AS item_id FROM part GROUP BY p_name"
SQL["q_title_lookup_missing"] = """
SELECT p.p_name AS title, min(p.p_partkey) AS item_id FROM part p
WHERE p.p_name IN (SELECT p_name || ' (unreleased)' FROM part) GROUP BY p.p_name"""
SQL["q_catalog_union"] = ("WITH " + FILMS + "," + SERIES + f"\nSELECT {_CAT_COLS} FROM films UNION ALL "
                          f"SELECT {_CAT_COLS} FROM series")
SQL["q_stage_counts"] = "WITH " + SERIES + """
SELECT * FROM (VALUES
  ('raw', (SELECT count(*) FROM series_raw)),
  ('voted', (SELECT count(*) FROM series_raw WHERE vote_count >= 1)),
  ('reliable', (SELECT count(*) FROM series_raw WHERE vote_count >= 10 AND vote_average > 0)),
  ('reliable_titled', (SELECT count(*) FROM series_raw WHERE vote_count >= 10 AND vote_average > 0 AND name IS NOT NULL))
) AS t(stage, n_rows)"""

# ------------------------------------------------------------ statistics
SQL["q_stats_summary"] = "WITH " + FILMS + "," + SERIES + """,
u AS (SELECT content_type, vote_average FROM films UNION ALL SELECT content_type, vote_average FROM series)
SELECT coalesce(content_type, 'All') AS content_type, count(*) AS n_items, round(avg(vote_average), 6) AS avg_rating
FROM u GROUP BY ROLLUP (content_type)"""
SQL["q_distinct_genres"] = "WITH " + FILMS + "," + SERIES + """
SELECT DISTINCT genre FROM (SELECT unnest(genres_list) AS genre FROM films
                            UNION ALL SELECT unnest(genres_list) AS genre FROM series)"""
SQL["q_missing_counts"] = "WITH " + """
cr AS (SELECT DISTINCT conv_id FROM conversations),
fv AS (SELECT l_partkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' GROUP BY l_partkey),
j AS (SELECT p.*, fv.n, cr.conv_id FROM part p LEFT JOIN fv ON p.p_partkey = fv.l_partkey
      LEFT JOIN cr ON p.p_partkey = cr.conv_id),
n AS (SELECT count(*) AS total, count(*) FILTER (WHERE n IS NULL) AS no_votes,
             count(*) FILTER (WHERE conv_id IS NULL) AS no_credits FROM j)
SELECT * FROM (
  SELECT 'id' AS column_name, 0 AS n_missing FROM n UNION ALL SELECT 'title', 0 FROM n
  UNION ALL SELECT 'overview', total FROM n UNION ALL SELECT 'tagline', total FROM n
  UNION ALL SELECT 'genres', 0 FROM n UNION ALL SELECT 'keywords', 0 FROM n
  UNION ALL SELECT 'budget', 0 FROM n UNION ALL SELECT 'revenue', no_votes FROM n
  UNION ALL SELECT 'runtime', 0 FROM n UNION ALL SELECT 'popularity', no_votes FROM n
  UNION ALL SELECT 'vote_average', no_votes FROM n UNION ALL SELECT 'vote_count', 0 FROM n
  UNION ALL SELECT 'original_language', 0 FROM n UNION ALL SELECT 'movie_id', no_credits FROM n
  UNION ALL SELECT 'title_credits', no_credits FROM n UNION ALL SELECT 'cast', no_credits FROM n
  UNION ALL SELECT 'crew', no_credits FROM n)"""
SQL["q_genre_distribution"] = "WITH " + FILMS + """
SELECT genre, count(*) AS n_items FROM (SELECT unnest(genres_list) AS genre FROM films)
GROUP BY genre ORDER BY n_items DESC, genre LIMIT 20"""
SQL["q_genre_distribution_text"] = "WITH " + SERIES + """
SELECT * FROM (
  SELECT genre, count(*) AS n_items FROM (
    SELECT trim(unnest(string_split(genres_str, ','))) AS genre FROM series WHERE genres_str IS NOT NULL)
  GROUP BY genre ORDER BY n_items DESC, genre LIMIT 15) WHERE genre <> ''"""
SQL["q_rating_center"] = "WITH " + FILMS + """
SELECT round(avg(vote_average), 6) AS mean_rating, round(median(vote_average), 6) AS median_rating FROM films"""
SQL["q_rating_histogram"] = "WITH " + FILMS + """,
v AS (SELECT CAST(vote_average AS DOUBLE) AS v FROM films WHERE vote_average IS NOT NULL),
mm AS (SELECT min(v) AS mn, max(v) AS mx FROM v),
b AS (SELECT CASE WHEN mm.mx - mm.mn = 0 THEN 1 ELSE least(CAST(floor((v.v - mm.mn) / (mm.mx - mm.mn) * 20) AS INTEGER) + 1, 20) END AS bin
      FROM v CROSS JOIN mm),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 21))
SELECT g.bin, round(mm.mn + (g.bin - 1) * (mm.mx - mm.mn) / 20, 6) AS lower,
       round(mm.mn + g.bin * (mm.mx - mm.mn) / 20, 6) AS upper, CAST(coalesce(c.n, 0) AS BIGINT) AS n_items
FROM g CROSS JOIN mm LEFT JOIN c ON c.bin = g.bin WHERE mm.mn IS NOT NULL"""


def _corr_sql(table: str, cols: list[str], lower_only: bool) -> str:
    parts = []
    for i, x in enumerate(cols):
        for j, y in enumerate(cols):
            if lower_only and not i > j:
                continue
            xs = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({x} AS DOUBLE) END"
            ys = f"CASE WHEN {x} IS NOT NULL AND {y} IS NOT NULL THEN CAST({y} AS DOUBLE) END"
            parts.append(
                f"SELECT '{x}' AS col_x, '{y}' AS col_y, {i} AS ix, {j} AS iy, round(covar_pop({xs}, {ys}) / "
                f"nullif(stddev_pop({xs}) * stddev_pop({ys}), 0), 6) AS corr FROM {table}")
    return "\nUNION ALL ".join(parts)


SQL["q_correlation_matrix"] = "WITH " + FILMS + "\n" + _corr_sql("films", R.FILM_NUMERIC, False)
SQL["q_correlation_lower"] = "WITH " + SERIES + "\n" + _corr_sql("series", R.SERIES_NUMERIC, True)
SQL["q_describe"] = "WITH " + FILMS + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS std, round(min(CAST({c} AS DOUBLE)), 6) AS min, "
    f"round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    f"round(quantile_cont({c}, 0.75), 6) AS p75, round(max(CAST({c} AS DOUBLE)), 6) AS max FROM films"
    for c in R.FILM_NUMERIC)
SQL["q_impute_mean"] = "WITH " + FILMS + """
SELECT item_id, round(coalesce(vote_average, (SELECT avg(vote_average) FROM films)), 6) AS vote_average FROM films"""
SQL["q_standard_scale"] = "WITH " + FILMS + """,
x AS (SELECT item_id, coalesce(popularity, 0.0) AS p, CAST(coalesce(vote_count, 0) AS DOUBLE) AS v FROM films),
m AS (SELECT avg(p) AS mp, stddev_pop(p) AS sp, avg(v) AS mv, stddev_pop(v) AS sv FROM x)
SELECT item_id, round((p - mp) / CASE WHEN sp = 0 THEN 1.0 ELSE sp END, 6) AS popularity_scaled,
       round((v - mv) / CASE WHEN sv = 0 THEN 1.0 ELSE sv END, 6) AS vote_count_scaled FROM x CROSS JOIN m"""
SQL["q_minmax_normalize"] = "WITH " + FILMS + """,
m AS (SELECT min(popularity) AS mn, max(popularity) AS mx FROM films)
SELECT item_id, round(CASE WHEN mx = mn THEN 0.5 ELSE (popularity - mn) / (mx - mn) END, 6) AS popularity_norm,
       round(1.0 - CASE WHEN mx = mn THEN 0.5 ELSE (popularity - mn) / (mx - mn) END, 6) AS popularity_inv
FROM films CROSS JOIN m"""

# ------------------------------------------------------------ top-n
SQL["q_top_content_film"] = "WITH " + FILMS + """
SELECT item_id, title, vote_average, genres_str, vote_count FROM films
WHERE vote_count >= 100 AND vote_average IS NOT NULL ORDER BY vote_average DESC, item_id LIMIT 10"""
SQL["q_top_content_series"] = "WITH " + SERIES + """
SELECT item_id, title, vote_average, genres_str, vote_count FROM series
WHERE vote_count >= 50 AND vote_average IS NOT NULL ORDER BY vote_average DESC, item_id LIMIT 10"""
SQL["q_top_rated"] = "WITH " + SERIES + """
SELECT item_id, title, vote_average, genres_str, vote_count FROM series
WHERE vote_average IS NOT NULL ORDER BY vote_average DESC, item_id LIMIT 10"""
SQL["q_top_popular_sample"] = "WITH " + SERIES + """
SELECT * FROM (SELECT id AS item_id, name AS title, popularity FROM series_raw
               WHERE vote_count >= 10 AND vote_average > 0
               ORDER BY popularity DESC NULLS LAST, id LIMIT 5000) WHERE title IS NOT NULL"""
