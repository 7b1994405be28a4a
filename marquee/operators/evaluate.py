"""Recommender evaluation and comparison (E-1 ... E-20).

Input is one long table ``recs(model, query_id, rank, item_id, title,
genres_str, vote_average, ...)`` holding every model's recommendations for
every query, so each metric family is one ``groupBy("model")`` job instead of
a Python loop over titles.  Per-model tables have one row per model (tens
of rows at most); windows without ``partitionBy`` are used only on those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scoring import clamp_max, precision_bonus, speed_bonus
from .topk import arg_best


def sample_items(catalog: DataFrame, n: int = 20, min_votes: int = 100, seed: int = 42) -> DataFrame:
    """E-1: reproducible random test items among popular ones (``query_id``, ``title``).

    The order key is ``md5(seed:item_id)``, identical in any SQL engine; fewer
    than ``n`` eligible items give fewer queries (no error).
    """
    key = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), F.col("item_id").cast("string")))
    return (catalog.where(F.col("vote_count") >= min_votes)
            .select(F.col("item_id").alias("query_id"), "title", key.alias("_k"))
            .orderBy("_k").limit(n).drop("_k"))


def coverage(recs: DataFrame, catalog: DataFrame) -> DataFrame:
    """E-3: distinct recommended titles / catalogue rows × 100, per model."""
    n_items = catalog.select(F.count(F.lit(1))).scalar()
    return recs.groupBy("model").agg(
        F.round(F.count_distinct("title") / n_items * 100, 6).alias("coverage"))


def diversity_strings(recs: DataFrame) -> DataFrame:
    """E-4a: distinct whole genre strings / all recommendation rows × 100."""
    return recs.groupBy("model").agg(
        F.round(F.count_distinct("genres_str") / F.greatest(F.count("genres_str"), F.lit(1)) * 100, 6)
        .alias("diversity"))


def diversity_tags(recs: DataFrame) -> DataFrame:
    """E-4b: distinct trimmed tags / all tags × 100 ('' counts as a tag)."""
    tags = (recs.where(F.col("genres_str").isNotNull())
            .select("model", F.explode(F.split("genres_str", ",")).alias("tag"))
            .select("model", F.trim("tag").alias("tag")))
    return tags.groupBy("model").agg(
        F.round(F.count_distinct("tag") / F.greatest(F.count(F.lit(1)), F.lit(1)) * 100, 6).alias("diversity"))


def avg_rating(recs: DataFrame) -> DataFrame:
    """E-5: mean rating of the recommendations, 0 when there is none."""
    return recs.groupBy("model").agg(F.round(F.coalesce(F.avg("vote_average"), F.lit(0.0)), 6).alias("avg_rating"))


def precision(recs: DataFrame, good: float = 5.5) -> DataFrame:
    """E-6: share of recommendations rated ``>= good`` (null ratings count in the denominator)."""
    return recs.groupBy("model").agg(
        F.round(F.count_if(F.col("vote_average") >= good) / F.count(F.lit(1)) * 100, 6).alias("precision"))


def model_metrics(recs: DataFrame, catalog: DataFrame, good: float = 5.5) -> DataFrame:
    """E-3 … E-6 in one aggregation pass (plus the tag diversity of the app page)."""
    n_items = catalog.select(F.count(F.lit(1))).scalar()
    base = recs.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_recs"),
        F.count_distinct("query_id").alias("n_queries"),
        (F.count_distinct("title") / n_items * 100).alias("coverage"),
        (F.count_distinct("genres_str") / F.greatest(F.count("genres_str"), F.lit(1)) * 100).alias("diversity"),
        F.coalesce(F.avg("vote_average"), F.lit(0.0)).alias("avg_rating"),
        (F.count_if(F.col("vote_average") >= good) / F.count(F.lit(1)) * 100).alias("precision"),
    )
    return base


def quality_score(metrics: DataFrame, rec_ms: str = "recommend_ms") -> DataFrame:
    """E-7: ``min(100, 10·rating + precision bonus + speed bonus)``."""
    s = F.col("avg_rating") * 10 + precision_bonus(F.col("precision")) + speed_bonus(F.col(rec_ms))
    return metrics.withColumn("quality_score", clamp_max(s, 100.0))


def _minmax(col: str) -> F.Column:
    w = Window.partitionBy(F.lit(1))
    mn, mx = F.min(col).over(w), F.max(col).over(w)
    return F.when(mx == mn, F.lit(0.5)).otherwise((F.col(col) - mn) / (mx - mn))


def comparison_score(metrics: DataFrame) -> DataFrame:
    """E-8: 0.3·coverage + 0.3·diversity + 0.2·rating + 0.2·(1 − time), each min–max normalised.

    ``metrics`` has one row per model, so the windows run over a handful of rows.
    """
    time = F.col("fit_seconds") + F.col("recommend_seconds")
    m = metrics.withColumn("_time", time)
    return m.withColumn(
        "total_score",
        _minmax("coverage") * 0.30 + _minmax("diversity") * 0.30 + _minmax("avg_rating") * 0.20
        + (F.lit(1.0) - _minmax("_time")) * 0.20).drop("_time")


def agreement_matrix(recs: DataFrame) -> DataFrame:
    """E-9: Jaccard % of the title sets of two models over all queries.

    Sets are joined on the title (equi-join), so the work is proportional to
    shared titles.
    """
    sets = recs.select("model", "title").where(F.col("title").isNotNull()).distinct()
    sizes = sets.groupBy("model").agg(F.count(F.lit(1)).alias("size"))
    a, b = sets.alias("a"), sets.alias("b")
    inter = (a.join(b, F.col("a.title") == F.col("b.title"))
             .groupBy(F.col("a.model").alias("model_a"), F.col("b.model").alias("model_b"))
             .agg(F.count(F.lit(1)).alias("n_common")))
    # Model pairs: the (tiny) model list as a scalar array, exploded per model.
    names = recs.select("model").distinct()
    all_names = names.agg(F.collect_set("model")).scalar()
    pairs = names.select(F.col("model").alias("model_a"), F.explode(all_names).alias("model_b"))
    sa = sizes.select(F.col("model").alias("model_a"), F.col("size").alias("size_a"))
    sb = sizes.select(F.col("model").alias("model_b"), F.col("size").alias("size_b"))
    j = (pairs.join(sa, "model_a", "left").join(sb, "model_b", "left")
         .join(inter, ["model_a", "model_b"], "left")
         .fillna(0, subset=["size_a", "size_b", "n_common"]))
    union = F.col("size_a") + F.col("size_b") - F.col("n_common")
    pct = F.when((F.col("size_a") > 0) & (F.col("size_b") > 0) & (union > 0),
                 F.col("n_common") / union * 100).otherwise(F.lit(0.0))
    return j.select("model_a", "model_b", F.round(pct, 6).alias("agreement_pct"))


def confusion(recs: DataFrame, tp_at: float = 7.0, fp_below: float = 6.0, fn: int = 0) -> DataFrame:
    """E-10: TP (rating ≥ 7), FP (< 6), TN otherwise incl. null; FN fixed; precision, accuracy."""
    r = F.col("vote_average")
    g = recs.groupBy("model").agg(
        F.count_if(r >= tp_at).alias("tp"),
        F.count_if(r < fp_below).alias("fp"),
        F.count_if(~(r >= tp_at) & ~(r < fp_below) | r.isNull()).alias("tn"))
    tp, fp, tn = F.col("tp"), F.col("fp"), F.col("tn")
    total = tp + fp + tn + F.greatest(F.lit(fn), F.lit(1))
    return g.select("model", tp.cast("bigint").alias("tp"), fp.cast("bigint").alias("fp"),
                    tn.cast("bigint").alias("tn"),
                    F.round(F.when(tp + fp > 0, tp / (tp + fp) * 100).otherwise(F.lit(0.0)), 1).alias("precision_pct"),
                    F.round(F.when(total > 0, (tp + tn) / total * 100).otherwise(F.lit(0.0)), 1).alias("accuracy_pct"))


def acceptance(scored: DataFrame, threshold: float = 80.0, score: str = "quality_score") -> DataFrame:
    """E-11: accepted flag per model, pass rate and its band over all models."""
    w = Window.partitionBy(F.lit(1))
    passed = (F.col(score) >= threshold)
    rate = F.avg(passed.cast("double")).over(w) * 100
    band = F.when(rate >= 50, F.lit("acceptable")).when(rate > 0, F.lit("partial")).otherwise(F.lit("none"))
    return scored.select("model", F.round(score, 6).alias(score), passed.alias("accepted"),
                         F.round(rate, 6).alias("pass_rate"), band.alias("band"))


PRIORITY_COLUMN = {"speed": ("fit_seconds", False), "quality": ("avg_rating", True),
                   "coverage": ("coverage", True), "balanced": ("total_score", True)}


def best_for_priority(metrics: DataFrame, priority: str = "balanced") -> DataFrame:
    """E-12: best model for a priority; ``balanced`` falls back to the first row without a score."""
    col, largest = PRIORITY_COLUMN.get(priority, PRIORITY_COLUMN["balanced"])
    if col not in metrics.columns:
        return metrics.orderBy("model_order").limit(1).select(F.lit(priority).alias("priority"), "model")
    return metrics.agg(arg_best(col, largest=largest).alias("model")) \
        .select(F.lit(priority).alias("priority"), "model")


def best_per_category(scored: DataFrame) -> DataFrame:
    """E-13 / T-7: best overall, best rating, most diverse, fastest."""
    row = scored.agg(
        arg_best("quality_score").alias("overall"),
        arg_best("avg_rating").alias("rating"),
        arg_best("diversity").alias("diversity"),
        arg_best("recommend_ms", largest=False).alias("speed"))
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("category"), F.col(c).alias("model"))
        for c in ["overall", "rating", "diversity", "speed"]])))


def best_flags(metrics: DataFrame, maximise: list[str], minimise: list[str]) -> DataFrame:
    """E-14: per metric, flag the model(s) holding the best value."""
    w = Window.partitionBy(F.lit(1))
    out = metrics
    for c in maximise:
        out = out.withColumn(f"best_{c}", F.col(c) == F.max(c).over(w))
    for c in minimise:
        out = out.withColumn(f"best_{c}", F.col(c) == F.min(c).over(w))
    return out


def radar_metrics(metrics: DataFrame) -> DataFrame:
    """E-15: coverage/100, diversity/100, rating/10, 1 − min(fit time/10, 1)."""
    return metrics.select(
        "model",
        F.round(F.col("coverage") / 100, 6).alias("r_coverage"),
        F.round(F.col("diversity") / 100, 6).alias("r_diversity"),
        F.round(F.col("avg_rating") / 10, 6).alias("r_rating"),
        F.round(F.lit(1.0) - F.least(F.col("fit_seconds") / 10, F.lit(1.0)), 6).alias("r_speed"))


def metric_percent(scored: DataFrame) -> DataFrame:
    """E-16: metric table on a 0–100 scale (rating × 10)."""
    return scored.select("model", F.round(F.col("avg_rating") / 10 * 100, 6).alias("rating_pct"),
                         F.round("precision", 6).alias("precision_pct"),
                         F.round("diversity", 6).alias("diversity_pct"),
                         F.round("quality_score", 6).alias("quality_score"))


def detailed_metrics(metrics: DataFrame) -> DataFrame:
    """S-13 / E-18: formatted metric strings."""
    return metrics.select(
        "model",
        F.format_string("%.3fs", "fit_seconds").alias("fit_time"),
        F.format_string("%.4fs", "recommend_seconds").alias("recommend_time"),
        F.format_string("%.2f%%", "coverage").alias("coverage_txt"),
        F.format_string("%.2f%%", "diversity").alias("diversity_txt"),
        F.format_string("%.2f", "avg_rating").alias("avg_rating_txt"),
        F.col("n_queries").cast("bigint").alias("n_queries"))
