"""Prediction-based recommenders: ridge (R-6), random forest (R-4, R-5).

Models are fitted with Spark ML estimators (distributed); the prediction
table ``(item_id, prediction)`` then feeds ``nearest_by_value`` (R-3).
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .stats import standard_scale


def imputed_target(df: DataFrame, target: str = "vote_average") -> F.Column:
    """Target with nulls replaced by its mean (A-10), as a column expression."""
    return F.coalesce(F.col(target).cast("double"), df.select(F.avg(target)).scalar())


def scaled_features(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Numeric features: nulls → 0, then population standard scaling (A-11)."""
    cols = [c for c in cols if c in df.columns]
    return standard_scale(df, cols), [c + "_scaled" for c in cols]


def fit_ridge(data: DataFrame, features_col: str = "features", label_col: str = "label",
              alpha: float = 1.0):
    """Ridge ``‖y − Xw − b‖² + α‖w‖²`` through Spark's normal-equation solver.

    Spark minimises ``1/(2n)‖·‖² + λ/2‖w‖²`` on a label scaled by its
    standard deviation, so ``λ = α · std_pop(y) / n`` gives the same
    solution.  The normal solver handles up to 4,096 features in one pass.
    """
    st = data.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label_col).alias("sy")).first()
    n, sy = st["n"], st["sy"] or 0.0
    reg = alpha * sy / n if n else 0.0
    lr = LinearRegression(featuresCol=features_col, labelCol=label_col, predictionCol="prediction",
                          regParam=reg, elasticNetParam=0.0, solver="normal",
                          standardization=False, fitIntercept=True)
    return lr.fit(data)


def ridge_predictions(df: DataFrame, numeric: list[str], alpha: float = 1.0,
                      target: str = "vote_average", text_vectors: DataFrame | None = None,
                      text_col: str = "tfidf") -> DataFrame:
    """Fit ridge on [text vector +] scaled numerics, predict every item."""
    scaled, cols = scaled_features(df, numeric)
    base = scaled.select("item_id", imputed_target(df, target).alias("label"), *cols)
    inputs = list(cols)
    if text_vectors is not None:
        base = base.join(text_vectors, "item_id")
        inputs = [text_col] + inputs
    data = VectorAssembler(inputCols=inputs, outputCol="features").transform(base)
    model = fit_ridge(data, alpha=alpha)
    return model.transform(data).select("item_id", "prediction")


def forest_predictions(df: DataFrame, text_vectors: DataFrame | None, numeric: list[str],
                       num_trees: int = 100, max_depth: int = 10, seed: int = 42,
                       target: str = "vote_average", text_col: str = "tfidf",
                       max_memory_mb: int = 48, partitions: int | None = None):
    """R-4: random forest regressor on [text vector +] scaled numerics.

    All features are considered at every split (the reference's regressor
    default); the data is hash-partitioned by ``item_id`` so the bootstrap
    samples do not depend on the input file layout.  Each tree level is one
    pass over the data per node group; ``max_memory_mb`` bounds the split
    statistics per group (features × bins × nodes) *per task*, so it must fit
    executor memory divided by concurrent tasks.  The default (48 MB) keeps
    eight concurrent tasks under 0.5 GB: with 1,003 features and 100 deep
    trees, 256 MB per task exhausted an 8 GB heap under load, while the
    smaller budget trains the same trees in the same time.  Node ids are
    cached (and checkpointed) for deep trees.
    """
    scaled, cols = scaled_features(df, numeric) if numeric else (df, [])
    base = scaled.select("item_id", imputed_target(df, target).alias("label"), *cols)
    inputs = list(cols)
    if text_vectors is not None:
        base = base.join(text_vectors, "item_id")
        inputs = [text_col] + inputs
    # Explicit count: AQE would coalesce this small-but-compute-heavy input into one task.
    base = base.repartition(partitions or shuffle_partitions(df.sparkSession), "item_id")
    data = VectorAssembler(inputCols=inputs, outputCol="features").transform(
        base.sortWithinPartitions("item_id"))
    rf = RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=num_trees,
                               maxDepth=max_depth, seed=seed, featureSubsetStrategy="all",
                               maxMemoryInMB=max_memory_mb, cacheNodeIds=True, checkpointInterval=10)
    model = rf.fit(data)
    return model.transform(data).select("item_id", "prediction"), model, inputs


def feature_importance(model, names: list[str], top_n: int = 20, spark=None) -> DataFrame:
    """R-5: the ``top_n`` features by importance, named by term / numeric column."""
    imp = model.featureImportances.toArray().tolist()
    rows = [(names[i] if i < len(names) else f"f{i}", float(v)) for i, v in enumerate(imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), F.asc("feature")).limit(top_n)
