"""Zone clustering and demand regression: exact fits from aggregates, and MLlib's seeded ones.

Inputs are the zone and hourly tables, at most zones x 24 x 7 rows however many trips there are.
Fits read their input many times, so pass a settled table (see ``plans.settle``).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.operators import lloyd
from curbside.operators.aggregates import cluster_summary
from curbside.operators.boosting import BoostedFit, fit_boosted
from curbside.operators.ridge import RidgeFit, fit_ridge
from curbside.params import Params

# Model inputs, in this order.
CLUSTER_FEATURES = (
    "total_trips", "avg_distance", "avg_fare", "avg_speed_mph", "rush_hour_fraction",
    "weekend_fraction", "avg_duration_min",
)
DEMAND_FEATURES = (
    "PULocationID", "pickup_hour", "pickup_dow", "is_weekend", "is_rush_hour", "avg_distance", "avg_fare",
)
DEMAND_KEY = ("PULocationID", "pickup_hour", "pickup_dow")
LABEL = "trip_count"
LINEAR, TREES = "Linear Regression", "Gradient Boosted Trees"


def in_order(df: DataFrame, *key: str, params: Params = Params()) -> DataFrame:
    """Rows in key order, in as many partitions as the row count asks for. A seeded fit then gives
    the same model whatever the shuffle settings of the session."""
    partitions = max(1, math.ceil(df.count() / params.rows_per_task))
    return df.repartitionByRange(partitions, *key).sortWithinPartitions(*key)


# --- clustering ---------------------------------------------------------------------------------


def cluster_input(zones: DataFrame) -> DataFrame:
    """Zones with every cluster feature present."""
    return zones.dropna(subset=list(CLUSTER_FEATURES))


def assemble(df: DataFrame, features: Sequence[str], output: str) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output).transform(df)


def _scaling_stages() -> list:
    return [
        VectorAssembler(inputCols=list(CLUSTER_FEATURES), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
    ]


def standard_vectors(zones: DataFrame) -> DataFrame:
    """Adds ``raw_features`` and the standardised ``features``."""
    ready = cluster_input(zones)
    return Pipeline(stages=_scaling_stages()).fit(ready).transform(ready)


def standardise(df: DataFrame, features: Iterable[str] = CLUSTER_FEATURES) -> DataFrame:
    """Column form of the scaler: (x - mean) / sample deviation, 0 for a constant column."""
    names = list(features)
    moments = df.agg(
        F.struct(
            *[F.avg(n).alias(f"{n}_mean") for n in names],
            *[F.stddev_samp(n).alias(f"{n}_sd") for n in names],
        )
    ).scalar()

    def scaled(name: str) -> Column:
        sd = moments.getField(f"{name}_sd")
        return F.when(sd > 0, (F.col(name) - moments.getField(f"{name}_mean")) / sd).otherwise(0.0)

    return df.withColumns({f"{n}_scaled": scaled(n) for n in names})


def _kmeans(k: int, max_iter: int, params: Params) -> KMeans:
    return KMeans(
        featuresCol="features", predictionCol="cluster", k=k, maxIter=max_iter, seed=params.seed
    )


def fit_clusters(zones: DataFrame, params: Params = Params()) -> lloyd.LloydFit:
    """KMeans from a fixed start, in rounds of aggregates: one result for any partitioning and engine."""
    ready = cluster_input(zones)
    rows, scale = lloyd.prepare(ready, "PULocationID", CLUSTER_FEATURES)
    rows = few_partitions(rows, params).persist()
    try:
        start = lloyd.farthest_points(rows, "PULocationID", params.clusters)
        return lloyd.LloydFit(scale, *lloyd.rounds(rows, start, params.kmeans_max_iter))
    finally:
        rows.unpersist()


def few_partitions(df: DataFrame, params: Params) -> DataFrame:
    """As many partitions as the row count asks for, for many small jobs over the same rows."""
    return df.coalesce(max(1, math.ceil(df.count() / params.rows_per_task)))


def fit_seeded_clusters(zones: DataFrame, params: Params = Params()) -> PipelineModel:
    """MLlib's assembler, scaler and KMeans with a random start. Rows enter in zone order, so a fixed seed gives one
    result."""
    stages = [*_scaling_stages(), _kmeans(params.clusters, params.kmeans_max_iter, params)]
    return Pipeline(stages=stages).fit(in_order(cluster_input(zones), "PULocationID", params=params))


def assign_clusters(zones: DataFrame, model: lloyd.LloydFit | PipelineModel) -> DataFrame:
    return model.transform(cluster_input(zones))


def silhouette(clustered: DataFrame) -> float:
    """Mean silhouette with squared Euclidean distance."""
    evaluator = ClusteringEvaluator(featuresCol="features", predictionCol="cluster")
    return evaluator.evaluate(clustered)


def with_silhouette(summary: DataFrame, score: float) -> DataFrame:
    return summary.withColumn("silhouette", F.lit(float(score)))


def run_kmeans(
    zones: DataFrame, params: Params = Params()
) -> tuple[DataFrame, lloyd.LloydFit, DataFrame]:
    """Clustered zones, the fitted model, and one summary row per cluster."""
    model = fit_clusters(zones, params)
    clustered = assign_clusters(zones, model)
    summary = with_silhouette(cluster_summary(clustered), silhouette(clustered))
    return clustered, model, summary


def k_sweep(
    zones: DataFrame, ks: Iterable[int] = range(2, 12), params: Params = Params()
) -> DataFrame:
    """Within-cluster cost and silhouette per number of clusters.

    The start for fewer clusters is the beginning of that for more, so that it is found once. Where the rows have
    fewer different points than clusters, there are as many clusters as points.
    """
    ks = list(ks)
    ready = cluster_input(zones)
    rows, _ = lloyd.prepare(ready, "PULocationID", CLUSTER_FEATURES)
    rows = few_partitions(rows, params).persist()

    def fit(k: int) -> tuple[int, float, float]:
        centers, _ = lloyd.rounds(rows, start[:k], params.sweep_max_iter)
        vectors = {"features": array_to_vector(lloyd.POINT), "cluster": lloyd.nearest(lloyd.squares(F.col(lloyd.POINT), centers))}
        return k, lloyd.cost(rows, centers), float(silhouette(rows.withColumns(vectors)))

    try:
        start = lloyd.farthest_points(rows, "PULocationID", max(ks, default=0))
        with ThreadPoolExecutor(params.parallelism) as pool:  # each fit is many small jobs, so some run at once
            found = list(pool.map(fit, ks))
    finally:
        rows.unpersist()
    return zones.sparkSession.createDataFrame(found, "k int, wssse double, silhouette double")


# --- demand regression --------------------------------------------------------------------------


def demand_input(hourly: DataFrame) -> DataFrame:
    """Hourly rows with every feature and a positive label."""
    return hourly.dropna(subset=[*DEMAND_FEATURES, LABEL]).where(F.col(LABEL) > 0)


def hash_bucket(*names: str) -> Column:
    """0..99 from the md5 of the key columns: the same for any partitioning or engine."""
    text = F.concat_ws("|", *[F.col(n).cast("string") for n in names])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % 100


def is_train(params: Params = Params(), key: Sequence[str] = DEMAND_KEY) -> Column:
    return hash_bucket(*key) < round(100 * params.train_ratio)


def hash_split(
    df: DataFrame, params: Params = Params(), key: Sequence[str] = DEMAND_KEY
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, by a hash of the row key."""
    train = is_train(params, key)
    return df.where(train), df.where(~train)


def random_split(df: DataFrame, params: Params = Params()) -> tuple[DataFrame, DataFrame]:
    """Spark's seeded split; its outcome depends on the partitioning of ``df``."""
    train, test = df.randomSplit([params.train_ratio, 1 - params.train_ratio], seed=params.seed)
    return train, test


def _linear(params: Params) -> LinearRegression:
    return LinearRegression(
        featuresCol="features",
        labelCol=LABEL,
        maxIter=params.linear_max_iter,
        regParam=params.linear_reg_param,
        elasticNetParam=params.linear_elastic_net,
    )


def _trees(params: Params) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features",
        labelCol=LABEL,
        maxIter=params.gbt_trees,
        maxDepth=params.gbt_depth,
        stepSize=params.gbt_step,
        seed=params.seed,
    )


def fit_linear(train: DataFrame, params: Params = Params()) -> RidgeFit | PipelineModel:
    """Ridge regression by normal equations, from one aggregate of the rows; an L1 part of the penalty has no closed form
    and is left to MLlib."""
    if params.linear_elastic_net:
        return fit_linear_by_steps(train, params)
    return fit_ridge(train, DEMAND_FEATURES, LABEL, params.linear_reg_param)


def fit_linear_by_steps(train: DataFrame, params: Params = Params()) -> PipelineModel:
    return _fit_demand(train, params, _linear(params))[0]


def fit_trees(train: DataFrame, params: Params = Params()) -> PipelineModel:
    return _fit_demand(train, params, _trees(params))[0]


def fit_histogram_trees(train: DataFrame, params: Params = Params()) -> BoostedFit:
    """Boosted trees by split search on histograms: one result for any partitioning and engine."""
    return fit_boosted(train, DEMAND_FEATURES, LABEL, params.gbt_trees, params.gbt_depth, params.gbt_step)


def _fit_demand(train: DataFrame, params: Params, *estimators) -> list[PipelineModel]:
    """Fit each estimator on one prepared table, which is released at the end, also of a failed fit."""
    assembler = VectorAssembler(inputCols=list(DEMAND_FEATURES), outputCol="features")
    rows = assembler.transform(in_order(train, *DEMAND_KEY, params=params)).persist()
    try:
        rows.count()
        with ThreadPoolExecutor(params.parallelism) as pool:
            models = list(pool.map(lambda estimator: estimator.fit(rows), estimators))
    finally:
        rows.unpersist()
    return [PipelineModel([assembler, model]) for model in models]


def regression_metrics(predictions: DataFrame, model: str, label: str = LABEL) -> DataFrame:
    """RMSE, MAE and R2 in one pass. R2 is null when all labels are equal."""
    actual = F.col(label).cast("double")
    error = actual - F.col("prediction")
    return predictions.agg(
        F.lit(model).alias("model"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.try_divide(F.avg(error * error), F.var_pop(actual))).alias("r2"),
    )


def feature_importances(model: PipelineModel, like: DataFrame) -> DataFrame:
    """(feature, importance) rows of a fitted tree model, in feature order."""
    values = model.stages[-1].featureImportances.toArray().tolist()
    rows = list(zip(DEMAND_FEATURES, values, strict=True))
    return like.sparkSession.createDataFrame(rows, "feature string, importance double")


def run_regression(
    hourly: DataFrame, params: Params = Params(), split=hash_split
) -> tuple[DataFrame, DataFrame]:
    """Metrics of both models on the test rows, and the importances of the tree model."""
    train, test = split(demand_input(hourly), params)
    linear, trees = fit_linear(train, params), fit_trees(train, params)
    metrics = regression_metrics(linear.transform(test), LINEAR).unionByName(
        regression_metrics(trees.transform(test), TREES)
    )
    return metrics, feature_importances(trees, hourly)
