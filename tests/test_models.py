import numpy as np
import pytest
from support import SF
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from curbside.catalog import tables
from curbside.operators import aggregates, lloyd, models
from curbside.operators.boosting import LEAST_GAIN, cuts_of, fit_boosted
from curbside.operators.features import trip_features
from curbside.operators.ridge import fit_ridge
from curbside.params import Params
from curbside.plans.settle import settle

FAST = Params(clusters=4, gbt_trees=3, gbt_depth=3)


@pytest.fixture(scope="module")
def small(spark):
    features, zones = trip_features(tables.trips(spark, SF)), tables.zones(spark, SF)
    return (
        settle(aggregates.zone_aggregates(features, zones)),
        settle(aggregates.hourly_demand(features, zones)),
    )


def test_column_scaler_equals_the_fitted_one(small):
    zones, _ = small
    constant = zones.withColumn("avg_fare", F.lit(7.0))
    vectors = models.standard_vectors(constant).select("PULocationID", vector_to_array("features").alias("v"))
    want = {r.PULocationID: r.v for r in vectors.collect()}
    for row in models.standardise(constant).collect():
        got = [row[f"{name}_scaled"] for name in models.CLUSTER_FEATURES]
        assert got == pytest.approx(want[row.PULocationID], abs=1e-9)


def test_kmeans_is_repeatable_and_complete(small):
    zones, _ = small
    runs = []
    for _ in range(2):
        clustered, _, summary = models.run_kmeans(zones, FAST)
        runs.append({r.PULocationID: r.cluster for r in clustered.collect()})
    assert runs[0] == runs[1] and len(runs[0]) == zones.count()
    assert set(runs[0].values()) <= set(range(4))
    rows = summary.collect()
    assert sum(r.num_zones for r in rows) == zones.count()
    assert len({r.silhouette for r in rows}) == 1 and -1 <= rows[0].silhouette <= 1


def test_rows_without_features_are_left_out(small):
    zones, _ = small
    broken = zones.withColumn("avg_fare", F.when(F.col("PULocationID") > 3, F.col("avg_fare")))
    assert models.cluster_input(broken).count() == zones.count() - 3


def test_sweep_cost_falls(small):
    rows = models.k_sweep(small[0], (2, 8), FAST).collect()
    assert [r.k for r in rows] == [2, 8] and rows[0].wssse > rows[1].wssse


def test_metrics_equal_the_evaluator(spark):
    rows = [(3, 2.5), (5, 5.5), (9, 7.0), (1, 1.5), (4, 4.0)]
    predictions = spark.createDataFrame(rows, "trip_count long, prediction double")
    got = models.regression_metrics(predictions, "m").first()
    evaluator = RegressionEvaluator(labelCol="trip_count", predictionCol="prediction")
    for name in ("rmse", "mae", "r2"):
        assert got[name] == pytest.approx(evaluator.setMetricName(name).evaluate(predictions), abs=1e-12)


def test_equal_labels_have_no_r2(spark):
    predictions = spark.createDataFrame([(3, 2.5), (3, 3.5)], "trip_count long, prediction double")
    assert models.regression_metrics(predictions, "m").first().r2 is None


def test_hash_split_is_a_partition_of_the_rows(small):
    ready = models.demand_input(small[1])
    train, test = models.hash_split(ready)
    total = ready.count()
    assert train.count() + test.count() == total
    assert 0.75 < train.count() / total < 0.85
    again = models.hash_split(ready.repartition(3))[0]
    assert again.select(*models.DEMAND_KEY).exceptAll(train.select(*models.DEMAND_KEY)).count() == 0


def test_random_split_covers_all_rows(small):
    train, test = models.random_split(models.demand_input(small[1]))
    assert train.count() + test.count() == small[1].count()


def test_regression_tables(small):
    metrics, importances = models.run_regression(small[1], FAST)
    rows = metrics.collect()
    assert [r.model for r in rows] == [models.LINEAR, models.TREES]
    assert all(r.rmse > 0 and r.mae > 0 and r.r2 is not None for r in rows)
    values = {r.feature: r.importance for r in importances.collect()}
    assert tuple(values) == models.DEMAND_FEATURES and sum(values.values()) == pytest.approx(1.0)


def test_ridge_equals_the_stepwise_solver(small):
    train, test = models.hash_split(models.demand_input(small[1]))
    constant = [df.withColumn("is_weekend", F.lit(1)) for df in (train, test)]
    for a, b in ((train, test), constant):
        want = {tuple(r[k] for k in models.DEMAND_KEY): r.prediction for r in models.fit_linear_by_steps(a).transform(b).collect()}
        got = {tuple(r[k] for k in models.DEMAND_KEY): r.prediction for r in models.fit_linear(a).transform(b).collect()}
        assert got == pytest.approx(want, abs=1e-6)


def test_ridge_of_a_constant_label_and_of_no_rows(spark):
    rows = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 7.0, 5.0)], "a double, b double, y double")
    fit = fit_ridge(rows, ("a", "b"), "y", 0.01)
    assert fit.coefficients == (0.0, 0.0) and fit.intercept == 5.0
    with pytest.raises(ValueError, match="no rows"):
        fit_ridge(rows.limit(0), ("a", "b"), "y", 0.01)


def test_rounds_start_at_the_farthest_points_and_end_at_means(spark):
    rows = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate([(0, 0), (0, 1), (9, 9), (9, 8), (0, 9), (0, 9)])], "id long, a double, b double")
    points, scale = lloyd.prepare(rows, "id", ("a", "b"))
    start = lloyd.farthest_points(points, "id", 10)
    assert len(start) == 5  # the different points
    values = np.array([[r.a, r.b] for r in rows.orderBy("id").collect()])
    scaled = (values - values.mean(axis=0)) / values.std(axis=0, ddof=1)
    assert np.allclose(start[:2], scaled[[0, 2]])
    centers, _ = lloyd.rounds(points.repartition(3), start[:3], 50)
    assert np.allclose(sorted(centers), sorted([scaled[:2].mean(axis=0).tolist(), scaled[2:4].mean(axis=0).tolist(), scaled[4].tolist()]))
    fit = lloyd.LloydFit(scale, centers, 1)
    own = {r.id: r.cluster for r in fit.transform(rows).collect()}
    assert own[0] == own[1] and own[2] == own[3] and own[4] == own[5] and len(set(own.values())) == 3
    assert lloyd.cost(points, centers) == pytest.approx(sum(((scaled[i] - np.array(centers[own[i]])) ** 2).sum() for i in own))


def boosted_by_brute_force(x, y, cuts, trees, depth, step):
    prediction = np.zeros(len(y))
    for tree in range(trees):
        e = y - prediction

        def value(rows, level):
            mean = e[rows].mean()
            best = (LEAST_GAIN * (e[rows] ** 2).sum(), None)
            for f, own in enumerate(cuts) if level < depth else ():
                for cut in own:
                    left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                    if len(left) and len(right):
                        gain = round(e[left].sum() ** 2 / len(left) + e[right].sum() ** 2 / len(right) - e[rows].sum() ** 2 / len(rows), 6)
                        if gain > best[0]:
                            best = (gain, (left, right))
            if best[1] is None:
                out[rows] = mean
            else:
                for side in best[1]:
                    value(side, level + 1)

        out = np.zeros(len(y))
        value(np.arange(len(y)), 0)
        prediction = prediction + out * (step if tree else 1.0)
    return prediction


def test_boosted_trees_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 9, 200), rng.normal(size=200), np.full(200, 3.0)])
    y = np.where(x[:, 0] > 4, 10, 2) + x[:, 1] + rng.normal(size=200) / 10
    rows = spark.createDataFrame([(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))], "id long, a double, b double, c double, y double").repartition(4)
    fit = fit_boosted(rows, ("a", "b", "c"), "y", 3, 3, 0.5, bins=8)
    want = boosted_by_brute_force(x, y, cuts_of(rows, ("a", "b", "c"), 8), 3, 3, 0.5)
    got = [r.prediction for r in fit.transform(rows).orderBy("id").collect()]
    assert got == pytest.approx(want.tolist(), abs=1e-9)
    shares = fit.importances()
    assert sum(shares.values()) == pytest.approx(1) and shares["c"] == 0 and shares["a"] > shares["b"] > 0


def test_boosted_trees_without_anything_to_split(spark):
    rows = spark.createDataFrame([(1.0, 4.0), (1.0, 6.0)], "a double, y double")
    fit = fit_boosted(rows, ("a",), "y", 2, 3, 0.1)
    assert not fit.splits and fit.importances() == {"a": 0.0}
    assert [r.prediction for r in fit.transform(rows).collect()] == [5.0, 5.0]


def test_seeded_clusters_are_still_offered(small):
    clustered = models.assign_clusters(small[0], models.fit_seeded_clusters(small[0], FAST))
    assert {r.cluster for r in clustered.select("cluster").distinct().collect()} <= set(range(4))
