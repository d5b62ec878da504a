import numpy as np
import pytest

from curbside.operators import reports


def values(spark, xs, name="avg_distance"):
    return spark.createDataFrame([(x,) for x in xs], f"{name} double")


@pytest.mark.parametrize("bins", [1, 7, 30, 50])
def test_histogram_equals_numpy(spark, bins):
    xs = [round(float(x), 2) for x in np.random.default_rng(5).gamma(2.0, 2.0, 400)] + [0.0, 10.0]
    rows = reports.histogram(values(spark, xs + [None, float("nan")]), "avg_distance", bins).collect()
    count, edges = np.histogram(xs, bins)
    density, _ = np.histogram(xs, bins, density=True)
    assert [r["count"] for r in rows] == count.tolist()
    assert [r.low for r in rows] == pytest.approx(edges[:-1]) and [r.high for r in rows] == pytest.approx(edges[1:])
    assert [r.density for r in rows] == pytest.approx(density)


def test_histogram_clips_and_survives_one_value(spark):
    rows = reports.histogram(values(spark, [-5.0, 3.0, 90.0]), "avg_distance", 4, clip=(0.0, 20.0)).collect()
    assert [r["count"] for r in rows] == [2, 0, 0, 1] and (rows[0].low, rows[-1].high) == (0.0, 20.0)
    same = reports.histogram(values(spark, [2.0, 2.0]), "avg_distance", 4).collect()
    assert [r["count"] for r in same] == np.histogram([2.0, 2.0], 4)[0].tolist()
    assert reports.histogram(values(spark, []), "avg_distance", 4).count() == 0


def test_density_curve_equals_the_formula(spark):
    xs = np.random.default_rng(6).normal(5, 2, 60)
    xs = np.append(xs, 40.0)  # the grid stops at 25
    rows = reports.density_curve(values(spark, xs.tolist()), "avg_distance").collect()
    grid = np.linspace(xs.min(), 25, 300)
    h = xs.std(ddof=1) * len(xs) ** -0.2
    want = np.exp(-(((grid[:, None] - xs) / h) ** 2) / 2).mean(axis=1) / (h * np.sqrt(2 * np.pi))
    assert [r.x for r in rows] == pytest.approx(grid) and [r.density for r in rows] == pytest.approx(want)


def test_density_curve_of_constant_values_is_empty(spark):
    assert reports.density_curve(values(spark, [2.0, 2.0]), "avg_distance").count() == 0
    assert reports.density_curve(values(spark, [2.0]), "avg_distance").count() == 0


def test_mean_and_median(spark):
    row = reports.mean_and_median(values(spark, [1.0, 2.0, 4.0, 9.0, None])).first()
    assert (row["mean"], row["median"]) == (4.0, 3.0)


def test_describe_ignores_nulls(spark):
    row = reports.describe(values(spark, [1.0, 3.0, None]), ["avg_distance"]).first()
    assert (row["column"], row["count"], row["mean"], row["min"], row["max"]) == ("avg_distance", 2, 2.0, 1.0, 3.0)
    assert row["stddev"] == pytest.approx(np.sqrt(2))


def test_boroughs_with_and_without_unknown(spark):
    zones = spark.createDataFrame([("A", 5), ("A", 1), (None, 2), ("B", 3)], "borough string, total_trips long")
    assert [tuple(r) for r in reports.trips_per_borough(zones).collect()] == [("B", 3), ("A", 6)]
    assert reports.trips_per_borough(zones, keep_unknown=True).count() == 3


def test_scaled_profiles(spark):
    columns = "cluster int, avg_trips_per_zone double, avg_distance double, rush_hour_fraction double"
    summary = spark.createDataFrame([(0, 10.0, 1.0, 0.2), (1, 20.0, 1.0, 0.4)], columns)
    first, second = reports.scaled_profiles(summary).collect()
    assert (first.avg_trips_per_zone, first.avg_distance) == (0.0, 0.0)
    assert second.avg_trips_per_zone == pytest.approx(1.0) and second.avg_distance == 0.0


def test_labels_are_cut(spark):
    recs = spark.createDataFrame(
        [(i, 1.0, 2.0, "A zone with a very long name") for i in range(1, 8)],
        "rank int, lon double, lat double, zone_name string",
    )
    labels = sorted(r.label for r in reports.top_labels(recs).collect())
    assert labels == [f"#{i} A zone with a very" for i in range(1, 6)]
    assert reports.top_labels(recs, width=16).first().label.endswith("a ve")


def test_median_by_brackets_is_exact(spark):
    rng = np.random.default_rng(9)
    for values in (rng.normal(size=2001), np.exp(rng.normal(size=2000) * 6), np.repeat([1.0, 2.0, 2.0, 1e9], 500), np.full(900, 3.5), np.array([5.0])):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "x double").repartition(5)
        known = df.where("x is not null and not isnan(x)")
        ordered = sorted(values.tolist())
        for rank in {0, len(values) // 2, (len(values) - 1) // 2, len(values) - 1}:
            assert reports.order_statistic(known, rank, len(values), ordered[0], ordered[-1], most=20, ranges=8) == ordered[rank]
        assert reports.mean_and_median(known, "x").first().median == pytest.approx(float(np.median(values)), rel=1e-15)
    assert reports.mean_and_median(known.limit(0), "x").first()["median"] is None


def test_a_value_reaches_few_grid_points_when_there_are_many(spark):
    rng = np.random.default_rng(2)
    values = np.round(rng.normal(size=20_000), 2)
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    spread = reports.kernel_rows(df, "x", 300, 25.0).count()
    different = len(set(values.tolist()))
    assert spread < 0.5 * 300 * different and different < 1000
    rows = reports.density_curve(df, "x").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    grid = np.linspace(values.min(), values.max(), 300)
    want = np.array([np.exp(-(((g - values) / h) ** 2) / 2).mean() for g in grid]) / (h * np.sqrt(2 * np.pi))
    assert [r.point for r in rows] == list(range(300)) and np.allclose([r.density for r in rows], want, atol=1e-12)
