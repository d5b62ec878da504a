import math
import random

import pytest

from curbside.operators.spatial import candidate_pairs, nearest_station, stations_within
from curbside.params import Params

POINTS = "PULocationID int, lat double, lon double"
STATIONS = "name string, lat double, lon double, num_chargers int"


def km(lat1, lon1, lat2, lon2):
    p, q = math.radians(lat1), math.radians(lat2)
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 6371.0 * 2 * math.atan2(math.sqrt(h), math.sqrt(max(0.0, 1 - h)))


def scattered(seed):
    """Points and stations around the globe, in a dense city, at the poles and the date line."""
    rng = random.Random(seed)
    city = [(40.7 + rng.gauss(0, 0.05), -74 + rng.gauss(0, 0.05)) for _ in range(150)]
    world = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(60)]
    edges = [(90, 0), (-90, 10), (89.999, -170), (0, 180), (0, -180), (0.001, 179.999), (-0.001, -179.999)]
    copies = [(40.75, -73.98)] * 40
    places = city + world + edges
    rng.shuffle(places)
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(places[:110])]
    stations = [
        (f"s{i:03d}", float(a), float(b), i % 5) for i, (a, b) in enumerate(places[110:] + copies)
    ]
    return points, stations


@pytest.mark.parametrize("limit", [Params().broadcast_limit_bytes, 0])
@pytest.mark.parametrize("radius", [0.05, 1.0, 25.0, 3000.0, 30000.0])
def test_count_in_radius_equals_brute_force(spark, radius, limit):
    points, stations = scattered(1)
    result = stations_within(
        spark.createDataFrame(points, POINTS),
        spark.createDataFrame(stations, STATIONS),
        radius,
        params=Params(broadcast_limit_bytes=limit),
    )
    got = {r.PULocationID: (r.stations_within, r.chargers_total) for r in result.collect()}
    for i, lat, lon in points:
        near = [s for s in stations if km(lat, lon, s[1], s[2]) <= radius]
        assert got[i] == (len(near), sum(s[3] for s in near))


@pytest.mark.parametrize("limit", [Params().broadcast_limit_bytes, 0])
@pytest.mark.parametrize("seed", [2, 3])
def test_nearest_equals_brute_force(spark, seed, limit):
    points, stations = scattered(seed)
    result = nearest_station(
        spark.createDataFrame(points, POINTS),
        spark.createDataFrame(stations, STATIONS),
        with_name=True,
        params=Params(broadcast_limit_bytes=limit),
    )
    got = {r.PULocationID: r for r in result.collect()}
    assert len(got) == len(points)
    for i, lat, lon in points:
        best = min((km(lat, lon, s[1], s[2]), s[0]) for s in stations)
        assert got[i].nearest_station_km == pytest.approx(best[0], abs=1e-6)
        chosen = next(s for s in stations if s[0] == got[i].nearest_station)
        assert km(lat, lon, chosen[1], chosen[2]) == pytest.approx(best[0], abs=1e-6)


def test_far_from_a_dense_group(spark):
    points = [(1, -33.0, 151.0), (2, 40.7, -74.0)]
    stations = [(f"s{i}", 40.7 + i * 1e-5, -74.0, 1) for i in range(300)]
    rows = nearest_station(
        spark.createDataFrame(points, POINTS), spark.createDataFrame(stations, STATIONS)
    ).collect()
    got = {r.PULocationID: r.nearest_station_km for r in rows}
    for i, lat, lon in points:
        assert got[i] == pytest.approx(min(km(lat, lon, s[1], s[2]) for s in stations), abs=1e-6)


def test_either_side_of_the_radius(spark):
    degree = 1 / (6371.0 * math.pi / 180)
    stations = [("in", 40.0 + 0.999 * degree, -74.0, 1), ("out", 40.0 - 1.001 * degree, -74.0, 1)]
    points = spark.createDataFrame([(1, 40.0, -74.0)], POINTS)
    row = stations_within(points, spark.createDataFrame(stations, STATIONS), 1.0).first()
    assert row.stations_within == 1


def test_missing_positions_and_no_stations(spark):
    points = spark.createDataFrame(
        [(1, None, -74.0), (2, float("nan"), -74.0), (3, 40.0, -74.0)], POINTS
    )
    stations = spark.createDataFrame([("a", 40.0, -74.0, 1), ("b", None, -74.0, 1)], STATIONS)
    near = {r.PULocationID: r.nearest_station_km for r in nearest_station(points, stations).collect()}
    count = {r.PULocationID: r.stations_within for r in stations_within(points, stations, 1.0).collect()}
    assert near == {1: math.inf, 2: math.inf, 3: pytest.approx(0.0, abs=1e-9)}
    assert count == {1: 0, 2: 0, 3: 1}
    none = nearest_station(points, stations.limit(0)).collect()
    assert {r.nearest_station_km for r in none} == {math.inf}


def test_no_nested_loop(spark, plan_of):
    points, stations = scattered(4)
    p, s = spark.createDataFrame(points, POINTS), spark.createDataFrame(stations, STATIONS)
    for df in (nearest_station(p, s), stations_within(p, s, 1.0)):
        plan = plan_of(df)
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("limit", [Params().broadcast_limit_bytes, 0])
def test_a_dense_group_across_a_cube_face_is_seen(spark, limit):
    """A point beside 1000 stations, on either side of the meridian, and 2000 stations far away."""
    rng = random.Random(5)
    near = [(f"n{i}", 45.0 + rng.uniform(-0.002, 0.002), -0.001 - rng.random() * 0.05, 1) for i in range(1000)]
    far = [(f"f{i}", rng.uniform(-60, 40), rng.uniform(20, 170), 1) for i in range(2000)]
    points = spark.createDataFrame([(1, 45.0, 0.0005), (2, 45.0, -0.0005)], POINTS)
    stations = spark.createDataFrame(near + far, STATIONS)
    params = Params(broadcast_limit_bytes=limit)
    pairs = {r.PULocationID: r["count"] for r in candidate_pairs(points, stations, params=params).groupBy("PULocationID").count().collect()}
    assert max(pairs.values()) <= 100
    found = {r.PULocationID: r.nearest_station_km for r in nearest_station(points, stations, params=params).collect()}
    for i, lon in ((1, 0.0005), (2, -0.0005)):
        assert found[i] == pytest.approx(min(km(45.0, lon, s[1], s[2]) for s in near + far), rel=1e-9)


def test_stations_of_one_place_are_one_row_when_shuffled(spark):
    stations = spark.createDataFrame([(f"s{i}", 10.0, 20.0, 1) for i in range(500)], STATIONS)
    points = spark.createDataFrame([(1, 10.0, 20.0)], POINTS)
    params = Params(broadcast_limit_bytes=0)
    assert candidate_pairs(points, stations, with_name=True, params=params).count() == 1
    assert nearest_station(points, stations, with_name=True, params=params).first().nearest_station == "s0"
