import math

import pytest
from pyspark.sql import functions as F

from curbside.functions import scores
from curbside.operators import recommend
from curbside.params import Params
from curbside.plans.settle import settle
from curbside.plans.sites import recommend_from_zones
from curbside.sources import city_stations, city_zones

ZONES = (
    "PULocationID int, borough string, lat double, lon double, total_trips long, "
    "rush_hour_fraction double, avg_distance double, avg_fare double, cluster int"
)

# Ten stored recommendations, in rank order. Zone, borough, position, trips, rush
# share, distance, fare, cluster | demand, nearest km, stations in the radius, gap, priority, name,
# trips a year, kg, tonnes.
GOLDEN = """
72|Brooklyn|40.6234|-73.9318|30|0.4|2.7786666667|13.827|3|0.3026086957|9.353482873|0|0.8116823749|0.5062381674|Flatlands|360|97|0.1
162|Manhattan|40.7549|-73.968|97|0.412371134|3.4167010309|17.1642268041|1|0.7141461228|1.5137800498|0|0.13136375|0.4810331737|Midtown East|1164|387|0.4
234|Manhattan|40.768|-73.959|87|0.4597701149|3.7427586207|18.5890804598|2|0.6674962519|0.672463141|1|0.0583554262|0.4238399216|Upper East Side South|1044|380|0.4
129|Queens|40.7773|-73.874|94|0.414893617|2.9778723404|15.2476595745|1|0.6966419981|0.0537152072|1|0.0046613318|0.4198497316|LaGuardia Airport|1128|326|0.3
232|Manhattan|40.7359|-73.9911|80|0.4875|3.279|16.068375|1|0.6332065217|0.5289620787|1|0.0459026014|0.3982849536|Union Square|960|306|0.3
236|Manhattan|40.7887|-73.9757|65|0.4769230769|3.1003076923|15.4316923077|0|0.538729097|2.1021969756|0|0.1824257613|0.3962077627|Upper West Side North|780|235|0.2
163|Manhattan|40.768|-73.988|74|0.472972973|3.3671621622|16.7837837838|1|0.5923266745|1.1317081927|0|0.0982080799|0.3946792367|Midtown North|888|291|0.3
17|Brooklyn|40.6872|-73.9418|44|0.4318181818|2.9781818182|15.1118181818|0|0.3973715415|4.1553590482|0|0.3605963411|0.3826614614|Bedford-Stuyvesant|528|153|0.2
237|Manhattan|40.7789|-73.9835|61|0.4754098361|3.8986885246|19.2832786885|2|0.5139272986|2.0524327921|0|0.1781072939|0.3795992967|Upper West Side South|732|277|0.3
128|Manhattan|40.7434|-73.9768|70|0.4571428571|3.5267142857|16.7668571429|1|0.5632298137|1.11748136|0|0.096973495|0.3767272862|Kips Bay|840|288|0.3
"""
# Two more zones hold the largest trip count and distance and are filtered out themselves.
HELPERS = [
    (224, "Manhattan", 40.7590, -73.9845, 115, 0.4, 3.0, 15.0, 1),
    (54, "Brooklyn", 40.5755, -73.9707, 1, 0.4, 3.0, 15.0, 3),
]


def golden_rows():
    return [line.split("|") for line in GOLDEN.strip().splitlines()]


def zone_row(cells):
    i, borough, lat, lon, trips, rush, distance, fare, cluster = cells[:9]
    return (
        int(i), borough, float(lat), float(lon), int(trips), float(rush), float(distance), float(fare), int(cluster)
    )


def test_stored_recommendations(spark):
    zones = spark.createDataFrame([zone_row(r) for r in reversed(golden_rows())] + HELPERS, ZONES)
    params = Params(min_trips=30, top_n=10)
    rows = recommend_from_zones(settle(zones), city_zones(spark), city_stations(spark), params).collect()
    assert len(rows) == 10
    for place, (row, want) in enumerate(zip(rows, golden_rows(), strict=True), start=1):
        assert row.rank == place and row.PULocationID == int(want[0]) and row.zone_name == want[14]
        exact = (row.chargers_within_1km, row.annual_trips_est, row.annual_co2_saved_kg)
        assert exact == (int(want[11]), int(want[15]), int(want[16]))
        assert row.annual_co2_saved_tonnes == float(want[17])
        got = (row.demand_score, row.nearest_station_km, row.gap_score, row.priority_score)
        for value, cell in zip(got, (want[9], want[10], want[12], want[13]), strict=True):
            assert value == pytest.approx(float(cell), abs=1e-6)
    assert tuple(rows[0].asDict()) == recommend.RECOMMENDATION_COLUMNS


def test_city_tables(spark):
    zones, stations = city_zones(spark), city_stations(spark)
    assert zones.count() == zones.select("zone_id").distinct().count() == 56
    assert stations.count() == 20


def measured(spark, *rows):
    """zone, trips, rush, nearest km, stations within the radius"""
    df = spark.createDataFrame(
        list(rows),
        "PULocationID int, total_trips long, rush_hour_fraction double, nearest_station_km double, "
        "chargers_within_1km long",
    )
    return df.withColumn("avg_distance", F.lit(2.0))


def test_maxima_come_before_the_filters(spark):
    df = measured(spark, (1, 600, 0.5, 2.0, 0), (2, 1000, 0.5, 1.0, 2), (3, 10, 0.5, 4.0, 0))
    row = recommend.rank_sites(df, city_zones(spark)).collect()
    assert [r.PULocationID for r in row] == [1]
    assert row[0].demand_score == pytest.approx(0.6 * 0.7 + 0.15)
    assert row[0].gap_score == pytest.approx(0.5)


def test_distance_is_capped_in_the_numerator_only(spark):
    rows = {r.PULocationID: r for r in recommend.score_zones(
        measured(spark, (1, 600, 0.5, 50.0, 0), (2, 600, 0.5, 10.0, 0))
    ).collect()}
    assert rows[1].nearest_station_km_clipped == 30.0
    assert rows[1].gap_score == pytest.approx(0.6) and rows[2].gap_score == pytest.approx(0.2)


def test_infinite_distance_counts_as_the_cap(spark):
    rows = {r.PULocationID: r for r in recommend.score_zones(
        measured(spark, (1, 600, 0.5, math.inf, 0), (2, 600, 0.5, 15.0, 0))
    ).collect()}
    assert rows[1].gap_score == 1.0 and rows[2].gap_score == 0.5


def test_ties_go_to_the_smaller_zone_id_and_n_limits(spark):
    df = measured(spark, *[(i, 600, 0.5, 2.0, 0) for i in (9, 3, 7, 5)])
    ranked = recommend.rank_sites(df, city_zones(spark), Params(top_n=3)).collect()
    assert [(r.PULocationID, r.rank) for r in ranked] == [(3, 1), (5, 2), (7, 3)]
    assert [r.zone_name for r in ranked] == ["Zone 3", "Zone 5", "Astoria"]


def test_thresholds(spark):
    df = measured(spark, (1, 499, 0.5, 2.0, 0), (2, 500, 0.5, 2.0, 1), (3, 501, 0.5, 2.0, 2))
    assert [r.PULocationID for r in recommend.rank_sites(df, city_zones(spark)).collect()] == [2]


def test_rounding_is_half_to_even(spark):
    kg = spark.sql("SELECT * FROM VALUES (2500L), (1250L), (1350L), (150L), (250L), (2050L) t(kg)")
    import numpy as np

    want = [float(np.round(v / 1000.0, 1)) for v in (2500, 1250, 1350, 150, 250, 2050)]
    assert [r[0] for r in kg.select(scores.saved_tonnes(F.col("kg"))).collect()] == want
    halves = spark.sql("SELECT * FROM VALUES (0.5D), (1.5D), (2.5D) t(x)")
    grams = F.col("x") * 1000 / F.lit(0.3)
    got = halves.select(scores.annual_saved_kg(F.lit(1), grams)).collect()
    assert [r[0] for r in got] == [0, 2, 2]


def test_zones_without_position_are_dropped_before_the_maxima(spark):
    rows = [zone_row(golden_rows()[0]), (200, None, None, None, 10_000, 0.5, 3.0, 15.0, 1)]
    zones = settle(spark.createDataFrame(rows, ZONES))
    found = recommend_from_zones(zones, city_zones(spark), city_stations(spark), Params(min_trips=1))
    assert [(r.PULocationID, r.demand_score) for r in found.collect()] == [(72, pytest.approx(0.7 + 0.12))]


def test_cluster_is_optional(spark):
    zones = spark.createDataFrame([zone_row(golden_rows()[0])], ZONES).drop("cluster")
    found = recommend_from_zones(zones, city_zones(spark), city_stations(spark), Params(min_trips=1))
    assert "cluster" not in found.columns and found.count() == 1


def test_fully_known_zones(spark):
    rows = [zone_row(golden_rows()[0]), (200, None, 1.0, 1.0, 10, 0.5, 3.0, 15.0, 1)]
    assert recommend.fully_known_zones(spark.createDataFrame(rows, ZONES)).count() == 1
