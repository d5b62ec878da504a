from datetime import datetime, timedelta

import pytest
from support import as_ntz
from pyspark.sql import functions as F

from curbside.functions.calendar import clip, ratio_if_positive, speed_up
from curbside.operators.features import add_calendar, add_metrics, add_zones, clean_and_engineer
from curbside.params import Params
from curbside.sources import city_zones


def at(moment, minutes=30):
    return {"tpep_pickup_datetime": moment, "tpep_dropoff_datetime": moment + timedelta(minutes=minutes)}


def test_every_hour(make_trips):
    trips = make_trips(*[at(datetime(2023, 1, 4, h)) for h in range(24)])
    rows = {r.pickup_hour: r for r in add_calendar(trips).collect()}
    assert {h for h, r in rows.items() if r.is_rush_hour} == {7, 8, 9, 16, 17, 18, 19}
    parts = {}
    for hour, row in rows.items():
        parts.setdefault(row.time_of_day, set()).add(hour)
    assert parts == {
        "late_night": set(range(6)), "morning_rush": set(range(6, 10)), "midday": set(range(10, 16)),
        "evening_rush": set(range(16, 20)), "evening": set(range(20, 24)),
    }


def test_every_weekday(make_trips):
    sunday = datetime(2023, 1, 1, 12)
    trips = make_trips(*[at(sunday + timedelta(days=i)) for i in range(7)])
    rows = sorted(add_calendar(trips).collect(), key=lambda r: r.tpep_pickup_datetime)
    assert [r.pickup_dow for r in rows] == [1, 2, 3, 4, 5, 6, 7]
    assert [r.is_weekend for r in rows] == [1, 0, 0, 0, 0, 0, 1]
    assert {r.pickup_month for r in rows} == {1}


def test_unknown_zones_stay_with_nulls(make_trips, spark):
    row = add_zones(make_trips({"PULocationID": 200}), city_zones(spark)).first()
    assert (row.pu_borough, row.pu_lat, row.pu_lon, row.do_borough) == (None, None, None, "Manhattan")


def test_metrics(make_trips):
    row = add_metrics(make_trips({})).first()
    assert (row.trip_duration_min, row.speed_mph, row.fare_per_mile) == (30.0, 10.0, 4.0)


def test_both_timestamp_kinds_agree(make_trips, spark):
    moment = datetime(2023, 7, 4, 18, 5, 59, 900000)
    trips = make_trips({**at(moment), "tpep_dropoff_datetime": datetime(2023, 7, 4, 18, 30, 0, 100000)})
    zones = city_zones(spark)
    names = [n for n in clean_and_engineer(trips, zones).columns if not n.startswith("tpep")]
    instant = clean_and_engineer(trips, zones).select(names).first()
    wall_clock = clean_and_engineer(as_ntz(trips), zones).select(names).first()
    assert instant == wall_clock
    assert instant.trip_duration_min == pytest.approx((24 * 60 + 1) / 60)  # whole seconds per end


def test_small_zones_are_broadcast_and_large_ones_are_not(make_trips, spark, plan_of):
    trips, zones = make_trips({}, {"PULocationID": 5}), city_zones(spark)
    plan = plan_of(clean_and_engineer(trips, zones))
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    limited = Params(broadcast_limit_bytes=0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = clean_and_engineer(trips, zones, limited)
        assert "BroadcastHashJoin" not in plan_of(joined)
        assert sorted(joined.collect()) == sorted(clean_and_engineer(trips, zones).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_guards_and_clip(spark):
    df = spark.sql("SELECT * FROM VALUES (1.0D, 0.0D), (1.0D, 2.0D), (CAST(NULL AS DOUBLE), 2.0D) t(a, b)")
    ratios = [r[0] for r in df.select(ratio_if_positive(F.col("a"), F.col("b"))).collect()]
    assert ratios == [None, 0.5, None]
    values = spark.sql("SELECT * FROM VALUES (-1.0D), (3.0D), (25.0D), (CAST(NULL AS DOUBLE)) t(x)")
    assert [r[0] for r in values.select(clip(F.col("x"), 0.0, 20.0)).collect()] == [0.0, 3.0, 20.0, None]


def test_speed_up(spark):
    df = spark.sql("SELECT * FROM VALUES (8.9D, 7.1D), (1.0D, 0.0D), (1.0D, 8.0D) t(a, b)")
    assert [r[0] for r in df.select(speed_up(F.col("a"), F.col("b"))).collect()] == [1.25, 1.0, 0.12]
