from datetime import datetime, timedelta

import pytest

from curbside.operators.clean import (
    BASIC_RULES,
    METRIC_RULES,
    apply_rules,
    audit,
    clean,
    clean_compact,
)
from curbside.params import Params

START = datetime(2023, 1, 4, 8, 0, 0)
NAN = float("nan")


def lasting(minutes=0.0, **more):
    return {
        "tpep_pickup_datetime": START,
        "tpep_dropoff_datetime": START + timedelta(minutes=minutes),
        **more,
    }


KEPT = [
    {"trip_distance": 0.1}, {"trip_distance": 100.0},
    {"fare_amount": 2.5}, {"fare_amount": 500.0},
    {"passenger_count": 1.0}, {"passenger_count": 8.0},
    lasting(1 / 60), {"PULocationID": 1}, {"PULocationID": 265},
    {"DOLocationID": 1}, {"DOLocationID": 265}, {"total_amount": 0.01},
]
DROPPED = [
    {"trip_distance": 0.099}, {"trip_distance": 100.001}, {"trip_distance": None}, {"trip_distance": NAN},
    {"fare_amount": 2.49}, {"fare_amount": 500.01}, {"fare_amount": None}, {"fare_amount": NAN},
    {"passenger_count": 0.0}, {"passenger_count": 9.0}, {"passenger_count": None}, {"passenger_count": NAN},
    lasting(0), lasting(-1), {"tpep_pickup_datetime": None}, {"tpep_dropoff_datetime": None},
    {"PULocationID": 0}, {"PULocationID": 266}, {"PULocationID": None},
    {"DOLocationID": 0}, {"DOLocationID": 266}, {"DOLocationID": None},
    {"total_amount": 0.0}, {"total_amount": None}, {"VendorID": None},
]


def test_bounds_are_inclusive_and_outside_is_dropped(make_trips):
    assert clean(make_trips(*KEPT)).count() == len(KEPT)
    assert clean(make_trips(*DROPPED)).count() == 0


def test_duration_and_speed_bounds(make_trips):
    kept = [
        lasting(1, trip_distance=1.0), lasting(300, trip_distance=10.0),
        lasting(60, trip_distance=0.5), lasting(60, trip_distance=80.0),
    ]
    dropped = [
        lasting(59 / 60, trip_distance=1.0), lasting(300 + 1 / 60, trip_distance=10.0),
        lasting(60, trip_distance=0.49), lasting(60, trip_distance=80.1),
    ]
    assert apply_rules(make_trips(*kept), METRIC_RULES).count() == len(kept)
    assert apply_rules(make_trips(*dropped), METRIC_RULES).count() == 0


def test_compact_rules_ignore_the_other_columns(make_trips):
    trips = make_trips({"VendorID": None, "total_amount": -5.0}, {"fare_amount": 1.0}, {"PULocationID": None})
    assert clean_compact(trips).count() == 1


def test_bounds_are_parameters(make_trips):
    wide = Params(zone_ids=(1, 1000))
    assert clean(make_trips({"PULocationID": 900}), wide).count() == 1


def test_audit_counts_each_rule_and_the_rows_left(make_trips):
    trips = make_trips({}, {"VendorID": None}, {"trip_distance": 0.0}, {"fare_amount": NAN, "trip_distance": 0.0})
    rows = {r.rule: r for r in audit(trips).collect()}
    assert list(rows) == list(BASIC_RULES + METRIC_RULES)
    assert (rows["required"].rows_failing, rows["required"].rows_kept) == (2, 2)
    assert (rows["distance"].rows_failing, rows["distance"].rows_kept) == (2, 1)
    assert rows["speed"].rows_kept == clean(trips).count() == 1
    assert rows["speed"].percent_kept == pytest.approx(25.0)


def test_audit_of_nothing_has_no_percentage(make_trips):
    rows = audit(make_trips().limit(0)).collect()
    assert {r.rows_kept for r in rows} == {0} and {r.percent_kept for r in rows} == {None}


def test_stored_ranges_reach_the_scan(make_trips, tmp_path, spark):
    make_trips({}).write.parquet(str(tmp_path / "t"))
    plan = clean(spark.read.parquet(str(tmp_path / "t")))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    for name in ("trip_distance", "fare_amount", "passenger_count", "PULocationID", "DOLocationID"):
        assert f"GreaterThanOrEqual({name}" in pushed and f"LessThanOrEqual({name}" in pushed
    assert "IsNotNull(VendorID)" in pushed and "GreaterThan(total_amount" in pushed
