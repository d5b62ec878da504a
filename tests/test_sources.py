import json
from datetime import datetime
from pathlib import Path

import pytest
from support import SF
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbside.catalog import tables
from curbside.sources import writers
from curbside.operators.clean import clean, clean_compact
from curbside.sources import (
    STATION_SCHEMA,
    TRIP_SCHEMA,
    city_stations,
    city_zones,
    conform,
    read_stations,
    read_trips,
    read_zones,
    write_csv,
    write_json,
    write_table,
    write_trips,
)
from curbside.sources.readers import read_checked_csv_trips, read_csv_text
from curbside.sources.schema import unreadable_values


@pytest.fixture
def sample(make_trips):
    return make_trips(
        {}, {"passenger_count": None, "tpep_pickup_datetime": datetime(2023, 1, 4, 8, 0, 0, 250000)},
        {"store_and_fwd_flag": None, "PULocationID": 7},
    )


def test_declared_schema():
    assert len(TRIP_SCHEMA) == 18 and all(f.nullable for f in TRIP_SCHEMA)


def test_csv_round_trip_with_and_without_fractions(sample, tmp_path, spark):
    path = str(tmp_path / "trips.csv")
    write_csv(sample, path)
    back = read_trips(spark, path)
    assert back.schema == TRIP_SCHEMA
    assert sorted(back.collect(), key=str) == sorted(sample.collect(), key=str)


def test_csv_columns_in_another_order_with_extras_and_decimal_ids(tmp_path, spark):
    path = tmp_path / "odd.csv"
    path.write_text(
        "note,PULocationID,trip_distance,VendorID,tpep_pickup_datetime\n"
        "x,161.0,1.5,2,2023-01-04 08:00:00\n"
        "y,,abc,1,2023-01-04 08:00:00.5\n"
    )
    first, second = sorted(read_trips(spark, str(path)).collect(), key=lambda r: r.note)
    assert (first.PULocationID, first.trip_distance, first.VendorID) == (161, 1.5, 2)
    assert (second.PULocationID, second.trip_distance) == (None, None)
    assert second.tpep_pickup_datetime == datetime(2023, 1, 4, 8, 0, 0, 500000)


def test_parquet_copy_beside_a_csv_wins(sample, tmp_path, spark):
    write_csv(sample, str(tmp_path / "t.csv"))
    assert read_trips(spark, str(tmp_path / "t.csv")).count() == 3
    write_trips(sample.limit(1), str(tmp_path / "t.parquet"))
    assert read_trips(spark, str(tmp_path / "t.csv")).count() == 1
    assert read_trips(spark, str(tmp_path / "t.csv"), fmt="csv").count() == 3
    assert read_trips(spark, str(tmp_path / "t.parquet")).count() == 1
    with pytest.raises(ValueError):
        read_trips(spark, str(tmp_path / "t.csv"), fmt="xml")


def test_conform_casts_what_is_present_and_keeps_the_rest(spark):
    df = spark.sql("SELECT '1.0' AS VendorID, 3 AS trip_distance, 'bad' AS fare_amount, 5L AS other")
    out = conform(df)
    assert out.columns == df.columns
    assert tuple(out.first()) == (1, 3.0, None, 5)
    assert isinstance(out.schema["VendorID"].dataType, T.IntegerType)


def test_conform_keeps_wall_clock_timestamps(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2023-01-04 08:00:00' AS tpep_pickup_datetime")
    assert isinstance(conform(df).schema[0].dataType, T.TimestampNTZType)


def test_features_by_date(make_trips, tmp_path, spark):
    trips = make_trips({}, {"tpep_pickup_datetime": datetime(2023, 1, 3, 23, 0, 0)})
    path = str(tmp_path / "features")
    write_trips(trips, path, by_date=True)
    back = spark.read.parquet(path)
    assert {p.name for p in Path(path).glob("pickup_date=*")} == {"pickup_date=2023-01-03", "pickup_date=2023-01-04"}
    assert back.where(F.col("pickup_date") == "2023-01-03").count() == 1


def test_dimensions_round_trip(spark, tmp_path):
    zones, stations = city_zones(spark), city_stations(spark)
    write_table(zones, str(tmp_path / "zones"))
    write_csv(stations, str(tmp_path / "stations.csv"))
    write_json(stations, str(tmp_path / "stations.json"))
    assert sorted(read_zones(spark, str(tmp_path / "zones")).collect()) == sorted(zones.collect())
    for name in ("stations.csv", "stations.json"):
        back = read_stations(spark, str(tmp_path / name))
        assert back.select(STATION_SCHEMA.names).exceptAll(stations).count() == 0 and back.count() == 20


def test_json_keeps_null_fields_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "out")
    for _ in range(2):
        write_json(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b"), path)
    lines = [json.loads(x) for f in Path(path).glob("part-*") for x in f.read_text().splitlines()]
    assert lines == [{"a": 1, "b": None}]


def test_wide_ids_reach_the_scan_and_come_out_narrow(spark, tmp_path):
    path = str(tmp_path / "wide.parquet")
    wide = {name: F.col(name).cast("long") for name in ("PULocationID", "DOLocationID")}
    tables.trips(spark, SF).withColumns(wide).write.parquet(path)
    kept = clean(read_trips(spark, path))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    for name in wide:
        assert f"GreaterThanOrEqual({name},1)" in pushed and f"LessThanOrEqual({name},265)" in pushed
    assert dict(kept.dtypes)["PULocationID"] == "int"
    assert kept.count() == clean(tables.trips(spark, SF)).count()
    odd = read_trips(spark, path).withColumn("PULocationID", F.lit(1 << 40))
    assert clean_compact(odd).count() == 0


def test_unreadable_values_are_counted(spark, tmp_path):
    path = str(tmp_path / "odd.csv")
    (tmp_path / "odd.csv").write_text("trip_distance,VendorID,note\n5 mi,1.0,x\n,x,y\n2.5,2,z\n")
    counts = {r.column: r.rows_unreadable for r in unreadable_values(read_csv_text(spark, path)).collect()}
    assert counts == {"trip_distance": 1, "VendorID": 1}


def test_rows_that_are_no_trips_go_to_quarantine(spark, tmp_path):
    lines = ["trip_distance,VendorID,note", "5 mi,1.0,x", ",x,y", "2.5,2,z", "bad,x,", "1.5,1", "1.5,1,a,b", ",,"]
    (tmp_path / "odd.csv").write_text("\n".join(lines) + "\n")
    good, rejected = read_checked_csv_trips(spark, str(tmp_path / "odd.csv"))
    assert sorted(map(tuple, good.collect()), key=str) == [(2.5, 2, "z"), (None, None, None)]
    found = {(r.reason, r.trip_distance if r["_line"] is None else r["_line"]) for r in rejected.collect()}
    assert found == {
        ("unreadable trip_distance", "5 mi"), ("unreadable VendorID", None), ("unreadable trip_distance, VendorID", "bad"),
        ("number of fields", "1.5,1"), ("number of fields", "1.5,1,a,b"),
    }
    assert good.count() == 2 and rejected.count() == 5
    (tmp_path / "empty.csv").write_text("trip_distance,VendorID\n")
    assert [df.count() for df in read_checked_csv_trips(spark, str(tmp_path / "empty.csv"))] == [0, 0]


def test_days_are_replaced_alone_and_any_number_of_times(spark, make_trips, tmp_path):
    day = lambda n, fare: {"tpep_pickup_datetime": datetime(2023, 1, n, 8), "tpep_dropoff_datetime": datetime(2023, 1, n, 9), "fare_amount": fare}
    path = str(tmp_path / "days")
    writers.write_trips(make_trips(day(1, 10.0), day(2, 20.0), day(2, 21.0), day(3, 30.0)), path, by_date=True)
    kept = lambda: {f: f.stat().st_mtime_ns for n in (1, 3) for f in (tmp_path / "days" / f"pickup_date=2023-01-0{n}").glob("*.parquet")}
    before = kept()
    for _ in range(2):
        writers.replace_days(make_trips(day(2, 99.0), day(4, 40.0)), path)
        rows = spark.read.parquet(path).select("pickup_date", "fare_amount").collect()
        assert sorted((r.pickup_date.day, r.fare_amount) for r in rows) == [(1, 10.0), (2, 99.0), (3, 30.0), (4, 40.0)]
    writers.replace_days(make_trips(day(2, 1.0)).limit(0), path)
    assert spark.read.parquet(path).count() == 4 and kept() == before and len(before) == 2


def test_judging_a_row_is_compiled_code(spark, tmp_path):
    path = str(tmp_path / "odd.csv")
    (tmp_path / "odd.csv").write_text("trip_distance,VendorID\n5 mi,1.0\n2.5,2\n")
    for table in read_checked_csv_trips(spark, path):
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert "lambda" not in plan and "filter(array" not in plan  # functions over arrays are interpreted, with all below them
    good, _ = read_checked_csv_trips(spark, path)
    assert "unreadable" not in good._jdf.queryExecution().executedPlan().toString()
