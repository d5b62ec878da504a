import pytest
from support import SF
from pyspark.sql import functions as F

from curbside.catalog import tables
from curbside.operators import aggregates, features
from curbside.operators.lookup import check_dimension, fits_broadcast, measured_bytes
from curbside.params import Params
from curbside.plans import settle
from curbside.plans.job import run_job, scaling_inputs, scaling_table
from curbside.plans.sites import recommend_from_trips
from curbside.sources import read_trips, write_trips


def test_settled_rows_are_kept_without_any_setting(spark):
    settled = settle(spark.range(10).where(F.col("id") > 3))
    assert settled.count() == 6 and settled.storageLevel.useMemory and settled.storageLevel.useDisk
    assert "InMemoryTableScan" in settled._jdf.queryExecution().executedPlan().toString()
    settled.unpersist()


def jobs_started(spark, action):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("counted", "counted")
    before = set(tracker.getJobIdsForGroup("counted"))
    result = action()
    after = set(tracker.getJobIdsForGroup("counted"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(after - before)


def test_no_job_runs_while_a_checked_plan_is_built(spark):
    trips, zones = tables.trips(spark, SF), tables.zones(spark, SF)
    small = check_dimension(zones, "zone_id")
    assert small and not check_dimension(zones, "zone_id", Params(broadcast_limit_bytes=10))
    _, jobs = jobs_started(spark, lambda: features.clean_and_engineer(trips, zones, small=small))
    assert jobs == 0


def test_a_repeated_key_of_a_lookup_is_an_error(spark):
    zones = tables.zones(spark, SF)
    with pytest.raises(ValueError, match="several rows"):
        features.add_zones(tables.trips(spark, SF), zones.unionByName(zones.limit(1)))


def test_the_job_reads_text_input_once(spark, tmp_path):
    path = str(tmp_path / "trips.csv")
    tables.trips(spark, SF).write.option("header", True).csv(path)
    trips, zones = read_trips(spark, path, "csv"), tables.zones(spark, SF)
    reads = spark.sparkContext.accumulator(0)
    marked = trips.withColumn("fare_amount", F.udf(lambda x: (reads.add(1), x)[1], "double")("fare_amount"))
    params = Params(clusters=2, gbt_trees=1, gbt_depth=1, min_trips=100)
    results = run_job(marked, zones, tables.stations(spark, SF), str(tmp_path / "out"), params, sweep=None)
    assert reads.value == 6000 and results["retention"].first().raw_rows == 6000


def test_measured_size_bounds_the_broadcast(spark):
    df = spark.range(100).select(F.col("id"), F.repeat(F.lit("x"), 50).alias("text"))
    assert measured_bytes(df) == 100 * (32 + 50)
    assert fits_broadcast(df, Params(broadcast_limit_bytes=8200))
    assert not fits_broadcast(df, Params(broadcast_limit_bytes=8199))
    assert not fits_broadcast(df, Params(broadcast_limit_bytes=8200), copies=2)


def test_zone_aggregates_read_only_what_they_need(spark, tmp_path):
    path = str(tmp_path / "trips.parquet")
    write_trips(tables.trips(spark, SF), path)
    zones = tables.zones(spark, SF)
    df = aggregates.zone_aggregates(features.trip_features(read_trips(spark, path)), zones)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "trips.parquet" in line]
    assert len(scans) == 1
    read = scans[0][scans[0].index("ReadSchema"):]
    for unused in ("tip_amount", "tolls_amount", "payment_type", "store_and_fwd_flag", "extra"):
        assert unused not in read
    assert plan.count("Exchange hashpartitioning(PULocationID") == 1


def test_job_writes_every_result(spark, tmp_path):
    params = Params(clusters=3, gbt_trees=2, gbt_depth=2, min_trips=100)
    trips, zones = tables.trips(spark, SF), tables.zones(spark, SF)
    stations = tables.stations(spark, SF)
    results = run_job(trips, zones, stations, str(tmp_path), params, sweep=range(2, 4), by_date=True)
    kept = results["retention"].first()
    assert (kept.raw_rows, kept.clean_rows) == (6000, 4045)
    assert results["features"].count() == 4045
    assert results["zones"].count() == 30
    direct = recommend_from_trips(trips, zones, stations, params).drop("cluster").collect()
    through = results["recommendations"].drop("cluster").collect()
    assert [r.PULocationID for r in through] == [r.PULocationID for r in direct]
    assert [r.annual_co2_saved_kg for r in through] == [r.annual_co2_saved_kg for r in direct]
    assert results["k_sweep"].count() == 2 and results["model_metrics"].count() == 2
    for name in results.keys() - {"features", "zones"}:
        assert spark.read.json(f"{tmp_path}/results/{name}").count() == results[name].count()
    charts = sorted(p.name for p in (tmp_path / "charts").iterdir())
    assert charts == sorted([
        "borough_comparison", "cluster_map", "cluster_profiles", "demand_by_hour", "distance_averages",
        "distance_curve", "distance_histogram", "elbow_curve", "feature_importance", "gap_map",
        "gap_map_labels", "model_comparison", "savings", "savings_total",
    ])
    hours = spark.read.parquet(f"{tmp_path}/charts/demand_by_hour")
    assert hours.agg(F.sum("trips")).first()[0] == 4045


def test_scaling_report(spark):
    trips = tables.trips(spark, SF)
    rows = scaling_table(spark, {"a": lambda: trips, "b": lambda: trips.union(trips)}).collect()
    assert [(r.input, r.rows, r.zones) for r in rows] == [("a", 6000, 30), ("b", 12000, 30)]
    assert rows[0].speed_up == 1.0 and rows[1].speed_up > 0


def test_scaling_inputs_are_looked_up_by_their_own_file_system(spark, tmp_path):
    write_trips(tables.trips(spark, SF), str(tmp_path / "trips"))
    inputs = scaling_inputs(spark, [f"file://{tmp_path}/trips"])
    assert scaling_table(spark, inputs).first().rows == 6000
    with pytest.raises(FileNotFoundError):
        scaling_inputs(spark, [f"{tmp_path}/trips", f"{tmp_path}/missing"])
