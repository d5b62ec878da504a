"""The batch job: trips in, feature table, aggregates, models, recommendations and charts out."""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable, Iterable, Mapping
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from curbside.functions.calendar import speed_up
from curbside.operators.aggregates import (
    compact_etl,
    demand_cube,
    hourly_demand_from_cube,
    zone_aggregates_from_cube,
)
from curbside.operators.features import clean_and_engineer
from curbside.operators.lookup import check_dimension
from curbside.operators.models import k_sweep, run_kmeans, run_regression
from curbside.operators.reports import cluster_charts, demand_charts, model_charts, site_charts
from curbside.params import Params
from curbside.plans.session import build_session
from curbside.plans.sites import recommend_from_zones
from curbside.sources import (
    city_stations,
    city_zones,
    read_stations,
    read_trips,
    read_zones,
    write_json,
    write_table,
    write_trips,
)
from curbside.sources.readers import path_exists, read_csv_text
from curbside.sources.schema import unreadable_values


def retained(spark: SparkSession, raw: int, clean: int) -> DataFrame:
    """Rows before and after cleaning and the share kept, null for an empty input."""
    table = spark.createDataFrame([(raw, clean)], "raw_rows long, clean_rows long")
    share = F.try_divide(F.lit(100.0) * F.col("clean_rows"), F.col("raw_rows"))
    return table.withColumn("percent_kept", share)


def write_and_read(table: DataFrame, path: str) -> DataFrame:
    write_table(table, path)
    return table.sparkSession.read.parquet(path)


def run_job(
    trips: DataFrame,
    zones: DataFrame,
    stations: DataFrame,
    out_dir: str,
    params: Params = Params(),
    sweep: range | None = range(2, 10),
    by_date: bool = False,
) -> dict[str, DataFrame]:
    """Run everything once and return the result tables.

    The raw trips are read for the feature table, and the feature table once more for one cube of
    sums, pruned to eight columns. All later steps use the cube, whose size does not depend on the
    number of trips. Each table is written before it is reused, so a lost executor costs a task,
    not a rescan.
    """
    spark = trips.sparkSession

    # Both counts are taken while the features are written: the input is read once.
    raw, clean = Observation("raw trips"), Observation("clean trips")
    count = F.count(F.lit(1)).alias("rows")
    small = check_dimension(zones, "zone_id", params)
    features = clean_and_engineer(trips.observe(raw, count), zones, params, small)
    features = features.observe(clean, count)
    write_trips(features, f"{out_dir}/features", by_date)
    features = spark.read.parquet(f"{out_dir}/features")
    retention = retained(spark, raw.get["rows"], clean.get["rows"])

    cube = write_and_read(demand_cube(features), f"{out_dir}/demand_cube")
    zone_table = zone_aggregates_from_cube(cube, zones, params, small)
    zone_table = write_and_read(zone_table, f"{out_dir}/zone_aggregates")
    hourly = hourly_demand_from_cube(cube, zones, params, small)
    hourly = write_and_read(hourly, f"{out_dir}/hourly_demand")

    clustered, _, summary = run_kmeans(zone_table, params)
    clustered = write_and_read(clustered, f"{out_dir}/clustered_zones")
    summary = write_and_read(summary, f"{out_dir}/cluster_summary")
    sites = recommend_from_zones(clustered, zones, stations, params, small)
    recommendations = write_and_read(sites, f"{out_dir}/recommendations")
    metrics, importances = run_regression(hourly, params)
    metrics = write_and_read(metrics, f"{out_dir}/model_metrics")

    results = {
        "retention": retention,
        "cluster_summary": summary,
        "recommendations": recommendations,
        "model_metrics": metrics,
        "feature_importances": importances,
    }
    if sweep is not None:
        results["k_sweep"] = k_sweep(zone_table, sweep, params)
    for name, table in results.items():
        write_json(table, f"{out_dir}/results/{name}")

    charts = {
        **demand_charts(hourly, clustered, params),
        **cluster_charts(clustered, summary),
        **site_charts(clustered, stations, recommendations),
        **model_charts(metrics, importances),
    }
    if sweep is not None:
        charts["elbow_curve"] = results["k_sweep"]
    for name, table in charts.items():
        write_table(table, f"{out_dir}/charts/{name}")
    return {"features": features, "zones": zone_table, **results}


def scaling_report(
    inputs: Mapping[str, Callable[[], DataFrame]], params: Params = Params()
) -> list[tuple[str, int, int, float, float]]:
    """Run the compact job on each input: label, rows, zones, seconds, rows per second."""
    rows = []
    for label, load in inputs.items():
        # One pass: the rows are counted while they are read, the zones while they are written.
        read, zones = Observation("rows"), Observation("zones")
        count = F.count(F.lit(1)).alias("rows")
        result = compact_etl(load().observe(read, count), params).observe(zones, count)
        start = time.perf_counter()
        result.write.format("noop").mode("overwrite").save()  # computes every column
        seconds = round(time.perf_counter() - start, 2)
        number = read.get["rows"]
        speed = round(number / seconds, 1) if seconds else 0.0
        rows.append((label, number, zones.get["rows"], seconds, speed))
    return rows


def scaling_table(
    spark: SparkSession, inputs: Mapping[str, Callable[[], DataFrame]], params: Params = Params()
) -> DataFrame:
    """The report with the speed of each input over that of the first."""
    report = scaling_report(inputs, params)
    table = spark.createDataFrame(
        report, "input string, rows long, zones long, seconds double, rows_per_second double"
    )
    base = F.lit(report[0][3] / report[0][1] if report and report[0][1] else 0.0)
    per_row = F.try_divide(F.col("seconds"), F.col("rows"))
    return table.withColumn("speed_up", speed_up(base, per_row))


def scaling_inputs(spark: SparkSession, paths: Iterable[str]) -> dict[str, Callable[[], DataFrame]]:
    """Trips by path, for ``scaling_table``; a missing path is an error, on any file system."""
    paths = list(paths)
    if missing := [path for path in paths if not path_exists(spark, path)]:
        raise FileNotFoundError(f"no such input: {', '.join(missing)}")
    return {path: partial(read_trips, spark, path) for path in paths}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Trip demand and site selection")
    parser.add_argument("--trips", required=True, help="trips as Parquet or CSV")
    parser.add_argument("--out", required=True, help="output folder")
    parser.add_argument("--zones", help="zone dimension; built-in city zones if left out")
    parser.add_argument("--stations", help="station dimension; built-in stations if left out")
    parser.add_argument("--clusters", type=int, default=Params.clusters)
    parser.add_argument("--min-trips", type=int, default=Params.min_trips)
    parser.add_argument("--top-n", type=int, default=Params.top_n)
    parser.add_argument("--by-date", action="store_true", help="partition the features by date")
    parser.add_argument("--scaling", nargs="*", metavar="TRIPS", help="also time the compact job, on further inputs as well")
    args = parser.parse_args(argv)

    spark = build_session("curbside job")
    params = Params(clusters=args.clusters, min_trips=args.min_trips, top_n=args.top_n)
    zones = read_zones(spark, args.zones) if args.zones else city_zones(spark)
    stations = read_stations(spark, args.stations) if args.stations else city_stations(spark)
    trips = read_trips(spark, args.trips)
    results = run_job(trips, zones, stations, args.out, params, by_date=args.by_date)
    results["recommendations"].show(params.top_n, truncate=False)
    if args.scaling is not None:
        inputs = scaling_inputs(spark, [args.trips, *args.scaling])
        write_json(scaling_table(spark, inputs, params), f"{args.out}/results/scaling")
    if args.trips.endswith(".csv"):
        write_json(unreadable_values(read_csv_text(spark, args.trips)), f"{args.out}/results/unreadable")


if __name__ == "__main__":
    main()
