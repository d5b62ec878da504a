"""One runnable query per operator, over the whole given tables.

Each takes (spark, folder of the tables). Derived doubles are rounded, because sums may differ in
the last bits between engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbside.catalog import tables
from curbside.catalog.scratch import scratch
from curbside.functions import calendar, geo, scores
from curbside.operators import aggregates, clean, features, models, recommend, reports, spatial
from curbside.operators.lookup import attach
from curbside.params import Params
from curbside.plans.job import scaling_table
from curbside.plans.settle import settle
from curbside.plans.sites import recommend_from_trips, recommend_from_zones
from curbside.sources.readers import read_checked_csv_trips, read_csv_trips, read_parquet_trips, read_trips
from curbside.sources.schema import conform
from curbside.sources.writers import replace_dates, replace_days, write_csv, write_json, write_table, write_trips

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The default threshold keeps every zone at scale 0.01; this one lies inside the range there.
SELECTIVE = Params(min_trips=1400)
RECORD = ("VendorID", "PULocationID", "DOLocationID", "trip_distance", "fare_amount", "passenger_count", "total_amount")
EPOCH = {"pickup_s": "tpep_pickup_datetime", "dropoff_s": "tpep_dropoff_datetime"}
DESCRIBED = ("trip_distance", "fare_amount", "passenger_count", "total_amount")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


ZONE_MEANS = ("avg_distance", "avg_fare", "avg_passengers", "avg_duration_min", "avg_speed_mph")


def rounded(df: DataFrame, digits: int = 6, count: str = "total_trips") -> DataFrame:
    """Round every double column; others are untouched.

    An average of trips, beside its ``count``, is rounded by its total. Over few rows an average
    often lies half-way between two rounded values, where the last bit would decide; its total
    never does.
    """

    def steady(field: T.StructField):
        column = F.col(field.name)
        if not isinstance(field.dataType, T.DoubleType):
            return column
        if field.name in ZONE_MEANS and count in df.columns:
            return (F.round(column * F.col(count), digits) / F.col(count)).alias(field.name)
        return F.round(column, digits).alias(field.name)

    return df.select(*[steady(field) for field in df.schema])


# --- derived tables shared by the queries ---------------------------------------------------------


def _trip_features(spark: SparkSession, d: str) -> DataFrame:
    return features.trip_features(tables.trips(spark, d))


def _zone_table(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.zone_aggregates(_trip_features(spark, d), tables.zones(spark, d))


def _hourly(spark: SparkSession, d: str) -> DataFrame:
    return aggregates.hourly_demand(_trip_features(spark, d), tables.zones(spark, d))


def _settled_zones(spark: SparkSession, d: str) -> DataFrame:
    return settle(_zone_table(spark, d))


def _settled_hourly(spark: SparkSession, d: str) -> DataFrame:
    return settle(_hourly(spark, d))


def _measured(spark: SparkSession, d: str) -> DataFrame:
    return settle(recommend.measure_service(_settled_zones(spark, d), tables.stations(spark, d)))


def _recommendations(spark: SparkSession, d: str, params: Params = SELECTIVE) -> DataFrame:
    return recommend_from_trips(
        tables.trips(spark, d), tables.zones(spark, d), tables.stations(spark, d), params
    )


def _zone_points(spark: SparkSession, d: str) -> DataFrame:
    return tables.zones(spark, d).select(
        F.col("zone_id").alias("PULocationID"),
        F.col("zone_lat").alias("lat"),
        F.col("zone_lon").alias("lon"),
    )


def _fixed_clusters(zones: DataFrame) -> DataFrame:
    """A cluster label that any engine can reproduce."""
    return zones.withColumn("cluster", (F.col("PULocationID") % 5).cast("int"))


def _records(trips: DataFrame) -> DataFrame:
    return trips.select(*RECORD, *[F.unix_timestamp(c).alias(n) for n, c in EPOCH.items()])


def _columns_of(df: DataFrame, vector: str, names: tuple[str, ...]) -> list:
    values = vector_to_array(F.col(vector))
    return [values[i].alias(f"{name}_v") for i, name in enumerate(names)]


# --- scans, casts, counts, samples ----------------------------------------------------------------


@query
def s1_trip_scan(spark, d):
    return tables.trips(spark, d)


@query
def s5_cast_pass(spark, d):
    """Records as text, as a CSV without inference holds them, brought back by the cast pass."""
    trips = tables.trips(spark, d)
    names = (*RECORD, "payment_type", "RatecodeID", *EPOCH.values())
    text = conform(trips.select(*[F.col(name).cast("string") for name in names]))
    seconds = {name: F.unix_timestamp(column) for name, column in EPOCH.items()}
    return text.withColumns(seconds).drop(*EPOCH.values())


@query
def s7_zone_dimension(spark, d):
    return tables.zones(spark, d)


@query
def s8_station_dimension(spark, d):
    return tables.stations(spark, d)


@query
def s9_dated_trips(spark, d):
    """Trips written by month; then every January once more, twice. Counted as they are read back.

    The rows of January are taken from the months that were written, into files of their own: the trips are derived once.
    """
    path = scratch(spark, "trips")
    write_trips(_trip_features(spark, d), path, by_date=True, unit="month")
    january = read_parquet_trips(spark, path).where(F.month("pickup_date") == 1)
    write_trips(january.drop("pickup_date"), f"{path}-january")
    for _ in range(2):
        replace_days(read_parquet_trips(spark, f"{path}-january"), path, unit="month")
    read = read_parquet_trips(spark, path)
    return rounded(read.groupBy("pickup_date").agg(F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("fares"), F.sum("speed_mph").alias("speeds")))


@query
def s10_zone_table_round_trip(spark, d):
    path = scratch(spark, "zones")
    write_table(_zone_table(spark, d), path)
    return rounded(spark.read.parquet(path))


@query
def s15_csv_round_trip(spark, d):
    """Trips written as CSV and read back under the declared schema."""
    path = scratch(spark, "trips-csv")
    write_csv(tables.trips(spark, d), path)
    return _records(read_csv_trips(spark, path))


@query
def s3_checked_csv(spark, d):
    """Trips as CSV with values that do not fit: good rows and the quarantine, each written to a sink of its own and read back."""
    trips = tables.trips(spark, d)
    spoilt = {
        "trip_distance": F.when(F.col("payment_type") == 3, "n/a").otherwise(F.col("trip_distance").cast("string")),
        "PULocationID": F.when(F.col("total_amount") < 0, "zone").otherwise(F.col("PULocationID").cast("string")),
    }
    path = scratch(spark, "checked-csv")
    write_csv(trips.select(*[spoilt.get(name, F.col(name)).cast("string").alias(name) for name in trips.columns]), path)
    good, rejected = read_checked_csv_trips(spark, path)
    write_table(good, f"{path}-good")
    write_json(rejected, f"{path}-rejected")
    fares = F.sum(F.col("fare_amount").cast("double")).alias("fares")
    kinds = "reason string, fare_amount string"
    accepted = spark.read.parquet(f"{path}-good").select(F.lit("accepted").alias("reason"), F.col("fare_amount").cast("string"))
    both = accepted.unionByName(spark.read.schema(kinds).json(f"{path}-rejected"))
    return rounded(both.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"), fares), 3)


@query
def s4_source_choice(spark, d):
    """Trips as two CSVs, one of them with a Parquet copy beside it that has all trips: the copy is preferred.

    The copy is written first and the CSVs are taken from it: the trips are derived once.
    """
    path = scratch(spark, "choice")
    write_trips(tables.trips(spark, d), f"{path}/with_copy.parquet")
    few = read_parquet_trips(spark, f"{path}/with_copy.parquet").where(F.col("payment_type") == 1)
    for name in ("with_copy", "alone"):
        write_csv(few, f"{path}/{name}.csv")
    found = [_records(read_trips(spark, f"{path}/{name}.csv")).withColumn("source", F.lit(name)) for name in ("with_copy", "alone")]
    sums = [F.sum("fare_amount").alias("fares"), F.sum("pickup_s").alias("seconds")]
    return rounded(found[0].unionByName(found[1]).groupBy("source").agg(F.count(F.lit(1)).alias("trips"), *sums))


@query
def s17_row_counts(spark, d):
    """Raw and clean rows, zones and hourly rows; the distinct counts come from grouped partials."""
    trips = tables.trips(spark, d)
    cube = settle(aggregates.demand_cube(features.trip_features(trips)))
    sums = cube.agg(
        F.sum("trip_count").alias("clean_rows"),
        F.count_distinct("PULocationID").alias("zones"),
        F.count(F.lit(1)).alias("hourly_rows"),
    )
    raw = trips.agg(F.count(F.lit(1))).scalar()
    return sums.select(raw.alias("raw_rows"), "clean_rows", "zones", "hourly_rows")


@query
def s19_random_sample(spark, d):
    return _records(tables.trips(spark, d)).sample(0.1, seed=42)


@query
def s19_hash_sample(spark, d):
    """A tenth of the rows by a hash of their key columns: the same rows in any engine."""
    rows = _records(tables.trips(spark, d))
    return rows.where(
        models.hash_bucket("VendorID", "PULocationID", "DOLocationID", "pickup_s", "dropoff_s") < 10
    )


# Result tables as JSON lines, read back: (query of the sink, query of the table).
JSON_SINKS = {
    "s11_cluster_summary_json": "a3_kmeans_summary",
    "s12_recommendations_json": "c3_site_recommendations_selective",
    "s13_model_metrics_json": "a15_regression_metrics",
    "s14_scaling_json": "c6_scaling_sizes",
}


def _json_round_trip(table: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        result, path = QUERIES[table](spark, d), scratch(spark, table)
        write_json(result, path)
        return spark.read.schema(result.schema).json(path)

    return run


for _name, _table in JSON_SINKS.items():
    QUERIES[_name] = _json_round_trip(_table)


# --- filters --------------------------------------------------------------------------------------


def _rule_query(names: tuple[str, ...], trips: Query = tables.trips) -> Query:
    return lambda spark, d: _records(clean.apply_rules(trips(spark, d), names))


for _name, _rules in {
    "p1_required": ("required",),
    "p2_distance": ("distance",),
    "p3_fare": ("fare",),
    "p4_passengers": ("passengers",),
    "p5_time_order": ("time_order",),
    "p6_pickup_zone": ("pickup_zone",),
    "p7_dropoff_zone": ("dropoff_zone",),
    "p8_total": ("total",),
    "p9_duration": ("duration",),
    "p10_speed": ("speed",),
    "p11_compact_rules": clean.COMPACT_RULES,
}.items():
    QUERIES[_name] = _rule_query(_rules)
for _name, _rules in {
    "p2_distance_wide": ("distance",),
    "p4_passengers_wide": ("passengers",),
    "p6_pickup_zone_wide": ("pickup_zone",),
    "p9_duration_wide": ("duration",),
}.items():
    QUERIES[_name] = _rule_query(_rules, tables.wide_trips)


@query
def p21_rule_audit_wide(spark, d):
    """The audit over trips that lie on both sides of every bound."""
    return rounded(clean.audit(tables.wide_trips(spark, d)))


@query
def p12_cluster_input(spark, d):
    zones = models.cluster_input(_zone_table(spark, d))
    return rounded(zones.select("PULocationID", *models.CLUSTER_FEATURES))


@query
def p13_demand_input(spark, d):
    hourly = models.demand_input(_hourly(spark, d))
    return rounded(hourly.select(*models.DEMAND_FEATURES, models.LABEL), count=models.LABEL)


@query
def p14_located_zones(spark, d):
    zones = recommend.located_zones(_zone_table(spark, d))
    return rounded(zones.select("PULocationID", "lat", "lon", "total_trips"))


@query
def p14_fully_known_zones(spark, d):
    return rounded(recommend.fully_known_zones(_fixed_clusters(_zone_table(spark, d))))


@query
def p15_hotspots(spark, d):
    zones = recommend.hotspots(_zone_table(spark, d), SELECTIVE)
    return zones.select("PULocationID", "total_trips")


@query
def p16_underserved(spark, d):
    measured = recommend.underserved(_measured(spark, d))
    return measured.select("PULocationID", "chargers_within_1km")


@query
def p17_pickup_columns(spark, d):
    return features.pickup_dimension(tables.zones(spark, d))


@query
def p18_drop_rename(spark, d):
    hours = aggregates.hourly_demand(_trip_features(spark, d), tables.zones(spark, d))
    return hours.drop("avg_distance", "avg_fare", "borough").withColumnRenamed("trip_count", "trips")


@query
def p19_derived_columns(spark, d):
    names = ("pickup_hour", "pickup_dow", "pickup_month", "is_weekend", "is_rush_hour", "time_of_day")
    metrics = ("trip_duration_min", "speed_mph", "fare_per_mile")
    trips = _trip_features(spark, d)
    return trips.select("PULocationID", "DOLocationID", *names, *metrics)


@query
def p20_attach_silhouette(spark, d):
    zones = _settled_zones(spark, d)
    return rounded(models.run_kmeans(zones)[2])


@query
def p21_rule_audit(spark, d):
    return rounded(clean.audit(tables.trips(spark, d)))


# --- joins ----------------------------------------------------------------------------------------


@query
def j1_pickup_zone(spark, d):
    dim = features.pickup_dimension(tables.zones(spark, d))
    joined = attach(tables.trips(spark, d), dim, "PULocationID")
    return joined.select("PULocationID", "trip_distance", "pu_borough", "pu_lat", "pu_lon")


@query
def j2_dropoff_zone(spark, d):
    dim = features.dropoff_dimension(tables.zones(spark, d))
    joined = attach(tables.trips(spark, d), dim, "DOLocationID")
    return joined.select("DOLocationID", "trip_distance", "do_borough")


@query
def j3_nearest_station(spark, d):
    points, stations = _zone_points(spark, d), tables.stations(spark, d)
    return rounded(spatial.nearest_station(points, stations, with_name=True))


@query
def j4_stations_within(spark, d):
    points, stations = _zone_points(spark, d), tables.stations(spark, d)
    return spatial.stations_within(points, stations, 1.0)


@query
def j5_zone_names(spark, d):
    counts = _trip_features(spark, d).groupBy("PULocationID").agg(F.count("*").alias("total_trips"))
    return recommend.add_zone_name(counts, tables.zones(spark, d))


@query
def j6_gap_map(spark, d):
    zone_table, stations = _settled_zones(spark, d), tables.stations(spark, d)
    sites = recommend_from_zones(zone_table, tables.zones(spark, d), stations, SELECTIVE)
    return rounded(reports.gap_map(zone_table, stations, sites))


# --- aggregates -----------------------------------------------------------------------------------


@query
def a1_zone_aggregates(spark, d):
    return rounded(_zone_table(spark, d))


@query
def a1_zone_aggregates_from_cube(spark, d):
    cube = aggregates.demand_cube(_trip_features(spark, d))
    return rounded(aggregates.zone_aggregates_from_cube(cube, tables.zones(spark, d)))


def _stored_cube(spark: SparkSession, d: str) -> DataFrame:
    """The cube from state stored by month: the first half of the years, then June to December, and these once more."""
    trips, path = _trip_features(spark, d), scratch(spark, "cube")
    month = F.month("tpep_pickup_datetime")
    for load in (month <= 6, month >= 6, month >= 6):
        replace_dates(aggregates.dated_cube(trips.where(load)), path)
    return aggregates.merge_cubes(spark.read.parquet(path))


@query
def a1_zone_aggregates_from_stored_cube(spark, d):
    return rounded(aggregates.zone_aggregates_from_cube(_stored_cube(spark, d), tables.zones(spark, d)))


@query
def a2_hourly_demand(spark, d):
    return rounded(_hourly(spark, d), count=models.LABEL)


@query
def a2_hourly_demand_from_stored_cube(spark, d):
    hourly = aggregates.hourly_demand_from_cube(_stored_cube(spark, d), tables.zones(spark, d))
    return rounded(hourly, count=models.LABEL)


@query
def a3_cluster_summary(spark, d):
    return rounded(aggregates.cluster_summary(_fixed_clusters(_zone_table(spark, d))))


@query
def a3_kmeans_summary(spark, d):
    zones = _settled_zones(spark, d)
    clustered = models.assign_clusters(zones, models.fit_clusters(zones))
    return rounded(aggregates.cluster_summary(clustered))


@query
def a4_trips_per_hour(spark, d):
    return reports.trips_per_hour(_trip_features(spark, d))


@query
def a5_trips_per_borough(spark, d):
    return reports.trips_per_borough(_zone_table(spark, d))


@query
def a5_trips_per_borough_all(spark, d):
    return reports.trips_per_borough(_zone_table(spark, d), keep_unknown=True)


@query
def a6_maxima(spark, d):
    return rounded(reports.maxima(_measured(spark, d), "total_trips", "nearest_station_km"))


@query
def a7_total_savings(spark, d):
    return recommend.total_saved_tonnes(_recommendations(spark, d))


@query
def a8_mean_and_median(spark, d):
    return rounded(reports.mean_and_median(recommend.located_zones(_zone_table(spark, d))))


@query
def a8_trip_fares(spark, d):
    """Mean and exact median over all trips."""
    return rounded(reports.mean_and_median(tables.trips(spark, d), "fare_amount"))


@query
def a9_distance_histogram(spark, d):
    return rounded(reports.histogram(recommend.located_zones(_settled_zones(spark, d)), "avg_distance", 30))


@query
def a10_trip_histogram(spark, d):
    trips = tables.trips(spark, d)
    bars = reports.histogram(trips, "trip_distance", 50, clip=(0.0, 20.0))
    return rounded(bars.select("bin", "low", "high", "count"))


@query
def a11_density_curve(spark, d):
    return rounded(reports.density_curve(recommend.located_zones(_settled_zones(spark, d)), "avg_distance"))


@query
def a11_trip_fare_curve(spark, d):
    """The density of the fares of all trips, up to 1000."""
    return rounded(reports.density_curve(tables.trips(spark, d), "fare_amount", cap=1000.0))


@query
def a12_describe(spark, d):
    return rounded(reports.describe(tables.trips(spark, d), DESCRIBED))


@query
def a13_scaled_profiles(spark, d):
    summary = settle(aggregates.cluster_summary(_fixed_clusters(_zone_table(spark, d))))
    return rounded(reports.scaled_profiles(summary))


@query
def a14_compact_aggregate(spark, d):
    return rounded(aggregates.compact_etl(tables.trips(spark, d)))


@query
def a15_regression_metrics(spark, d):
    """Metrics of the simplest predictor: the mean of the training rows of the same hour."""
    train, test = models.hash_split(models.demand_input(_settled_hourly(spark, d)))
    means = train.groupBy("pickup_hour").agg(F.avg("trip_count").alias("prediction"))
    predicted = attach(test, means, "pickup_hour").where(F.col("prediction").isNotNull())
    return rounded(models.regression_metrics(predicted, "Hourly mean"))


@query
def a16_silhouette(spark, d):
    """The MLlib evaluator over standardised vectors and the fixed labels."""
    vectors = models.standard_vectors(_fixed_clusters(_settled_zones(spark, d)))
    zones = vectors.agg(F.count(F.lit(1)).alias("zones"))
    return rounded(models.with_silhouette(zones, models.silhouette(vectors)))


@query
def a16_kmeans_silhouette(spark, d):
    zones = _settled_zones(spark, d)
    clustered = models.assign_clusters(zones, models.fit_clusters(zones))
    count = clustered.agg(F.count(F.lit(1)).alias("zones"))
    return rounded(models.with_silhouette(count, models.silhouette(clustered)))


@query
def a17_distinct_counts(spark, d):
    cube = aggregates.demand_cube(_trip_features(spark, d))
    return cube.agg(
        F.count_distinct("PULocationID").alias("zones"), F.count(F.lit(1)).alias("hourly_rows")
    )


@query
def a18_point_sizes(spark, d):
    return rounded(reports.point_sizes(_settled_zones(spark, d)))


@query
def a18_cluster_map(spark, d):
    zones = _settled_zones(spark, d)
    clustered = models.assign_clusters(zones, models.fit_clusters(zones))
    return rounded(reports.point_sizes(clustered))


@query
def a19_cluster_labels(spark, d):
    zones = _settled_zones(spark, d)
    return reports.cluster_labels(models.assign_clusters(zones, models.fit_clusters(zones)))


# --- ranking, ordering ----------------------------------------------------------------------------


@query
def w1_rank(spark, d):
    return rounded(_recommendations(spark, d).select("PULocationID", "priority_score", "rank"))


@query
def o1_top_priority(spark, d):
    scored = recommend.score_zones(_measured(spark, d))
    return rounded(recommend.top_sites(scored).select("PULocationID", "priority_score"))


@query
def o2_busiest_zones(spark, d):
    return rounded(reports.busiest_zones(_zone_table(spark, d)))


@query
def o3_ordered_hours(spark, d):
    return reports.trips_per_hour(_trip_features(spark, d)).select("pickup_hour", "trips")


@query
def o4_ordered_boroughs(spark, d):
    located = recommend.located_zones(_zone_table(spark, d))
    return reports.trips_per_borough(located)


@query
def o5_savings_ascending(spark, d):
    return reports.savings_ascending(_recommendations(spark, d))


@query
def o6_importances_ascending(spark, d):
    hourly = _settled_hourly(spark, d)
    train, _ = models.hash_split(models.demand_input(hourly))
    importances = models.feature_importances(models.fit_trees(train), hourly)
    return rounded(reports.importances_ascending(importances))


@query
def o7_top_labels(spark, d):
    return rounded(reports.top_labels(_recommendations(spark, d)))


# --- scalar functions, over every trip or zone ----------------------------------------------------


def _pickup_query(name: str, **columns) -> None:
    def run(spark, d):
        trips = tables.trips(spark, d)
        derived = [make().alias(alias) for alias, make in columns.items()]
        return trips.select("PULocationID", "trip_distance", *derived)

    QUERIES[name] = run


def _pickup():
    return F.col("tpep_pickup_datetime")


_pickup_query("f1_pickup_hour", pickup_hour=lambda: F.hour(_pickup()))
_pickup_query("f2_pickup_weekday", pickup_dow=lambda: F.dayofweek(_pickup()))
_pickup_query("f3_pickup_month", pickup_month=lambda: F.month(_pickup()))
_pickup_query("f4_weekend_flag", is_weekend=lambda: calendar.weekend_flag(F.dayofweek(_pickup())))
_pickup_query("f5_rush_flag", is_rush_hour=lambda: calendar.rush_flag(F.hour(_pickup())))
_pickup_query("f6_time_of_day", time_of_day=lambda: calendar.day_part(F.hour(_pickup())))
_pickup_query("f7_duration", trip_duration_min=clean.duration_min)
_pickup_query("f8_speed", speed_mph=clean.speed_mph)
_pickup_query(
    "f9_fare_per_mile",
    fare_per_mile=lambda: calendar.ratio_if_positive(F.col("fare_amount"), F.col("trip_distance")),
)
QUERIES["f9_fare_per_mile_wide"] = lambda spark, d: tables.wide_trips(spark, d).select(
    "PULocationID",
    "trip_distance",
    calendar.ratio_if_positive(F.col("fare_amount"), F.col("trip_distance")).alias("fare_per_mile"),
)
_pickup_query("f20_clip", clipped=lambda: calendar.clip(F.col("trip_distance"), 1.0, 5.0))


@query
def f10_rush_share(spark, d):
    zones = _zone_table(spark, d)
    return rounded(zones.select("PULocationID", "rush_hour_trips", "rush_hour_fraction"))


@query
def f11_haversine(spark, d):
    """Distance between the zone centres of every pair of pickup and dropoff zone that occurs."""
    zones = tables.zones(spark, d)
    pairs = tables.trips(spark, d).groupBy("PULocationID", "DOLocationID").agg(F.count("*").alias("trips"))
    end = zones.select(
        F.col("zone_id").alias("DOLocationID"),
        F.col("zone_lat").alias("do_lat"),
        F.col("zone_lon").alias("do_lon"),
    )
    placed = attach(attach(pairs, features.pickup_dimension(zones), "PULocationID"), end, "DOLocationID")
    km = geo.haversine_km(F.col("pu_lat"), F.col("pu_lon"), F.col("do_lat"), F.col("do_lon"))
    return rounded(placed.select("PULocationID", "DOLocationID", "trips", km.alias("km")))


def _measured_wide(spark: SparkSession, d: str) -> DataFrame:
    zones = aggregates.zone_aggregates(_trip_features(spark, d), tables.wide_zones(spark, d))
    return settle(recommend.measure_service(settle(zones), tables.stations(spark, d)))


def _score_query(name: str, *columns: str, measured: Query = _measured) -> None:
    QUERIES[name] = lambda spark, d: rounded(
        recommend.score_zones(measured(spark, d)).select("PULocationID", *columns)
    )


_score_query("f13_demand_score", "demand_score")
_score_query("f14_capped_distance", "nearest_station_km", "nearest_station_km_clipped")
_score_query("f14_capped_distance_wide", "nearest_station_km", "nearest_station_km_clipped", measured=_measured_wide)
_score_query("f15_gap_score", "gap_score")
_score_query("f15_gap_score_wide", "gap_score", measured=_measured_wide)
_score_query("f16_priority_score", "priority_score")


@query
def f12_missing_positions(spark, d):
    """Service around zones of which some lack a coordinate: infinitely far, no station in the radius."""
    gone = F.col("PULocationID") % 5
    points = _zone_points(spark, d).withColumns(
        {
            "lat": F.when(gone != 0, F.col("lat")),
            "lon": F.when(gone == 1, F.lit(float("nan"))).otherwise(F.col("lon")),
        }
    )
    nearest = spatial.nearest_station(points, tables.stations(spark, d))
    within = spatial.stations_within(points, tables.stations(spark, d), Params().coverage_radius_km)
    far = F.col("nearest_station_km") == float("inf")
    km = F.when(~far, F.col("nearest_station_km")).alias("nearest_station_km")
    return rounded(nearest.join(within, "PULocationID").select("PULocationID", far.alias("unreachable"), km, "stations_within"))


@query
def f17_saved_grams(spark, d):
    zones = _zone_table(spark, d)
    grams = scores.saved_grams_per_trip(F.col("avg_distance"))
    return rounded(zones.select("PULocationID", grams.alias("saved_grams_per_trip")))


@query
def f18_annual_trips(spark, d):
    zones = _zone_table(spark, d)
    return zones.select("PULocationID", scores.annual_trips(F.col("total_trips")).alias("annual_trips_est"))


@query
def f19_annual_savings(spark, d):
    zones = recommend.add_savings(_zone_table(spark, d))
    return zones.select("PULocationID", "annual_co2_saved_kg", "annual_co2_saved_tonnes")


@query
def f22_zone_fallback(spark, d):
    ids = tables.trips(spark, d).groupBy("PULocationID").agg(F.count("*").alias("trips"))
    return recommend.add_zone_name(ids, tables.zones(spark, d)).select("PULocationID", "zone_name")


# --- models ---------------------------------------------------------------------------------------


@query
def m1_cluster_vectors(spark, d):
    ready = rounded(models.cluster_input(_zone_table(spark, d)))
    vectors = models.assemble(ready, models.CLUSTER_FEATURES, "raw_features")
    return vectors.select("PULocationID", *_columns_of(vectors, "raw_features", models.CLUSTER_FEATURES))


@query
def m2_standardise(spark, d):
    scaled = models.standardise(_settled_zones(spark, d))
    return rounded(scaled.select("PULocationID", *[f"{n}_scaled" for n in models.CLUSTER_FEATURES]))


@query
def m2_standard_scaler(spark, d):
    vectors = models.standard_vectors(_settled_zones(spark, d))
    names = models.CLUSTER_FEATURES
    return rounded(vectors.select("PULocationID", *_columns_of(vectors, "features", names)))


@query
def m3_kmeans(spark, d):
    zones = _settled_zones(spark, d)
    clustered = models.assign_clusters(zones, models.fit_clusters(zones))
    return clustered.select("PULocationID", "cluster")


@query
def m4_k_sweep(spark, d):
    return rounded(models.k_sweep(_settled_zones(spark, d), range(2, 10)))


@query
def m3_kmeans_facts(spark, d):
    """What holds for any fit: every zone in one cluster, none nearer to another centre."""
    zones = _settled_zones(spark, d)
    model = models.fit_clusters(zones)
    clustered = models.assign_clusters(zones, model)
    x = vector_to_array(F.col("features"))
    apart = [F.zip_with(x, F.array(*map(F.lit, c)), lambda v, w: F.pow(v - w, 2)) for c in model.centers]
    squares = F.array(*[F.aggregate(d, F.lit(0.0), lambda s, v: s + v) for d in apart])
    own = F.get(squares, F.col("cluster"))
    misplaced = (own > F.array_min(squares) * (1 + 1e-9) + 1e-12).cast("long")
    per_cluster = clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("zones"), F.sum("total_trips").alias("trips"), F.sum(misplaced).alias("misplaced")
    )
    return per_cluster.agg(*[F.sum(name).alias(name) for name in ("zones", "trips", "misplaced")])


@query
def m5_demand_vectors(spark, d):
    ready = rounded(models.demand_input(_hourly(spark, d)), count=models.LABEL)
    vectors = models.assemble(ready, models.DEMAND_FEATURES, "features")
    return vectors.select(*_columns_of(vectors, "features", models.DEMAND_FEATURES), models.LABEL)


@query
def m6_hash_split(spark, d):
    ready = models.demand_input(_hourly(spark, d))
    label = F.when(models.is_train(), "train").otherwise("test")
    return ready.select(*models.DEMAND_KEY, label.alias("part"))


@query
def m6_random_split(spark, d):
    train, test = models.random_split(models.demand_input(_settled_hourly(spark, d)))
    marked = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return marked.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))


@query
def m7_linear_regression(spark, d):
    train, test = models.hash_split(models.demand_input(_settled_hourly(spark, d)))
    predicted = models.fit_linear(train).transform(test)
    return rounded(predicted.select(*models.DEMAND_KEY, models.LABEL, "prediction"))


@query
def m7_linear_facts(spark, d):
    """A linear fit with an intercept meets the mean of its training rows."""
    train, _ = models.hash_split(models.demand_input(_settled_hourly(spark, d)))
    predicted = models.fit_linear(train).transform(train)
    return rounded(predicted.agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("prediction"), 4).alias("mean_label")))


@query
def m8_tree_rows(spark, d):
    """The test rows, each with a finite prediction."""
    train, test = models.hash_split(models.demand_input(_settled_hourly(spark, d)))
    predicted = models.fit_trees(train).transform(test)
    finite = predicted.where(F.col("prediction").isNotNull() & (F.abs("prediction") < float("inf")))
    return finite.select(*models.DEMAND_KEY, models.LABEL)


@query
def m8_boosted_trees(spark, d):
    train, test = models.hash_split(models.demand_input(_settled_hourly(spark, d)))
    predicted = models.fit_trees(train).transform(test)
    return rounded(predicted.select(*models.DEMAND_KEY, models.LABEL, "prediction"))


#: A tree starts from the residuals of the one before, so that two trees of full depth show every step of the fit.
FIRST_TREES = Params(gbt_trees=2)


def _histogram_trees(spark: SparkSession, d: str):
    train, test = models.hash_split(models.demand_input(_settled_hourly(spark, d)))
    return models.fit_histogram_trees(train, FIRST_TREES), test


@query
def m8_histogram_trees(spark, d):
    """Predictions of the first boosted trees for the test rows."""
    fit, test = _histogram_trees(spark, d)
    return rounded(fit.transform(test).select(*models.DEMAND_KEY, models.LABEL, "prediction"))


@query
def m8_histogram_splits(spark, d):
    """Every split of the first boosted trees."""
    splits = [(s.tree, s.node, models.DEMAND_FEATURES[s.feature], s.bin, s.gain) for s in _histogram_trees(spark, d)[0].splits]
    return rounded(spark.createDataFrame(splits, "tree int, node int, feature string, bin int, gain double"), 4)


@query
def m9_histogram_importances(spark, d):
    """The share of each feature in the gains of the first boosted trees."""
    found = _histogram_trees(spark, d)[0].importances()
    return rounded(spark.createDataFrame(list(found.items()), "feature string, importance double"))


@query
def m9_feature_importances(spark, d):
    hourly = _settled_hourly(spark, d)
    train, _ = models.hash_split(models.demand_input(hourly))
    return rounded(models.feature_importances(models.fit_trees(train), hourly))


@query
def m10_model_comparison(spark, d):
    return rounded(models.run_regression(_settled_hourly(spark, d))[0])


@query
def m10_comparison_facts(spark, d):
    """RMSE and R2 of each model agree with the variance of the test labels."""
    metrics = models.run_regression(_settled_hourly(spark, d))[0]
    variance = F.pow("rmse", 2) / (1 - F.col("r2"))
    return metrics.select("model", F.round(variance, 4).alias("label_variance"))


@query
def m6_random_split_rows(spark, d):
    """Both parts of the seeded split together are the input."""
    train, test = models.random_split(models.demand_input(_settled_hourly(spark, d)))
    return train.unionByName(test).select(*models.DEMAND_KEY, models.LABEL)


# --- composites -----------------------------------------------------------------------------------


@query
def c1_clean_and_engineer(spark, d):
    return features.clean_and_engineer(tables.trips(spark, d), tables.zones(spark, d))


@query
def c2_clean(spark, d):
    return clean.clean(tables.trips(spark, d))


@query
def c3_site_recommendations(spark, d):
    return rounded(_recommendations(spark, d, Params()))


@query
def c3_site_recommendations_selective(spark, d):
    return rounded(_recommendations(spark, d))


@query
def c5_compact_etl(spark, d):
    return rounded(aggregates.compact_etl(tables.trips(spark, d)))


@query
def c6_scaling_report(spark, d):
    """The compact job over the given trips; seconds and speeds are left to the job's own report."""
    report = scaling_table(spark, {"trips": lambda: tables.trips(spark, d)})
    return report.select("input", "rows", "zones")


@query
def c6_scaling_sizes(spark, d):
    """The compact job over three nested sizes of the given trips, each a share of the keys by their hash.

    The trips are derived once and stored with the columns of the job, as the inputs of a scaling report are; each size reads
    its share of them.
    """
    seconds = {name: F.unix_timestamp(column) for name, column in EPOCH.items()}
    trips, path = tables.trips(spark, d).withColumns(seconds), scratch(spark, "scaling")
    bucket = models.hash_bucket("VendorID", "PULocationID", "DOLocationID", *EPOCH)
    write_table(trips.select(*clean.COMPACT_REQUIRED, *EPOCH.values(), bucket.alias("bucket")), path)
    stored = spark.read.parquet(path)
    sizes = {f"{share} %": lambda share=share: stored.where(F.col("bucket") < share) for share in (10, 50, 100)}
    return scaling_table(spark, sizes).select("input", "rows", "zones")


def _demand_chart(name: str, chart: str) -> None:
    def run(spark, d):
        cube = settle(aggregates.demand_cube(_trip_features(spark, d)))
        zones = tables.zones(spark, d)
        hourly = aggregates.hourly_demand_from_cube(cube, zones)
        zone_table = aggregates.zone_aggregates_from_cube(cube, zones)
        return rounded(reports.demand_charts(hourly, zone_table)[chart])

    QUERIES[name] = run


def _site_chart(name: str, chart: str) -> None:
    def run(spark, d):
        recommendations = _recommendations(spark, d)
        charts = reports.site_charts(_zone_points(spark, d), tables.stations(spark, d), recommendations)
        return rounded(charts[chart])

    QUERIES[name] = run


_demand_chart("c7_demand_by_hour", "demand_by_hour")
_demand_chart("c7_borough_comparison", "borough_comparison")
_demand_chart("c7_distance_histogram", "distance_histogram")
_demand_chart("c7_distance_curve", "distance_curve")
_demand_chart("c7_distance_averages", "distance_averages")
_site_chart("c7_gap_map", "gap_map")
_site_chart("c7_gap_map_labels", "gap_map_labels")
_site_chart("c7_savings", "savings")
_site_chart("c7_savings_total", "savings_total")


@query
def c7_cluster_profiles(spark, d):
    clustered, _, summary = models.run_kmeans(_settled_zones(spark, d))
    return rounded(reports.cluster_charts(clustered, settle(summary))["cluster_profiles"])


