"""Ranking of underserved high-demand zones, with the emissions a new site would save."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from curbside.functions import scores
from curbside.operators.lookup import attach
from curbside.operators.spatial import fits_expanded, nearest_station, stations_within
from curbside.params import Params

RECOMMENDATION_COLUMNS = (
    "PULocationID", "borough", "lat", "lon", "total_trips", "rush_hour_fraction", "avg_distance",
    "avg_fare", "cluster", "demand_score", "nearest_station_km", "chargers_within_1km",
    "nearest_station_km_clipped", "gap_score", "priority_score", "zone_name", "annual_trips_est",
    "annual_co2_saved_kg", "annual_co2_saved_tonnes", "rank",
)
_SITE_COLUMNS = RECOMMENDATION_COLUMNS[:9]


def located_zones(zones: DataFrame) -> DataFrame:
    """Zones with both coordinates."""
    return zones.dropna(subset=["lat", "lon"])


def fully_known_zones(zones: DataFrame) -> DataFrame:
    """Zones without a null in any of the map columns, borough included."""
    names = ("PULocationID", "borough", "lat", "lon", "total_trips", "cluster")
    return zones.select(*[n for n in names if n in zones.columns]).dropna()


def measure_service(
    zones: DataFrame, stations: DataFrame, params: Params = Params()
) -> DataFrame:
    """Located zones with the distance to the nearest station and the stations in the radius.

    ``zones`` is a settled aggregate (see ``plans.settle``). ``chargers_within_1km`` counts
    stations; the number of chargers a station has plays no part.
    """
    located = located_zones(zones)
    small = fits_expanded(located, "PULocationID", "lat", "lon", params)
    nearest = nearest_station(located, stations, small=small, params=params)
    within = stations_within(
        located, stations, params.coverage_radius_km, small=small, params=params
    )
    count = within.select("PULocationID", F.col("stations_within").alias("chargers_within_1km"))
    names = [name for name in _SITE_COLUMNS if name in located.columns]
    return located.select(*names).join(nearest, "PULocationID").join(count, "PULocationID")


def score_zones(measured: DataFrame, params: Params = Params()) -> DataFrame:
    """Demand, gap and priority score. Both maxima are taken over all located zones."""
    top = measured.agg(
        F.struct(
            F.max("total_trips").alias("trips"),
            F.max(scores.finite_km(F.col("nearest_station_km"), params)).alias("km"),
        )
    ).scalar()
    demand = scores.demand_score(
        F.col("total_trips"), top.getField("trips"), F.col("rush_hour_fraction"), params
    )
    return (
        measured.withColumns(
            {
                "demand_score": demand,
                "nearest_station_km_clipped": scores.capped_km(F.col("nearest_station_km"), params),
            }
        )
        .withColumn(
            "gap_score", scores.gap_score(F.col("nearest_station_km_clipped"), top.getField("km"))
        )
        .withColumn(
            "priority_score",
            scores.priority_score(F.col("demand_score"), F.col("gap_score"), params),
        )
    )


def hotspots(zones: DataFrame, params: Params = Params()) -> DataFrame:
    return zones.where(F.col("total_trips") >= params.min_trips)


def underserved(measured: DataFrame, params: Params = Params()) -> DataFrame:
    return measured.where(F.col("chargers_within_1km") < params.covered_from)


def top_sites(scored: DataFrame, params: Params = Params()) -> DataFrame:
    """The ``top_n`` rows by priority, zone id on a tie: one bounded top-k, no full sort."""
    return scored.orderBy(F.desc("priority_score"), "PULocationID").limit(params.top_n)


def add_rank(top: DataFrame) -> DataFrame:
    """Rank 1..N by priority. The window sees only the rows kept by ``top_sites``."""
    order = Window.orderBy(F.desc("priority_score"), F.col("PULocationID"))
    return top.withColumn("rank", F.row_number().over(order))


def add_zone_name(
    df: DataFrame, zones: DataFrame, params: Params = Params(), small: bool | None = None
) -> DataFrame:
    """Zone name from the lookup, ``Zone <id>`` where it is missing."""
    names = zones.select(F.col("zone_id").alias("PULocationID"), "zone_name")
    fallback = F.concat(F.lit("Zone "), F.col("PULocationID").cast("string"))
    return attach(df, names, "PULocationID", params, small).withColumn(
        "zone_name", F.coalesce("zone_name", fallback)
    )


def add_savings(df: DataFrame, params: Params = Params()) -> DataFrame:
    grams = scores.saved_grams_per_trip(F.col("avg_distance"), params)
    return (
        df.withColumn("annual_trips_est", scores.annual_trips(F.col("total_trips"), params))
        .withColumn(
            "annual_co2_saved_kg", scores.annual_saved_kg(F.col("annual_trips_est"), grams, params)
        )
        .withColumn("annual_co2_saved_tonnes", scores.saved_tonnes(F.col("annual_co2_saved_kg")))
    )


def rank_sites(
    measured: DataFrame, zones: DataFrame, params: Params = Params(), small: bool | None = None
) -> DataFrame:
    """From measured zones to the ranked recommendations."""
    ranked = (
        measured.transform(score_zones, params)
        .transform(hotspots, params)
        .transform(underserved, params)
        .transform(top_sites, params)
        .transform(add_rank)
        .transform(add_zone_name, zones, params, small)
        .transform(add_savings, params)
    )
    return ranked.select(*[name for name in RECOMMENDATION_COLUMNS if name in ranked.columns])


def total_saved_tonnes(recommendations: DataFrame) -> DataFrame:
    return recommendations.agg(
        F.round(F.sum("annual_co2_saved_tonnes"), 6).alias("total_tonnes"),
        F.count(F.lit(1)).alias("sites"),
    )
