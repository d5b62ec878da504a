"""Trips to ranked recommendations, with one scan of the trips."""

from __future__ import annotations

from pyspark.sql import DataFrame

from curbside.operators.aggregates import zone_aggregates
from curbside.operators.features import trip_features
from curbside.operators.lookup import check_dimension
from curbside.operators.recommend import measure_service, rank_sites
from curbside.params import Params
from curbside.plans.settle import settle


def recommend_from_zones(
    zone_table: DataFrame,
    zones: DataFrame,
    stations: DataFrame,
    params: Params = Params(),
    small: bool | None = None,
) -> DataFrame:
    """Recommendations from a settled zone aggregate (with or without a ``cluster`` column)."""
    measured = settle(measure_service(zone_table, stations, params))
    return rank_sites(measured, zones, params, small)


def recommend_from_trips(
    trips: DataFrame, zones: DataFrame, stations: DataFrame, params: Params = Params()
) -> DataFrame:
    """Recommendations from raw trips. The trips are read once, for the zone aggregate."""
    small = check_dimension(zones, "zone_id", params)
    zone_table = settle(zone_aggregates(trip_features(trips, params), zones, params, small))
    return recommend_from_zones(zone_table, zones, stations, params, small)
