"""Site scores and the emissions estimate, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbside.params import Params


def demand_score(trips: Column, max_trips: Column, rush: Column, params: Params = Params()) -> Column:
    return trips / max_trips * F.lit(params.trips_weight) + rush * F.lit(params.rush_weight)


def finite_km(km: Column, params: Params = Params()) -> Column:
    """An infinite distance (no position, no station) counts as the cap."""
    return F.when(km == F.lit(float("inf")), F.lit(params.distance_cap_km)).otherwise(km)


def capped_km(km: Column, params: Params = Params()) -> Column:
    return F.least(km, F.lit(params.distance_cap_km))


def gap_score(capped: Column, max_km: Column) -> Column:
    """Capped distance over the largest uncapped one; null if every distance is zero."""
    return F.try_divide(capped, max_km)


def priority_score(demand: Column, gap: Column, params: Params = Params()) -> Column:
    return F.lit(params.demand_weight) * demand + F.lit(params.gap_weight) * gap


def saved_grams_per_trip(avg_miles: Column, params: Params = Params()) -> Column:
    return F.lit(params.combustion_g_per_mile - params.electric_g_per_mile) * avg_miles


def annual_trips(trips: Column, params: Params = Params()) -> Column:
    return (trips * F.lit(params.months)).cast("long")


def annual_saved_kg(trips_per_year: Column, grams: Column, params: Params = Params()) -> Column:
    """Whole kilograms, half to even."""
    return F.rint(trips_per_year * F.lit(params.adoption_rate) * grams / F.lit(1000.0)).cast("long")


def saved_tonnes(kg: Column) -> Column:
    """Tonnes to one decimal, half to even."""
    return F.rint(kg / F.lit(1000.0) * 10) / 10
