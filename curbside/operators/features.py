"""Trip features: calendar columns, zone columns, trip metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbside.functions.calendar import day_part, ratio_if_positive, rush_flag, weekend_flag
from curbside.operators.clean import METRIC_RULES, apply_rules, clean, duration_min, speed_mph
from curbside.operators.lookup import broadcast_if, check_dimension
from curbside.params import Params


def add_calendar(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Hour, weekday (1 is Sunday), month, weekend and rush-hour flags, part of the day."""
    pickup = F.col("tpep_pickup_datetime")
    hour, weekday = F.hour(pickup), F.dayofweek(pickup)
    return df.withColumns(
        {
            "pickup_hour": hour,
            "pickup_dow": weekday,
            "pickup_month": F.month(pickup),
            "is_weekend": weekend_flag(weekday, params),
            "is_rush_hour": rush_flag(hour, params),
            "time_of_day": day_part(hour),
        }
    )


def pickup_dimension(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("zone_id").alias("PULocationID"),
        F.col("borough").alias("pu_borough"),
        F.col("zone_lat").alias("pu_lat"),
        F.col("zone_lon").alias("pu_lon"),
    )


def dropoff_dimension(zones: DataFrame) -> DataFrame:
    return zones.select(
        F.col("zone_id").alias("DOLocationID"), F.col("borough").alias("do_borough")
    )


def add_zones(
    df: DataFrame, zones: DataFrame, params: Params = Params(), small: bool | None = None
) -> DataFrame:
    """Pickup borough and position, dropoff borough. Zones unknown to the lookup stay null."""
    names = df.columns
    if small is None:
        small = check_dimension(zones, "zone_id", params)
    joined = df.join(broadcast_if(small, pickup_dimension(zones)), "PULocationID", "left").join(
        broadcast_if(small, dropoff_dimension(zones)), "DOLocationID", "left"
    )
    return joined.select(*names, "pu_borough", "pu_lat", "pu_lon", "do_borough")


def add_metrics(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Duration, speed and fare per mile, for trips with a plausible duration and speed."""
    return apply_rules(df, METRIC_RULES, params).withColumns(
        {
            "trip_duration_min": duration_min(),
            "speed_mph": speed_mph(),
            "fare_per_mile": ratio_if_positive(F.col("fare_amount"), F.col("trip_distance")),
        }
    )


def trip_features(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Clean trips with calendar columns and metrics, without the zone lookup."""
    return df.transform(clean, params).transform(add_calendar, params).transform(add_metrics, params)


def clean_and_engineer(
    df: DataFrame, zones: DataFrame, params: Params = Params(), small: bool | None = None
) -> DataFrame:
    """The full feature table: one map-only stage when the zones fit a broadcast. With ``small``,
    the outcome of ``check_dimension``, no job runs before an action."""
    return (
        df.transform(clean, params)
        .transform(add_calendar, params)
        .transform(add_zones, zones, params, small)
        .transform(add_metrics, params)
    )
