"""The trip cleaning rules, as one ordered table of named predicates.

Each predicate is a plain comparison on stored columns where that is possible, so Catalyst merges
the chain and pushes it into the scan. A null outcome drops the row, as a false one does.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.functions.calendar import minutes_between
from curbside.params import Params
from curbside.sources.schema import narrow_ids

# Columns without which a trip is unusable, and the shorter list of the compact job.
REQUIRED = (
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance",
    "PULocationID", "DOLocationID", "fare_amount", "passenger_count",
)
COMPACT_REQUIRED = ("trip_distance", "fare_amount", "passenger_count", "PULocationID")
FLOATING = ("trip_distance", "fare_amount", "passenger_count")

BASIC_RULES = (
    "required", "distance", "fare", "passengers", "time_order", "pickup_zone", "dropoff_zone", "total",
)
METRIC_RULES = ("duration", "speed")
COMPACT_RULES = ("compact_required", "distance", "fare", "passengers")


def _present(names: Iterable[str]) -> Column:
    checks = [F.col(name).isNotNull() for name in names]
    checks += [~F.isnan(name) for name in names if name in FLOATING]
    return reduce(and_, checks)


def duration_min() -> Column:
    return minutes_between(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))


def speed_mph() -> Column:
    """Miles per hour, null unless the duration is positive. The duration appears only once, which
    keeps the generated filter small enough for the JVM to compile."""
    hours = F.greatest(duration_min(), F.lit(0.0)) / F.lit(60.0)
    return F.try_divide(F.col("trip_distance"), hours)


def trip_rules(params: Params = Params()) -> dict[str, Column]:
    """Every rule by name, in the order of application."""
    return {
        "required": _present(REQUIRED),
        "compact_required": _present(COMPACT_REQUIRED),
        "distance": F.col("trip_distance").between(*params.distance_miles),
        "fare": F.col("fare_amount").between(*params.fare_amount),
        "passengers": F.col("passenger_count").between(*params.passengers),
        "time_order": F.col("tpep_dropoff_datetime") > F.col("tpep_pickup_datetime"),
        "pickup_zone": F.col("PULocationID").between(*params.zone_ids),
        "dropoff_zone": F.col("DOLocationID").between(*params.zone_ids),
        "total": F.col("total_amount") > 0,
        "duration": duration_min().between(*params.duration_min),
        "speed": speed_mph().between(*params.speed_mph),
    }


def apply_rules(df: DataFrame, names: Iterable[str], params: Params = Params()) -> DataFrame:
    rules = trip_rules(params)
    return df.where(reduce(and_, (rules[name] for name in names)))


def clean(df: DataFrame, params: Params = Params()) -> DataFrame:
    """Drop implausible trips: missing values, ranges, time order, zone ids, total."""
    return narrow_ids(apply_rules(df, BASIC_RULES, params))


def clean_compact(df: DataFrame, params: Params = Params()) -> DataFrame:
    """The smaller rule set of the compact job, which bounds no id: one too wide is no id."""
    kept = apply_rules(df, COMPACT_RULES, params)
    if dict(kept.dtypes)["PULocationID"] == "bigint":
        kept = kept.where(F.col("PULocationID").try_cast("int").isNotNull())
    return narrow_ids(kept)


def audit(
    df: DataFrame,
    names: Iterable[str] = BASIC_RULES + METRIC_RULES,
    params: Params = Params(),
) -> DataFrame:
    """One row per rule: rows that fail it alone, rows left after it, percent of all rows.

    A single pass with map-side partial counts. For an empty input the percentage is null.
    """
    rules, names = trip_rules(params), list(names)
    # Null outcomes count as failures. Every rule is computed once per row, as a 0/1 column.
    passed = df.select(
        *[F.coalesce(rules[name], F.lit(False)).alias(f"ok_{i}") for i, name in enumerate(names)]
    )
    counts = [F.count(F.lit(1)).alias("rows_in")]
    for i in range(len(names)):
        so_far = reduce(and_, (F.col(f"ok_{j}") for j in range(i + 1)))
        counts.append(F.count_if(~F.col(f"ok_{i}")).alias(f"failing_{i}"))
        counts.append(F.count_if(so_far).alias(f"kept_{i}"))
    steps = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("step"),
                F.lit(name).alias("rule"),
                F.col(f"failing_{i}").alias("rows_failing"),
                F.col(f"kept_{i}").alias("rows_kept"),
                F.try_divide(F.lit(100.0) * F.col(f"kept_{i}"), F.col("rows_in")).alias("percent_kept"),
            )
            for i, name in enumerate(names)
        ]
    )
    return passed.agg(*counts).select(F.inline(steps))
