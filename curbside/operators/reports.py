"""Report tables: the data behind every chart and exploration cell, without the drawing."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.functions.calendar import clip as clip_to
from curbside.functions.calendar import rush_flag
from curbside.operators.recommend import located_zones, total_saved_tonnes
from curbside.params import Params

PROFILE_METRICS = ("avg_trips_per_zone", "avg_distance", "rush_hour_fraction")


def trips_per_hour(features: DataFrame, params: Params = Params()) -> DataFrame:
    """Trips per pickup hour with the rush flag, in hour order."""
    counts = features.groupBy("pickup_hour").agg(F.count(F.lit(1)).alias("trips"))
    return counts.withColumn("is_rush_hour", rush_flag(F.col("pickup_hour"), params)).orderBy(
        "pickup_hour"
    )


def trips_per_borough(zones: DataFrame, keep_unknown: bool = False) -> DataFrame:
    """Trips per borough, ascending; zones without a borough only on request."""
    known = zones if keep_unknown else zones.where(F.col("borough").isNotNull())
    sums = known.groupBy("borough").agg(F.sum("total_trips").alias("trips"))
    return sums.orderBy("trips", "borough")


def busiest_zones(zones: DataFrame, n: int = 10) -> DataFrame:
    return zones.orderBy(F.desc("total_trips"), "PULocationID").limit(n)


def maxima(zones: DataFrame, *names: str) -> DataFrame:
    """The largest value of each column, in one row."""
    return zones.agg(*[F.max(name).alias(f"max_{name}") for name in names])


def mean_and_median(df: DataFrame, column: str = "avg_distance") -> DataFrame:
    """Mean and exact interpolated median of a column of any number of rows; null where it has no value."""
    values = _values(df, column)
    row = values.agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).first()
    middle = [order_statistic(values, rank, row.n, row.low, row.high) for rank in sorted({(row.n - 1) // 2, row.n // 2})] if row.n else []
    median = F.lit(sum(middle) / len(middle) if middle else None).cast("double")
    return df.agg(F.avg(column).alias("mean")).withColumn("median", median)


def _values(df: DataFrame, column: str) -> DataFrame:
    values = df.select(F.col(column).cast("double").alias("x"))
    return values.where(F.col("x").isNotNull() & ~F.isnan("x"))


def order_statistic(values: DataFrame, rank: int, n: int, low: float, high: float, most: int = 4096, ranges: int = 256) -> float:
    """The value ``x`` of the given rank (from 0) among ``n`` ones from ``low`` to ``high``.

    A bracket that holds the rank is narrowed: its values are counted in ranges, and the range of the rank, from its
    smallest value to its largest, is the next bracket. Each round is one aggregate of at most ``ranges`` rows per task; only
    when no more than ``most`` values are left do these reach the driver. Each bracket leaves out values of the one before.
    """
    while low < high:
        inside = values.where(F.col("x").between(low, high))
        if n <= most:
            return sorted(r.x for r in inside.collect())[rank]
        place = F.least(F.floor((F.col("x") - low) / ((high - low) / ranges)), F.lit(ranges - 1))
        counts = inside.groupBy(place.alias("range")).agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"))
        for r in sorted(counts.collect()):
            n, low, high = r.n, r.low, r.high
            if rank < n:
                break
            rank -= n
    return low


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum, one row per column, in one pass."""
    statistics = {
        "count": F.count,
        "mean": F.avg,
        "stddev": F.stddev_samp,
        "min": F.min,
        "max": F.max,
    }
    wide = df.agg(
        *[how(name).alias(f"{name}_{what}") for name in columns for what, how in statistics.items()]
    )
    rows = [
        F.struct(F.lit(name).alias("column"), *[F.col(f"{name}_{w}").alias(w) for w in statistics])
        for name in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def histogram(
    df: DataFrame, column: str, bins: int, clip: tuple[float, float] | None = None
) -> DataFrame:
    """Equal-width histogram from the smallest to the largest value, the last bin closed.

    Values are first limited to ``clip``, if given. Two passes over the one column: the range,
    then partial counts per bin. Every bin has a row; with a single distinct value the range is
    widened by one half on both sides.
    """
    value = F.col(column).cast("double")
    value = clip_to(value, *clip) if clip else value
    values = df.select(value.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    ends = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n"))
    pad = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(F.lit(0.0))
    scale = F.struct(
        (F.col("lo") - pad).alias("first"),
        ((F.col("hi") + pad - (F.col("lo") - pad)) / bins).alias("width"),
        "n",
    )
    stats = ends.select(scale).scalar().alias("s")
    first, width = F.col("s.first"), F.col("s.width")

    def edge(index: Column) -> Column:
        return first + index * width

    guess = F.least(F.floor((F.col("x") - first) / width), F.lit(bins - 1)).cast("int")
    # Division may land one bin off next to an edge; the edges decide.
    x, bin_ = F.col("x"), F.col("bin")
    placed = (
        F.when(x < edge(bin_), bin_ - 1)
        .when((x >= edge(bin_ + 1)) & (bin_ < bins - 1), bin_ + 1)
        .otherwise(bin_)
    )
    guessed = values.select("x", stats).select("x", "s", guess.alias("bin"))
    counts = guessed.groupBy(placed.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    rows = all_bins.join(counts, "bin", "left").select(
        "bin", F.coalesce("count", F.lit(0).cast("long")).alias("count"), stats
    )
    return (
        rows.where(F.col("s.n") > 0)
        .select(
            "bin",
            edge(bin_).alias("low"),
            edge(bin_ + 1).alias("high"),
            "count",
            (F.col("count") / (F.col("s.n") * width)).alias("density"),
        )
        .orderBy("bin")
    )


#: A value adds to the grid points within so many bandwidths; beyond, its kernel is below 2e-14 of its height.
REACH = 8.0


def kernel_rows(df: DataFrame, column: str, points: int, cap: float) -> DataFrame:
    """For each different value and each grid point in its reach: ``point``, ``v``, how many rows have it (``w``), and ``s`` with the
    grid's ends, the bandwidth and the number of rows. Equal values are one row before they are spread."""
    values = _values(df, column)
    stats = values.agg(
        F.struct(
            F.min("x").alias("lo"),
            F.least(F.max("x"), F.lit(cap)).alias("hi"),
            (F.stddev_samp("x") * F.pow(F.count("x"), F.lit(-0.2))).alias("h"),
            F.count("x").alias("n"),
        )
    ).scalar()
    lo, hi, h = F.col("s.lo"), F.col("s.hi"), F.col("s.h")
    step = (hi - lo) / (points - 1)
    first = F.greatest(F.lit(0), F.ceil((F.col("v") - REACH * h - lo) / step)).cast("int")
    last = F.least(F.lit(points - 1), F.floor((F.col("v") + REACH * h - lo) / step)).cast("int")
    weighed = values.groupBy(F.col("x").alias("v")).agg(F.count(F.lit(1)).alias("w"))
    near = weighed.select("v", "w", stats.alias("s")).where((h > 0) & (hi > lo)).select("v", "w", "s", first.alias("first"), last.alias("last"))
    return near.where("first <= last").select("v", "w", "s", F.explode(F.sequence("first", "last")).alias("point"))


def density_curve(df: DataFrame, column: str, points: int = 300, cap: float = 25.0) -> DataFrame:
    """Gaussian kernel density with Scott's bandwidth on an even grid from the smallest value to
    the largest or ``cap``. Empty when the values do not vary.

    Each different value adds its kernel to the grid points in its reach, with an error below 2e-14 of a kernel's height;
    the sums are combined on the map side, so only ``points`` rows per task are shuffled.
    """
    lo, hi, h = F.col("s.lo"), F.col("s.hi"), F.col("s.h")
    x = lo + F.col("point") * ((hi - lo) / (points - 1))
    u = (x - F.col("v")) / h
    sums = kernel_rows(df, column, points, cap).groupBy("point").agg(F.sum(F.col("w") * F.exp(-u * u / 2)).alias("mass"), F.any_value("s").alias("s"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    some = sums.agg(F.any_value("s")).scalar()
    filled = grid.join(sums.select("point", "mass"), "point", "left").select("point", F.coalesce("mass", F.lit(0.0)).alias("mass"), some.alias("s"))
    density = F.col("mass") / F.col("s.n") / (h * math.sqrt(2 * math.pi))
    return filled.where(h > 0).select("point", x.alias("x"), density.alias("density")).orderBy("point")


def scaled_profiles(summary: DataFrame, metrics: Sequence[str] = PROFILE_METRICS) -> DataFrame:
    """Each metric scaled to 0..1 over the clusters: (x - min) / (max - min + 1e-9)."""
    ends = summary.agg(
        F.struct(
            *[F.min(m).alias(f"{m}_min") for m in metrics],
            *[F.max(m).alias(f"{m}_max") for m in metrics],
        )
    ).scalar()

    def scaled(m: str) -> Column:
        low, high = ends.getField(f"{m}_min"), ends.getField(f"{m}_max")
        return ((F.col(m) - low) / (high - low + F.lit(1e-9))).alias(m)

    return summary.select("cluster", *[scaled(m) for m in metrics]).orderBy("cluster")


def point_sizes(zones: DataFrame) -> DataFrame:
    """Map points of the located zones: 80 + 400 x trips / largest trips."""
    located = located_zones(zones)
    top = located.agg(F.max("total_trips")).scalar()
    names = [n for n in ("PULocationID", "cluster", "lon", "lat") if n in zones.columns]
    return located.select(*names, (F.lit(80) + F.col("total_trips") / top * 400).alias("size"))


def cluster_labels(clustered: DataFrame) -> DataFrame:
    return clustered.select("cluster").distinct().orderBy("cluster")


def gap_map(zones: DataFrame, stations: DataFrame, recommendations: DataFrame) -> DataFrame:
    """Three layers of map points: zones, existing stations, recommended sites."""

    def layer(df: DataFrame, name: str, id_column: str) -> DataFrame:
        return df.select(
            F.lit(name).alias("layer"), F.col(id_column).cast("string").alias("id"), "lon", "lat"
        )

    return (
        layer(located_zones(zones), "zone", "PULocationID")
        .unionByName(layer(stations, "station", "name"))
        .unionByName(layer(recommendations, "recommended", "PULocationID"))
    )


def savings_ascending(recommendations: DataFrame) -> DataFrame:
    return recommendations.select(
        "PULocationID", "zone_name", "annual_co2_saved_tonnes"
    ).orderBy("annual_co2_saved_tonnes", "PULocationID")


def importances_ascending(importances: DataFrame) -> DataFrame:
    return importances.orderBy("importance", "feature")


def top_labels(recommendations: DataFrame, n: int = 5, width: int = 18) -> DataFrame:
    """Map labels ``#rank name`` of the first ``n`` sites, the name cut to ``width`` characters."""
    name = F.substring("zone_name", 1, width)
    label = F.concat(F.lit("#"), F.col("rank").cast("string"), F.lit(" "), name)
    return recommendations.where(F.col("rank") <= n).select("rank", "lon", "lat", label.alias("label"))


def demand_charts(
    hourly: DataFrame, zones: DataFrame, params: Params = Params()
) -> dict[str, DataFrame]:
    """Hour, borough and distance charts, from the hourly and zone tables alone."""
    located = located_zones(zones)
    per_hour = hourly.groupBy("pickup_hour").agg(F.sum("trip_count").alias("trips"))
    per_hour = per_hour.withColumn("is_rush_hour", rush_flag(F.col("pickup_hour"), params))
    return {
        "demand_by_hour": per_hour.orderBy("pickup_hour"),
        "borough_comparison": trips_per_borough(located),
        "distance_histogram": histogram(located, "avg_distance", 30),
        "distance_curve": density_curve(located, "avg_distance"),
        "distance_averages": mean_and_median(located),
    }


def cluster_charts(clustered: DataFrame, summary: DataFrame) -> dict[str, DataFrame]:
    return {"cluster_map": point_sizes(clustered), "cluster_profiles": scaled_profiles(summary)}


def site_charts(
    zones: DataFrame, stations: DataFrame, recommendations: DataFrame
) -> dict[str, DataFrame]:
    return {
        "gap_map": gap_map(zones, stations, recommendations),
        "gap_map_labels": top_labels(recommendations),
        "savings": savings_ascending(recommendations),
        "savings_total": total_saved_tonnes(recommendations),
    }


def model_charts(metrics: DataFrame, importances: DataFrame) -> dict[str, DataFrame]:
    return {"model_comparison": metrics, "feature_importance": importances_ascending(importances)}
