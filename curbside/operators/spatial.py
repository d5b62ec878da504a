"""Distance joins between points (zones) and stations, as equi-joins on a nested cube grid.

No operator here compares every point with every station, unless it is that far from all of them. The
points, usually few, are expanded to the cubes that a hit can lie in. When those cubes fit a
broadcast (measured), the stations are streamed past them in place: they are never shuffled, so it does
not matter how many of them share one cube, and the pairs are reduced on the map side at once. Beyond
the limit, stations at one place are merged to one row first, in both operators, both sides are
shuffled on the cube key, and adaptive execution splits a hot cube.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.functions.geo import (
    FINEST_LEVEL,
    at_level,
    cube_key,
    finest_index,
    haversine_km,
    is_located,
    level_covering,
    level_covering_column,
)
from curbside.operators.lookup import broadcast_if, fits_broadcast
from curbside.params import Params


_AXES = ("ix", "iy", "iz")


def _located_points(points: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    p_lat, p_lon = F.col(lat), F.col(lon)
    return points.where(is_located(p_lat, p_lon)).select(
        key,
        p_lat.alias("p_lat"),
        p_lon.alias("p_lon"),
        *[index.alias(name) for name, index in finest_index(p_lat, p_lon).items()],
    )


def _located_stations(stations: DataFrame, *extra: str) -> DataFrame:
    s_lat, s_lon = F.col("lat"), F.col("lon")
    return stations.where(is_located(s_lat, s_lon)).select(
        s_lat.alias("s_lat"),
        s_lon.alias("s_lon"),
        *extra,
        *[index.alias(name) for name, index in finest_index(s_lat, s_lon).items()],
    )


def fits_expanded(points: DataFrame, key: str, lat: str, lon: str, params: Params) -> bool:
    """Whether the points still fit a broadcast once each has its 27 cubes at every level."""
    return fits_broadcast(points.select(key, lat, lon), params, copies=27 * (FINEST_LEVEL + 1))


def _own_cube(level: Column) -> Column:
    return cube_key(level, *(at_level(F.col(axis), level) for axis in _AXES))


def _every_level(df: DataFrame, *names: str) -> DataFrame:
    """One row per level with the cube of the row's position."""
    levels = F.explode(F.sequence(F.lit(0), F.lit(FINEST_LEVEL))).alias("level")
    return df.select("*", levels).select(*names, "level", _own_cube(F.col("level")).alias("cube"))


def _surrounding_cubes(df: DataFrame, level: Column, *names: str) -> DataFrame:
    """One row per existing cube among the 27 around each row's position at ``level``."""
    moved = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(26))).alias("move"))
    axes = [
        at_level(F.col(axis), level) + F.expr(f"move div {3**i} % 3 - 1")
        for i, axis in enumerate(_AXES)
    ]
    edge_cubes = F.call_function("shiftleft", F.lit(1), level)
    exists = reduce(and_, [(axis >= 0) & (axis < edge_cubes) for axis in axes])
    return moved.where(exists).select(*names, cube_key(level, *axes).alias("cube"))


def _pair_km() -> Column:
    return haversine_km(F.col("p_lat"), F.col("p_lon"), F.col("s_lat"), F.col("s_lon"))


def stations_within(
    points: DataFrame,
    stations: DataFrame,
    radius_km: float,
    key: str = "PULocationID",
    lat: str = "lat",
    lon: str = "lon",
    small: bool | None = None,
    params: Params = Params(),
) -> DataFrame:
    """Per point: how many stations lie at most ``radius_km`` away, and their chargers in total.

    ``key`` identifies a point. Points without a position get 0. ``small`` skips the size check
    if the caller has made it (``fits_expanded``).
    """
    if small is None:
        small = fits_expanded(points, key, lat, lon, params)
    level = F.lit(level_covering(radius_km))
    here = _located_points(points, key, lat, lon)
    cubes = _surrounding_cubes(here, level, key, "p_lat", "p_lon")
    there = _located_stations(stations, "num_chargers").select(
        "s_lat", "s_lon", "num_chargers", _own_cube(level).alias("cube"), F.lit(1).alias("stations")
    )
    if not small:
        there = there.groupBy("cube", "s_lat", "s_lon").agg(
            F.sum("stations").alias("stations"), F.sum("num_chargers").alias("num_chargers")
        )
    hits = (
        there.join(broadcast_if(small, cubes), "cube")
        .where(_pair_km() <= radius_km)
        .groupBy(key)
        .agg(
            F.sum("stations").alias("stations_within"),
            F.sum("num_chargers").alias("chargers_total"),
        )
    )
    none = F.lit(0).cast("long")
    return points.select(key).join(broadcast_if(small, hits), key, "left").select(
        key,
        F.coalesce("stations_within", none).alias("stations_within"),
        F.coalesce("chargers_total", none).alias("chargers_total"),
    )


# Up to this level the sphere meets few enough cubes (at most 8**(level + 1) / 7) for a broadcast.
COARSE_LEVEL = 5


def _merged_stations(stations: DataFrame, *names: str) -> DataFrame:
    """One row per place; of several stations there, the first name."""
    there = _located_stations(stations, *names)
    return there.groupBy("s_lat", "s_lon", *_AXES).agg(*[F.min(n).alias(n) for n in names] or [F.lit(1).alias("one")])


def _search_levels(here: DataFrame, stations: DataFrame, key: str, small: bool) -> DataFrame:
    """Per point the finest level whose surrounding cubes are sure to hold the nearest station.

    One station stands for each occupied cube. The distance to the nearest of those in the
    cubes around the point, at any level, bounds the distance to the nearest station of all: a dense
    group just across a cube's face is seen as well as one in the point's own cube.
    """
    levels = F.explode(F.sequence(F.lit(0), F.lit(FINEST_LEVEL))).alias("level")
    here = here.select("*", levels)
    around = _surrounding_cubes(here, F.col("level"), key, "p_lat", "p_lon", "level")
    place = F.struct("s_lat", "s_lon").alias("place")
    occupied = _every_level(stations, "s_lat", "s_lon").select("level", "cube", place)

    def bound(cubes: DataFrame, places: DataFrame, few_cubes: bool, few_places: bool) -> DataFrame:
        if few_cubes:
            places = places.join(F.broadcast(cubes.select("cube").distinct()), "cube", "left_semi")
        one = places.groupBy("cube").agg(F.min("place").alias("place"))
        one = one.select("cube", "place.s_lat", "place.s_lon")
        pairs = broadcast_if(few_cubes, cubes).join(broadcast_if(few_places, one), "cube")
        return pairs.groupBy(key).agg(F.min(_pair_km()).alias("km"))

    if small:
        nearest = bound(around, occupied, True, False)
    else:
        coarse, fine = F.col("level") <= COARSE_LEVEL, F.col("level") > COARSE_LEVEL
        nearest = bound(around.where(coarse), occupied.where(coarse), False, True).unionByName(
            bound(around.where(fine), occupied.where(fine), False, False)
        )
        nearest = nearest.groupBy(key).agg(F.min("km").alias("km"))
    return nearest.select(key, level_covering_column(F.col("km")).alias("level"))


def candidate_pairs(
    points: DataFrame,
    stations: DataFrame,
    key: str = "PULocationID",
    lat: str = "lat",
    lon: str = "lon",
    with_name: bool = False,
    small: bool | None = None,
    params: Params = Params(),
) -> DataFrame:
    """The pairs of a point and a station among which each point's nearest one is, with ``km``."""
    if small is None:
        small = fits_expanded(points, key, lat, lon, params)
    here = _located_points(points, key, lat, lon)
    name = ["name"] if with_name else []
    there = _located_stations(stations, *name) if small else _merged_stations(stations, *name)
    levels = _search_levels(here, there, key, small)
    searching = here.join(broadcast_if(small, levels), key)
    cubes = _surrounding_cubes(searching, F.col("level"), key, "p_lat", "p_lon")

    there = _every_level(there, "s_lat", "s_lon", *name)
    if not small:
        # Only levels in use, at most FINEST_LEVEL + 1 rows on the broadcast side.
        there = there.join(F.broadcast(levels.select("level").distinct()), "level", "left_semi")
    return there.join(broadcast_if(small, cubes), "cube").select(key, *name, _pair_km().alias("km"))


def nearest_station(
    points: DataFrame,
    stations: DataFrame,
    key: str = "PULocationID",
    lat: str = "lat",
    lon: str = "lon",
    with_name: bool = False,
    small: bool | None = None,
    params: Params = Params(),
) -> DataFrame:
    """Per point: the great-circle distance to the nearest station, exact for any distance.

    ``with_name`` adds the station's name, the first in alphabetical order on a tie. Points without
    a position, or no stations at all, give an infinite distance.
    """
    if small is None:
        small = fits_expanded(points, key, lat, lon, params)
    pairs = candidate_pairs(points, stations, key, lat, lon, with_name, small)
    result = [F.min("km").alias("nearest_station_km")]
    if with_name:
        result.append(F.min_by("name", F.struct("km", "name")).alias("nearest_station"))
    best = pairs.groupBy(key).agg(*result)

    found = points.select(key).join(broadcast_if(small, best), key, "left")
    distance = F.coalesce("nearest_station_km", F.lit(float("inf"))).alias("nearest_station_km")
    return found.select(key, distance, *(["nearest_station"] if with_name else []))
