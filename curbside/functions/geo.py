"""Great-circle distance, and the nested cube grid that turns distance joins into equi-joins.

Points on the globe are placed on the unit sphere. The chord between two points grows with their
great-circle distance, so a cube grid in three dimensions covers a radius the same way everywhere:
the poles and the date line need no special case. Level 0 is one cube around the whole sphere;
every level halves the edge.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0  # fixed value
FINEST_LEVEL = 17  # cube edge of about 97 m


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(a), F.sqrt(F.greatest(1 - a, F.lit(0.0))))


def is_located(lat: Column, lon: Column) -> Column:
    """Both coordinates are present and numbers."""
    return lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)


def finest_index(lat: Column, lon: Column) -> dict[str, Column]:
    """The three cube indices at the finest level, 0 .. 2**FINEST_LEVEL - 1."""
    cells = 1 << FINEST_LEVEL
    phi, lam = F.radians(lat), F.radians(lon)
    axes = {"ix": F.cos(phi) * F.cos(lam), "iy": F.cos(phi) * F.sin(lam), "iz": F.sin(phi)}
    return {
        name: F.least(F.floor((value + 1) * (cells / 2)), F.lit(cells - 1).cast("long"))
        for name, value in axes.items()
    }


def at_level(index: Column, level: Column) -> Column:
    return F.call_function("shiftright", index, F.lit(FINEST_LEVEL) - level)


def cube_key(level: Column, ix: Column, iy: Column, iz: Column) -> Column:
    """One long per (level, cube): 18 bits per axis under the level."""
    span = F.lit(1 << 18).cast("long")
    return ((level.cast("long") * span + ix) * span + iy) * span + iz


def level_covering(radius_km: float) -> int:
    """The finest level whose cube edge is at least the chord of the radius.

    Everything within the radius of a point then lies in the point's cube or one that touches it.
    """
    angle = min(radius_km / (2 * EARTH_RADIUS_KM), math.pi / 2)
    chord = 2 * math.sin(angle) * (1 + 1e-9) + 1e-12
    return max(0, min(FINEST_LEVEL, math.floor(math.log2(2 / chord))))


def level_covering_column(km: Column) -> Column:
    """``level_covering`` of a column of distances."""
    angle = F.least(km / (2 * EARTH_RADIUS_KM), F.lit(math.pi / 2))
    chord = F.lit(2.0) * F.sin(angle) * (1 + 1e-9) + 1e-12
    level = F.floor(F.log2(F.lit(2.0) / chord))
    return F.greatest(F.lit(0), F.least(F.lit(FINEST_LEVEL), level)).cast("int")
