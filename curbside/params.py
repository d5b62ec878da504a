"""All thresholds, weights and model settings, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # Plausibility ranges of a trip, both ends included.
    distance_miles: tuple[float, float] = (0.1, 100.0)
    fare_amount: tuple[float, float] = (2.5, 500.0)
    passengers: tuple[int, int] = (1, 8)
    zone_ids: tuple[int, int] = (1, 265)
    duration_min: tuple[int, int] = (1, 300)
    speed_mph: tuple[float, float] = (0.5, 80.0)

    # Calendar flags (weekday 1 is Sunday, hour ranges inclusive).
    weekend_days: tuple[int, ...] = (1, 7)
    rush_hours: tuple[tuple[int, int], ...] = ((7, 9), (16, 19))

    # Site scoring.
    coverage_radius_km: float = 1.0
    covered_from: int = 2
    min_trips: int = 500
    top_n: int = 10
    trips_weight: float = 0.7
    rush_weight: float = 0.3
    demand_weight: float = 0.60
    gap_weight: float = 0.40
    distance_cap_km: float = 30.0

    # Emissions estimate (grams of CO2 per mile).
    combustion_g_per_mile: float = 404.0
    electric_g_per_mile: float = 80.0
    adoption_rate: float = 0.30
    months: int = 12

    # Model settings.
    clusters: int = 8
    kmeans_max_iter: int = 50
    sweep_max_iter: int = 20
    seed: int = 42
    train_ratio: float = 0.8
    linear_max_iter: int = 100
    linear_reg_param: float = 0.01
    linear_elastic_net: float = 0.0
    gbt_trees: int = 50
    gbt_depth: int = 5
    gbt_step: float = 0.1

    # Iterative fits: rows of a task (each of their many small jobs then starts few tasks), and how many
    # fits run at once.
    rows_per_task: int = 50_000
    parallelism: int = 4

    # A lookup side is broadcast only if its measured size is at most this.
    broadcast_limit_bytes: int = 64 * 1024 * 1024
