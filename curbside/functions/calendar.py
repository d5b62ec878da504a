"""Calendar and trip-metric column expressions. All stay inside whole-stage code generation."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbside.params import Params

# Label and inclusive hour range of each part of the day; the rest is "evening".
DAY_PARTS = {
    "late_night": (0, 5),
    "morning_rush": (6, 9),
    "midday": (10, 15),
    "evening_rush": (16, 19),
}
REST_OF_DAY = "evening"


def flag(condition: Column) -> Column:
    """1 where the condition holds, otherwise (also for null) 0."""
    return F.when(condition, 1).otherwise(0)


def weekend_flag(weekday: Column, params: Params = Params()) -> Column:
    return flag(weekday.isin(*params.weekend_days))


def rush_flag(hour: Column, params: Params = Params()) -> Column:
    return flag(reduce(or_, (hour.between(*span) for span in params.rush_hours)))


def day_part(hour: Column) -> Column:
    label = F
    for name, span in DAY_PARTS.items():
        label = label.when(hour.between(*span), name)
    return label.otherwise(REST_OF_DAY)


def minutes_between(start: Column, end: Column) -> Column:
    """Elapsed minutes from whole seconds; takes both timestamp kinds."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(60.0)


def ratio_if_positive(numerator: Column, denominator: Column) -> Column:
    """Division that is null unless the divisor is above zero."""
    return F.when(denominator > 0, numerator / denominator)


def clip(column: Column, low: float, high: float) -> Column:
    """Limit to a range; null stays null."""
    return F.when(column < low, F.lit(low)).when(column > high, F.lit(high)).otherwise(column)


def speed_up(baseline_seconds: Column, seconds: Column) -> Column:
    """Ratio of two timings to two decimals, half to even; 1.0 when the divisor is not positive."""
    return F.bround(F.when(seconds > 0, baseline_seconds / seconds).otherwise(F.lit(1.0)), 2)
