"""Sinks. Every writer overwrites its target and keeps the partitioning of the input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _dated(df: DataFrame, unit: str) -> DataFrame:
    dated = df.withColumn("pickup_date", F.to_date(F.date_trunc(unit, "tpep_pickup_datetime")))
    return dated.hint("rebalance", "pickup_date")


def write_trips(df: DataFrame, path: str, by_date: bool = False, unit: str = "day") -> None:
    """Enriched trips as Parquet; ``by_date`` adds a ``pickup_date`` partition directory, the first day of its ``unit``.

    The rebalance hint gathers each date into few files and lets adaptive execution split a date
    that is larger than the advisory partition size, so one busy day never lands on one task.
    """
    if by_date:
        _dated(df, unit).write.mode("overwrite").partitionBy("pickup_date").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def replace_days(df: DataFrame, path: str, unit: str = "day") -> None:
    """Enriched trips into a table that ``write_trips`` partitioned by date: the days of ``df`` are replaced, all others
    stay as they are. So a late or corrected day is written alone, and writing it twice changes nothing.

    ``df`` holds the whole of each of its days, or of what other ``unit`` the table has. Trips without a pickup time are a day of their own. An empty ``df`` changes
    nothing.
    """
    replace_dates(_dated(df, unit), path)


def replace_dates(df: DataFrame, path: str) -> None:
    """Rows with a ``pickup_date`` into a table partitioned by it: the dates of ``df`` are replaced, all others stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("pickup_date").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, one record per row."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
