"""Joins with a dimension: broadcast behind a check of the measured size, shuffled beyond it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbside.params import Params


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of a table with flat columns.

    One aggregate job with map-side partial sums; only the sum reaches the driver.
    """
    return df.agg(F.sum(_row_bytes(df))).first()[0] or 0


def _row_bytes(df: DataFrame) -> Column:
    per_row = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            per_row = per_row + F.coalesce(F.octet_length(field.name), F.lit(0))
    return per_row


def fits_broadcast(df: DataFrame, params: Params = Params(), copies: int = 1) -> bool:
    """Whether ``copies`` times the table stay within the broadcast limit. Pass a dimension or a
    settled table: the check runs the plan of ``df``."""
    return measured_bytes(df) * copies <= params.broadcast_limit_bytes


def check_dimension(dim: DataFrame, key: str, params: Params = Params()) -> bool:
    """Whether a lookup table fits a broadcast; an error if a key occurs twice, which would multiply rows.

    One job. Call it once at the edge and hand the outcome (``small``) to the operators, which then
    start no job while a plan is built.
    """
    sizes = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(dim)).alias("bytes"))
    most, total = sizes.agg(F.max("n"), F.sum("bytes")).first()
    if (most or 0) > 1:
        raise ValueError(f"the lookup has several rows for one {key}")
    return (total or 0) <= params.broadcast_limit_bytes


def broadcast_if(small: bool, df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small else df


def attach(
    df: DataFrame, dim: DataFrame, on: str, params: Params = Params(), small: bool | None = None
) -> DataFrame:
    """Left join a dimension with one row per key. Without ``small`` (the outcome of
    ``check_dimension``), the dimension is checked here.

    Within the limit the dimension is broadcast and the large side never moves. Beyond it both
    sides are shuffled on the key, and adaptive execution splits the partition of a hot key.
    """
    if small is None:
        small = check_dimension(dim, on, params)
    return df.join(broadcast_if(small, dim), on, "left")
