"""Declared schemas and the projection that brings any source onto them."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT, _DOUBLE = T.IntegerType(), T.DoubleType()
_TEXT, _TIME = T.StringType(), T.TimestampType()


def _schema(columns: dict[str, T.DataType], required: tuple[str, ...] = ()) -> T.StructType:
    return T.StructType(
        [T.StructField(name, kind, name not in required) for name, kind in columns.items()]
    )


# The column names and types of a trip record.
TRIP_SCHEMA = _schema(
    {
        "VendorID": _INT,
        "tpep_pickup_datetime": _TIME,
        "tpep_dropoff_datetime": _TIME,
        "passenger_count": _DOUBLE,
        "trip_distance": _DOUBLE,
        "RatecodeID": _DOUBLE,
        "store_and_fwd_flag": _TEXT,
        "PULocationID": _INT,
        "DOLocationID": _INT,
        "payment_type": _INT,
        "fare_amount": _DOUBLE,
        "extra": _DOUBLE,
        "mta_tax": _DOUBLE,
        "tip_amount": _DOUBLE,
        "tolls_amount": _DOUBLE,
        "improvement_surcharge": _DOUBLE,
        "total_amount": _DOUBLE,
        "congestion_surcharge": _DOUBLE,
    }
)

ZONE_SCHEMA = _schema(
    {"zone_id": _INT, "zone_name": _TEXT, "borough": _TEXT, "zone_lat": _DOUBLE, "zone_lon": _DOUBLE},
    required=("zone_id",),
)

STATION_SCHEMA = _schema({"name": _TEXT, "lat": _DOUBLE, "lon": _DOUBLE, "num_chargers": _INT})


# Ids that a range rule keeps small. Stored as bigint, they stay so until that rule has been applied, as a
# filter on a cast column would not reach the scan.
BOUNDED_IDS = ("PULocationID", "DOLocationID")


def _agrees(name: str, have: T.DataType, want: T.DataType) -> bool:
    if name in BOUNDED_IDS and isinstance(have, T.LongType):
        return True
    # A wall-clock (NTZ) timestamp is as good as an instant: every operator takes both.
    either_timestamp = (T.TimestampType, T.TimestampNTZType)
    return have == want or (isinstance(want, T.TimestampType) and isinstance(have, either_timestamp))


def _cast(column: Column, have: T.DataType, want: T.DataType) -> Column:
    if isinstance(have, T.StringType) and isinstance(want, T.IntegerType):
        column = column.try_cast("double")  # "1.0" is a valid id in text files
    return column.try_cast(want)


def conform(df: DataFrame, schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """Cast every known column that is present to its declared type, in one projection.

    Columns that already have the type stay bare, so filters on them still reach the scan.
    Unknown columns pass through; a value that does not fit becomes null.
    """
    wanted = {field.name: field.dataType for field in schema}
    columns = []
    for field in df.schema:
        column, want = F.col(f"`{field.name}`"), wanted.get(field.name)
        if want is not None and not _agrees(field.name, field.dataType, want):
            column = _cast(column, field.dataType, want).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def narrow_ids(df: DataFrame) -> DataFrame:
    """Bounded ids in their declared type, after the rules that bound them."""
    kinds = dict(df.dtypes)
    wide = [name for name in BOUNDED_IDS if kinds.get(name) == "bigint"]
    return df.withColumns({name: F.col(name).cast("int") for name in wide}) if wide else df


def _lost(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    """For each known column whether its value is one that ``conform`` would turn into null."""
    wanted = {field.name: field.dataType for field in schema}
    known = [(F.col(f"`{field.name}`"), field) for field in df.schema if field.name in wanted]
    return {field.name: c.isNotNull() & _cast(c, field.dataType, wanted[field.name]).isNull() for c, field in known}


def is_rejected(df: DataFrame, schema: T.StructType = TRIP_SCHEMA) -> Column:
    """Whether a row has a ``reject_reason``, without spelling it out."""
    return reduce(or_, _lost(df, schema).values(), F.lit(False))


def reject_reason(df: DataFrame, schema: T.StructType = TRIP_SCHEMA) -> Column:
    """The known columns of a row that hold a value which ``conform`` would turn into null, by name; null if there are none.

    Without functions over arrays, below which Spark compiles nothing.
    """
    names = F.concat_ws(", ", *[F.when(lost, name) for name, lost in _lost(df, schema).items()])
    return F.when(names != "", F.concat(F.lit("unreadable "), names))


def unreadable_values(df: DataFrame, schema: T.StructType = TRIP_SCHEMA) -> DataFrame:
    """One row per known column: how many values ``conform`` would turn into null, in one pass.

    Pass a source as it is stored, for text files one with text columns (``read_csv_text``).
    """
    counts = [F.struct(F.lit(name).alias("column"), F.count_if(lost).alias("rows_unreadable")) for name, lost in _lost(df, schema).items()]
    return df.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))
