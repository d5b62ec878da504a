"""Trip readers: Parquet or CSV under the declared schema, without an inference pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbside.sources.schema import TRIP_SCHEMA, conform, is_rejected, reject_reason


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (local, HDFS, object store)."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return file_system.exists(hadoop_path)


def _csv_schema(names: list[str]) -> T.StructType:
    declared = {field.name: field.dataType for field in TRIP_SCHEMA}
    fields = []
    for name in names:
        data_type = declared.get(name, T.StringType())
        if isinstance(data_type, T.IntegerType):
            data_type = T.DoubleType()  # text files often hold ids as "1.0"; conform narrows them
        fields.append(T.StructField(name, data_type))
    return T.StructType(fields)


def read_csv_trips(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line. Only the header is read ahead; types come from the schema."""
    names = spark.read.option("header", True).csv(path).columns
    reader = spark.read.schema(_csv_schema(names)).option("header", True)
    return conform(reader.option("enforceSchema", False).csv(path))


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line, every column as text: the input of ``unreadable_values``."""
    return spark.read.option("header", True).csv(path)


#: Column of a rejected row that holds its line, if the line has too few or too many fields.
LINE = "_line"


def read_checked_csv_trips(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Trips of a CSV with a header line, and the rows that are none: a quarantine for a sink of its own.

    A row is rejected if its line has another number of fields than the header, or if a known column holds a value
    that does not fit the declared type. Rejected rows keep all columns as text, with ``reason`` and, for a
    wrong number of fields, the whole ``_line``. An empty field is a null, which fits any column. Both tables
    read the file on their own, in one narrow pass.
    """
    names = spark.read.option("header", True).csv(path).columns
    text = T.StructType([T.StructField(name, T.StringType()) for name in [*names, LINE]])
    # Without pruning, as the number of fields is only known where a line is parsed whole.
    options = {"header": True, "enforceSchema": False, "columnNameOfCorruptRecord": LINE, "columnPruning": False}
    rows = spark.read.schema(text).options(**options).csv(path)
    rejected = F.col(LINE).isNotNull() | is_rejected(rows)
    reason = F.when(F.col(LINE).isNotNull(), "number of fields").otherwise(reject_reason(rows))
    # Reasons are spelled out for rejected rows alone.
    return conform(rows.where(~rejected).drop(LINE)), rows.where(rejected).withColumn("reason", reason)


def read_parquet_trips(spark: SparkSession, path: str) -> DataFrame:
    return conform(spark.read.parquet(path))


def read_trips(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Read trips. Without ``fmt`` a ``.csv`` path prefers the Parquet copy beside it."""
    if fmt is None and path.endswith(".csv"):
        sibling = path[: -len(".csv")] + ".parquet"
        if path_exists(spark, sibling):
            return read_parquet_trips(spark, sibling)
        fmt = "csv"
    if fmt == "csv":
        return read_csv_trips(spark, path)
    if fmt in (None, "parquet"):
        return read_parquet_trips(spark, path)
    raise ValueError(f"unknown trip format: {fmt}")
