"""Tables written to the folder that all executors share, and small helpers of every operator."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session may go without the setting; it gets a folder of its own."""
    if not (folder := spark.conf.get(SETTING, None)):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
        folder = Path(tempfile.mkdtemp(prefix="llm-")).as_uri()
        spark.conf.set(SETTING, folder)
    return folder


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage: later steps reread the files and a lost executor costs only its running tasks.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def carrying(docs: DataFrame, column: str, name: str, rest: str) -> StructType:
    """A schema that hands ``column`` of ``docs`` through as ``name``, whatever its type, before the columns ``rest``."""
    return StructType([StructField(name, docs.schema[column].dataType), *StructType.fromDDL(rest).fields])


def whole_rows(docs: DataFrame, *without: str) -> DataFrame:
    """``row``, all columns but ``without`` as one value that an operator can hand through, and ``text``."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c not in without)).alias("row"), "text")


def held_out(doc_id: Column) -> Column:
    """True for the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Give the workers this package's modules, once per application; installed there, they would be found as well."""
    if spark.sparkContext.applicationId not in _shipped:
        folder = _shipped[spark.sparkContext.applicationId] = tempfile.TemporaryDirectory()
        package = Path(__file__).resolve().parents[1]
        path = Path(folder.name, f"{package.name}.zip")
        with zipfile.ZipFile(path, "w") as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(path))


_served: list[tempfile.TemporaryDirectory] = []


def serve(spark: SparkSession, name: str, values: np.ndarray) -> None:
    """Ship an array as the file ``name``, which names its content; `SparkFiles` finds it on every machine."""
    if name not in {os.path.basename(f) for f in spark.sparkContext.listFiles}:
        if not _served:
            _served.append(tempfile.TemporaryDirectory())  # Spark's file server of the driver reads from here
        path = os.path.join(_served[0].name, name)
        np.save(path, values)
        spark.sparkContext.addFile(path)


_caches: list[Callable] = []


def kept_by_workers(cached: Callable) -> Callable:
    """Mark what a worker keeps between tasks (of `functools.lru_cache`), for `release_caches`."""
    _caches.append(cached)
    return cached


def release_caches() -> None:
    """Drop what this worker keeps for tasks of earlier stages, before a task that needs the memory. Results never depend on it."""
    for cached in _caches:
        cached.cache_clear()
    gc.collect()
    hand_back()


def release_unused() -> None:
    """Hand free memory of Arrow's pool back, which it keeps at the size of the largest batch otherwise."""
    pa.default_memory_pool().release_unused()


def hand_back() -> None:
    """Hand all free memory of this worker back, also what numpy's arrays left with the C library. Caches stay."""
    release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc's
        trim(0)
