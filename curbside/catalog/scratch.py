"""A place for the files of round-trip queries, which the driver and all executors see."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder. Only a local session may go without the setting."""
    folder = spark.conf.get(SETTING, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{SETTING} must name a folder that the driver and all executors share")
        folder = Path(tempfile.mkdtemp(prefix="curbside-")).as_uri()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
