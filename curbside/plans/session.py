"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution coalesces small shuffle partitions and splits hot ones, in joins and in
# rebalanced writes. Generated methods above 8000 bytes of code are never compiled by the JVM and run
# many times slower, so Spark shall take its split form for them. Wall-clock functions are pinned to
# one zone.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(
    app_name: str = "curbside", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with the settings above. Pass cluster-specific ones by name, dots as ``__``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
