"""Spark session defaults that the jobs of this package are written for."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Adaptive execution picks the join strategy from measured sizes, merges small
# shuffle partitions and splits skewed ones, also where a split costs a shuffle.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # Checkpoint files go once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "salesloom", **overrides) -> SparkSession:
    """Build a session; ``overrides`` use ``__`` for the dots of a Spark setting."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {key.replace("__", "."): value for key, value in overrides.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, wherever the job was started."""
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="salesloom-"), "salesloom.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    file = os.path.join(folder, name)
                    archive.write(file, os.path.relpath(file, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
