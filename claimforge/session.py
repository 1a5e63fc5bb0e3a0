"""A session with the settings the engine is tested under."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(name: str = "claimforge", cores: int | None = None) -> SparkSession:
    """A session; with ``cores``, a local one with as many shuffle partitions. A cluster's own settings win."""
    build = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.showConsoleProgress", "false")
    if cores:
        build = build.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", str(cores)).config("spark.ui.enabled", "false").config("spark.driver.memory", os.environ.get("CLAIMFORGE_DRIVER_MEMORY", "8g"))
    spark = build.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
