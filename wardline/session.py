"""Session settings the library expects."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "wardline", cores: int | None = None, **conf) -> SparkSession:
    """A session with UTC time and adaptive execution.

    ``cores`` sets a local master; leave it out on a cluster, where the master, the executor
    sizes and ``spark.checkpoint.dir`` come from the submit command.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if cores:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", os.environ.get("WARDLINE_DRIVER_MEMORY", "12g"))
            .config("spark.ui.enabled", "false")
        )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
