"""Session settings for local runs, tests and the benchmark.

A cluster brings its own session; nothing in the library depends on this module.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    app_name: str = "fieldmill", cores: int | str = "*", memory: str = "8g", **conf: str
) -> SparkSession:
    """A single-JVM session with one shuffle partition per core and adaptive execution on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
