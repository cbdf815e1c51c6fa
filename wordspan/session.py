"""A session with the settings that the engine's plans are made for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Adaptive execution, UTC and Arrow; on a cluster leave `master` and `shuffle_partitions` to spark-submit."""
    builder = SparkSession.builder.appName("wordspan").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
