"""The Spark session: UTC, adaptive execution, Arrow transfer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, name: str = "docflow") -> SparkSession:
    """A session for this engine. On a cluster master and partition count come from its own settings."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()
