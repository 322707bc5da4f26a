"""A session with the settings that these queries are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# The number of shuffle partitions is left to the cluster: about one per
# 100 MB of text. Adaptive execution joins small partitions, but does not cut
# a small number of large ones into more.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "termloom", master: str | None = None, **settings) -> SparkSession:
    """Get or create a session. ``settings`` are Spark settings and win."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
