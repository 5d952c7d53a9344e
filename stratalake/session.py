"""Session settings the warehouse relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Adaptive execution with skew handling, UTC, no web page. Cluster sizes come from the submit command."""
    builder = (
        SparkSession.builder.appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
