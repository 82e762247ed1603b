"""A session with the settings the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", name: str = "parcelflow", **settings: str) -> SparkSession:
    """A local session in UTC. On a cluster, the submitted configuration decides; only the time zone must be UTC."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
