"""Session settings that the library's semantics rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Timestamps are UTC, TIME is enabled, plans adapt at run time; ANSI mode is Spark's default and stays on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timeType.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "skeinwork", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; settings given as keywords (with __ for .) come on top."""
    builder = SparkSession.builder.appName(app).config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    return (builder.master(master) if master else builder).getOrCreate()
