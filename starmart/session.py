"""Session factory."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# AQE re-plans joins and partition counts from real sizes; dates compare the same on every host in UTC.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The table contracts rely on casts that fail instead of giving NULL.
    "spark.sql.ansi.enabled": "true",
}


def get_or_create_spark_session(
    app_name: str = "starmart", config: Mapping[str, str] | None = None
) -> SparkSession:
    return SparkSession.builder.appName(app_name).config(map={**DEFAULTS, **(config or {})}).getOrCreate()
