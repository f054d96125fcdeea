"""A session with the settings the operators are designed around."""

from __future__ import annotations

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "spindrift", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session; ``conf`` keys use ``__`` for dots and win over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    given = {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in {**_DEFAULTS, **given}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
