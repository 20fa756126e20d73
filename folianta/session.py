"""Session settings the operators are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "folianta", master: str | None = None, **conf: str) -> SparkSession:
    """A session with AQE, skew splitting and UTC times; ``conf`` overrides any of it.

    ``spark.sql.shuffle.partitions`` is left to the caller: AQE merges partitions that turn
    out small, so a large starting number is right on a cluster and a small one locally.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
