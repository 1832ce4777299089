"""Session settings for local runs and for a cluster."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC time.

    ``master`` is left to spark-submit on a cluster. Shuffle partitions start
    high there and adaptive execution merges what is too small.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
