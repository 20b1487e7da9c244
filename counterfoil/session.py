"""A session with the settings the jobs expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(
    app: str = "counterfoil", master: str | None = None, **settings: str
) -> SparkSession:
    """UTC, adaptive plans with skew splitting; ``settings`` override or add.

    On a cluster leave ``master`` out and set ``spark.checkpoint.dir`` to shared storage.
    """
    options = {
        "spark.sql.session.timeZone": "UTC",
        # An overflow must stop the job, not turn into null.
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
        # Looking up the calling line of every column expression costs more than planning.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    } | {key.replace("__", "."): value for key, value in settings.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, setting in options.items():
        builder = builder.config(key, setting)
    return builder.getOrCreate()
