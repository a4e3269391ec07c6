"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does three jobs here: it sizes shuffle partitions from the
# bytes really written, splits skewed join partitions, and splits or merges the
# partitions of a REBALANCE before a partitioned write.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split also where a later aggregate then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def get_session(app_name: str = "quaymart", **settings: str) -> SparkSession:
    """Return a session with :data:`SETTINGS`; keyword dots are written as ``__``.

    Master, memory and shuffle partitions stay with ``spark-submit``.
    """
    builder = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
