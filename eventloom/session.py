"""Session settings the engine is designed for.

Nothing here sizes anything to one machine: the number of shuffle partitions is an upper
bound that AQE coalesces, and joins are broadcast only when Spark has measured the side.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Filters built from a small join side reach the scan of the large one.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def builder(app_name: str = "eventloom") -> SparkSession.Builder:
    """A session builder carrying `SETTINGS`; add master and memory as the cluster needs."""
    b = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        b = b.config(key, value)
    return b
