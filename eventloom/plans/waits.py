"""Wait statistics over a wait capture."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.lookup import in_order


def wait_stats(waits: DataFrame) -> DataFrame:
    """Per session and wait type. Partial sums are taken in the map tasks, so one busy session
    shuffles one row per task and wait type."""
    return waits.groupBy("Session_ID", "WaitType").agg(
        F.count("WaitType").alias("Counts"),
        F.sum("Duration").alias("Sum_Duration"),
        F.sum("Signal_Duration").alias("Sum_SignalDuration"),
    )


def wait_stats_by_count(waits: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(wait_stats(waits), ordered, "Session_ID", F.desc("Counts"))


def wait_stats_by_duration(waits: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(wait_stats(waits), ordered, "Session_ID", F.desc("Sum_Duration"))
