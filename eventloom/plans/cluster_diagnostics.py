"""Reports over the failover-cluster diagnostics log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.text import same
from eventloom.operators.lookup import in_order


def _rows(table: DataFrame, predicate: Column, ordered: bool) -> DataFrame:
    return in_order(table.where(predicate), ordered, "TimeStampUTC")


def unhealthy(component: DataFrame, ordered: bool = True) -> DataFrame:
    """Records of a component table whose state is not clean."""
    return _rows(component, ~same(F.col("State_Desc"), "clean"), ordered)


def long_ios(io: DataFrame, ordered: bool = True) -> DataFrame:
    return _rows(io, F.col("totalLongIos") > 0, ordered)


def pending_ios(io: DataFrame, ordered: bool = True) -> DataFrame:
    return _rows(io, F.col("duration") > 0, ordered)


def io_latch_timeouts(io: DataFrame, ordered: bool = True) -> DataFrame:
    return _rows(io, F.col("ioLatchTimeouts") > 0, ordered)


def max_pending_io(io: DataFrame) -> DataFrame:
    """Every record with the longest pending request, ties included.

    The maximum is a scalar subquery: one row comes back, nothing is cross-joined.
    """
    longest = io.agg(F.max("duration")).scalar()
    return io.where(F.col("duration") == longest).select(F.lit("Max duration event:").alias("label"), *io.columns)


def pending_io_histogram(io: DataFrame, ordered: bool = True) -> DataFrame:
    out = (
        io.where(F.col("duration").isNotNull())
        .groupBy(F.col("duration").alias("Duration ms"))
        .agg(F.count("*").alias("Count"))
    )
    return in_order(out, ordered, "Duration ms")


def nonyielding_schedulers(query: DataFrame, ordered: bool = True) -> DataFrame:
    return _rows(query, ~same(F.col("trackingNonYieldingScheduler"), "0x0"), ordered)


def nonyielding_tasks(system: DataFrame, ordered: bool = True) -> DataFrame:
    return _rows(system, F.col("nonYieldingTasksReported") != 0, ordered)


def ag_status_changes(changes: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(changes, ordered, "TimeStampUTC")


def ag_state_top(states: DataFrame, n: int = 200) -> DataFrame:
    """The first `n` states in time; further columns break ties so that the answer is stable."""
    ties = [F.col(c) for c in states.columns if c != "TimeStampUTC"]
    return states.orderBy("TimeStampUTC", *ties).limit(n)


_HEALTH_STATE = "%health state%"


def health_state_messages(messages: DataFrame, ordered: bool = True) -> DataFrame:
    return _rows(messages, F.col("InfoMessage").ilike(_HEALTH_STATE), ordered)


def other_info_messages(messages: DataFrame, ordered: bool = True) -> DataFrame:
    cols = ["ObjectName", "TimeStampUTC", "NodeName", "InstanceName", "InfoMessage"]
    return _rows(messages.select(*cols), ~F.col("InfoMessage").ilike(_HEALTH_STATE), ordered)


def misc_events(misc: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(misc, ordered, "TimeStampUTC")


def ring_buffer_listing(table: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(table, ordered, "RBEventTimeStampUTC")
