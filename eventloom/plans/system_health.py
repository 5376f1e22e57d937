"""Reports over the system-health log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.lookup import in_order
from eventloom.tables import system_health as logs


def _width(name: str, n: int, alias: str | None = None):
    return F.left(F.col(name).cast("string"), F.lit(n)).alias(alias or name)


def system_waits(waits: DataFrame, ordered: bool = True) -> DataFrame:
    out = waits.select(
        "TimeStampUTC",
        _width("WaitType", 25),
        _width("OpCode", 6),
        _width("duration", 12, "Duration(ms)"),
        _width("signal_duration", 15, "Signal Duration(ms)"),
    )
    return in_order(out, ordered, "TimeStampUTC")


def system_external_waits(waits: DataFrame, ordered: bool = True) -> DataFrame:
    out = waits.select(
        "TimeStampUTC", _width("WaitTypeText", 40), _width("OpCodeText", 6, "OpCode"), _width("Duration", 12, "Duration(ms)")
    )
    return in_order(out, ordered, "TimeStampUTC")


def system_errors(errors: DataFrame, ordered: bool = True) -> DataFrame:
    """Takes the error table with its raw event kept (`TableSpec.keeping_raw`)."""
    out = errors.select(
        "TimeStampUTC",
        _width("error_number", 11, "ErrorNumber"),
        _width("severity", 10, "Severity"),
        _width("state", 10, "State"),
        _width("user_defined", 10, "UserDefined"),
        _width("category", 10, "Category"),
        _width("destination", 10, "Destination"),
        _width("is_intercepted", 15, "IsIntercepted"),
        "message",
        "session_id",
        "database_id",
        "EventData",
    )
    return in_order(out, ordered, "TimeStampUTC")


# The tables shown whole, in time order.
LISTED = [
    logs.SCHEDULER_DEADLOCK,
    logs.SCHEDULER_NON_YIELDING,
    logs.SCHEDULER_NON_YIELDING_RM,
    logs.SCHEDULER_SYSTEM_HEALTH,
    logs.COMPONENT_SYSTEM,
    logs.COMPONENT_RESOURCE,
    logs.COMPONENT_IO,
    logs.COMPONENT_QUERY,
    logs.CONNECTIVITY,
    logs.SECURITY_ERROR,
]


def listing(table: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(table, ordered, "TimeStampUTC")
