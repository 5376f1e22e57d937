"""Time rules: minute boundaries, clock text, ISO text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.numbers import whole
from eventloom.functions.text import two_digits

_ORIGIN = "timestamp_ntz'1900-01-01 00:00:00'"


def _minute_number(ts: Column) -> Column:
    return F.timestamp_diff("MINUTE", F.expr(_ORIGIN), ts)


def minute_boundaries(start: Column, end: Column) -> Column:
    """How many minute marks lie between two times (not how many full minutes)."""
    return _minute_number(end.cast("timestamp_ntz")) - _minute_number(start.cast("timestamp_ntz"))


def elapsed_clock(ms: Column) -> Column:
    """Milliseconds as HH:MM:SS."""
    return F.concat_ws(
        ":",
        two_digits(whole(ms, 3600000)),
        two_digits(whole(ms % 3600000, 60000)),
        two_digits(whole(ms % 60000, 1000)),
    )


def iso_text(ts: Column) -> Column:
    """`yyyy-MM-dd HH:mm:ss.SSS`, cut (not rounded) to milliseconds; no time zone is involved."""
    digits = ts.cast("string")
    return F.concat(F.left(digits, F.lit(19)), F.lit("."), F.rpad(F.substring(digits, 21, 3), 3, "0"))


def utc_now() -> Column:
    """The current time as zone-less UTC, like the times of the logs."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(F.current_timestamp()), F.expr("timestamp_ntz'1970-01-01 00:00:00'"))
