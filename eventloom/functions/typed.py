"""Text to typed value, with the conversion rules of the diagnostic logs.

A malformed literal becomes NULL instead of failing the job. An element that is present but
empty is 0 as a number and 1900-01-01 as a time; an absent element is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRING = "string"
INT = "int"
BIGINT = "bigint"
DATETIME = "datetime"


def to_time(text: Column) -> Column:
    """ISO text to TIMESTAMP_NTZ in UTC, independent of the session time zone."""
    local = text.try_cast("timestamp_ntz")
    # 'Z' is dropped by the cast; a numeric offset has to be subtracted to reach UTC.
    sign = F.substring(text, -6, 1)
    minutes = F.substring(text, -5, 2).try_cast("int") * 60 + F.substring(text, -2, 2).try_cast("int")
    shift = F.make_dt_interval(F.lit(0), F.lit(0), F.when(sign == "-", minutes).otherwise(-minutes))
    has_offset = sign.isin("+", "-") & (F.substring(text, -3, 1) == ":")
    return F.when(has_offset, local + shift).otherwise(local)


def to_number(text: Column, kind: str) -> Column:
    """Text to int or bigint; NULL when it is not a whole number."""
    return F.when(F.trim(text) == "", F.lit(0).cast(kind)).otherwise(text.try_cast(kind))


def typed(text: Column, kind: str = STRING, width: int | None = None) -> Column:
    """`text` as `kind`; strings are cut to `width` characters when one is given."""
    if kind in (INT, BIGINT):
        return to_number(text, kind)
    if kind == DATETIME:
        empty = F.lit("1900-01-01").cast("timestamp_ntz")
        return F.when(F.trim(text) == "", empty).otherwise(to_time(text))
    return F.left(text, F.lit(width)) if width else text


def failed(text: Column, kind: str) -> Column:
    """True where `text` is present but is not a literal of `kind`."""
    return text.isNotNull() & typed(text, kind).isNull()
