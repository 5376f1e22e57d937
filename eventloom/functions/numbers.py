"""Arithmetic with whole-number division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(a: Column, b: Column | int) -> Column:
    """Division that truncates toward zero; NULL (not an error) when dividing by zero."""
    divisor = b if isinstance(b, Column) else F.lit(b)
    return F.call_function("div", a, F.nullif(divisor, F.lit(0)))


def kb_to_mb(kb: Column) -> Column:
    return whole(kb, 1024)


def micros_to_millis(us: Column) -> Column:
    return whole(us, 1000)


def pages_to_kb(pages: Column) -> Column:
    return pages * 8
