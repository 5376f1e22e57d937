"""Text rules of the reports: comparison, trimming, slicing, shortening."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.numbers import whole

NEWLINE = "\n"


def same(col: Column, literal: str) -> Column:
    """Equality on user data: case-insensitive, trailing blanks ignored."""
    return F.lower(F.rtrim(col)) == literal.rstrip(" ").lower()


def one_of(col: Column, literals: list[str] | tuple[str, ...]) -> Column:
    """`same` against a list."""
    return F.lower(F.rtrim(col)).isin([x.rstrip(" ").lower() for x in literals])


def length_without_trailing_blanks(col: Column) -> Column:
    return F.length(F.rtrim(col))


def utf16_bytes(col: Column) -> Column:
    """Storage size of a text in a two-byte encoding."""
    return F.octet_length(F.encode(col, "UTF-16LE"))


def one_line(col: Column, width: int = 1000) -> Column:
    """The first `width` characters with line breaks turned into blanks, trimmed."""
    return F.trim(F.translate(F.substring(col, 1, width), "\n\r", "  "))


def statement_slice(text: Column, start: Column, end: Column, width: int | None = None) -> Column:
    """The statement inside a batch, from two-byte offsets; `end` = -1 runs to the end.

    Offsets count UTF-16 units. A text of the basic plane is cut by characters; with supplementary
    characters the units themselves are cut, and half of a pair at either edge is dropped.
    """
    first = whole(start, 2) + 1
    stop = F.when(end == -1, utf16_bytes(text)).otherwise(end)
    count = F.greatest(whole(stop - start, 2) + 1, F.lit(0))
    plain = F.substr(text, first.cast("int"), count.cast("int"))
    units = F.encode(text, "UTF-16BE")
    from_unit = F.greatest(first, F.lit(1))
    left = F.greatest(F.least(first + count, whole(utf16_bytes(text), 2) + 1) - from_unit, F.lit(0))
    hexed = F.hex(F.substring(units, (2 * from_unit - 1).cast("int"), (2 * left).cast("int")))
    halves = F.when(F.substring(hexed, 1, 4).rlike("^D[C-F]"), F.substring(hexed, 5, 1 << 30)).otherwise(hexed)
    halves = F.when(F.right(halves, F.lit(4)).rlike("^D[89AB]"), F.left(halves, F.length(halves) - 4)).otherwise(halves)
    out = F.when(F.length(text) * 2 == utf16_bytes(text), plain).otherwise(F.decode(F.unhex(halves), "UTF-16BE"))
    return F.left(out, F.lit(width)) if width else out


def shorten_statement(stmt: Column) -> Column:
    """Long statements keep 1155 characters and their line breaks, short ones become one line."""
    long_form = F.concat(F.left(stmt, F.lit(1155)), F.lit(NEWLINE))
    short_form = F.left(F.replace(stmt, F.lit(NEWLINE), F.lit("")), F.lit(220))
    return F.when(length_without_trailing_blanks(stmt) > 220, long_form).otherwise(short_form)


def shorten_failover_statement(stmt: Column) -> Column:
    return F.left(F.replace(stmt, F.lit(NEWLINE), F.lit("")), F.lit(80))


def two_digits(n: Column) -> Column:
    """The last two digits; 100 hours and more therefore wrap."""
    return F.right(F.concat(F.lit("00"), n.cast("string")), F.lit(2))
