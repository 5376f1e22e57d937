"""Folder and file-name expressions for capture files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\\"


def as_folder(path: Column) -> Column:
    """`path` with a closing separator."""
    return F.when(F.endswith(path, F.lit(SEPARATOR)), path).otherwise(F.concat(path, F.lit(SEPARATOR)))


def folder_of(path: Column) -> Column:
    """The directory part of a file path, with its closing separator."""
    return F.regexp_replace(path, r"[^\\]*$", "")


def pattern_in(folder: Column, pattern: str) -> Column:
    return F.concat(as_folder(folder), F.lit(pattern))
