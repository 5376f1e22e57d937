"""Where a capture session writes its files, from the server's session tables."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.paths import folder_of
from eventloom.functions.text import same
from eventloom.operators.lookup import join_on
from eventloom.sources.events import read_events

#: Captures whose names become a predicate of a scan; more are joined with the names of its files.
MOST_FILES = 10_000
# A rollover number and a time of creation stand between a capture's name and its extension.
_ROLLOVER = re.compile(r"(?:_\d+)*\.[^.\\/]*$")


def capture_files(sessions: DataFrame, targets: DataFrame, session: str, pattern: str) -> DataFrame:
    """File, folder and search pattern of the file targets of matching sessions.

    `session` is a name, or a LIKE pattern when it holds a `%`. The path is read from the target
    description, which the server writes and is well-formed; a target without a file gives NULL.
    """
    named = F.rtrim("name").ilike(session) if "%" in session else same(F.col("name"), session)
    matching = sessions.where(named).select("address", "name")
    files = targets.where(same(F.col("target_name"), "event_file")).select(
        "event_session_address",
        F.get(F.xpath("target_data", F.lit("EventFileTarget/File/@name")), F.lit(0)).alias("target_file"),
    )
    rows = join_on(files, matching, {"event_session_address": "address"}, "inner")
    folder = folder_of(F.col("target_file"))
    return rows.select(
        F.col("name").alias("session_name"),
        "target_file",
        folder.alias("folder"),
        F.concat(folder, F.lit(pattern)).alias("search_pattern"),
    )


def stem(target_file: str) -> str:
    """What all files of a capture begin with: its file name without rollover numbers and extension."""
    return _ROLLOVER.sub("", re.split(r"[\\/]", target_file)[-1])


def _stem(target_file: Column) -> Column:
    """The same in lower case, of a column."""
    return F.lower(F.regexp_replace(F.regexp_extract(target_file, r"(?s)([^\\/]*)$", 1), _ROLLOVER.pattern, ""))


def _files_of(spark: SparkSession, path: str, stems: DataFrame) -> DataFrame:
    """file_path of the files under `path` that `of_captures` would pick for `stems(stem)`; no file is opened.

    A file is of every capture whose name its own, or its folder's, begins with, if nothing but rollover
    numbers and an extension follows.
    """
    paths = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("file_path"))
    named = paths.select("file_path", F.explode(F.slice(F.reverse(F.split(F.lower("file_path"), "/")), 1, 2)).alias("name"))
    cut = named.select("file_path", "name", F.explode(F.sequence(F.lit(0), F.length("name"))).alias("n"))
    rest = F.substr("name", F.col("n") + 1)
    begins = cut.where(rest.rlike(r"^(?:_\d+)*(?:\.[^/]*)?$")).select("file_path", F.left("name", F.col("n")).alias("stem"))
    return begins.join(stems, "stem", "left_semi").select("file_path").distinct()


def of_captures(stems: Iterable[str]) -> Column:
    """Whether a scanned file is of one of some captures, by its own name or that of the folder it lies in.

    A predicate on file metadata alone. Names are compared without case, as the server's file system
    does. A capture's name may begin with another's: what follows it has to be rollover numbers and an
    extension.
    """
    named = "|".join(sorted({re.escape(s.lower()) for s in stems})) or "(?!)"
    return F.lower(F.col("_metadata.file_path")).rlike(rf"/(?:{named})(?:_\d+)*(?:\.[^/]*)?(?:/[^/]*)?$")


def read_captures(spark: SparkSession, path: str, files: DataFrame, fmt: str = "parquet", most: int = MOST_FILES) -> DataFrame:
    """The raw layer of the exported files under `path` that belong to the captures in `files(target_file)`.

    `files` is what `capture_files` finds, a row a session. The names become a predicate on file
    metadata: the scan lists the folder and opens no other file. Sessions often share a name; more than
    `most` different ones are joined with the names of the files instead.
    """
    stems = files.where("target_file IS NOT NULL").select(_stem(F.col("target_file")).alias("stem")).distinct()
    found = stems.limit(most + 1).collect()
    if len(found) <= most:
        return read_events(spark, path, fmt, only=of_captures(r.stem for r in found))
    events = read_events(spark, path, fmt)
    return events.join(_files_of(spark, path, stems), events["file_name"] == F.col("file_path"), "left_semi")
