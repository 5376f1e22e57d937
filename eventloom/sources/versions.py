"""Tables that are replaced, as a whole or by parts, without a moment in which they are damaged.

    <path>/v<number>-<random>/...   content, written under a name that no reader knows yet
    <path>/versions                 a small table: version, part, folder

A writer stages a version, checks it, and makes it current by appending its rows to `versions`: one file
of a row a part, which Spark's commit puts there as a whole. Readers take each part's newest row. A
writer that fails or is lost before that leaves a folder that nobody reads. Writers take turns: of two at
once the later commit wins. Old folders stay for readers that still use them; whoever owns the path
empties it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WHOLE = 0
_SCHEMA = "version long, part long, folder string"


class Rejected(ValueError):
    """A staged version did not pass its check; the current one stays."""


def newest(spark: SparkSession, path: str) -> dict[int, str]:
    """The current folder of every part; none for a table that was never written."""
    try:
        rows = spark.read.schema(_SCHEMA).parquet(f"{path.rstrip('/')}/versions")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return {}
    last = rows.groupBy("part").agg(F.max_by("folder", F.struct("version", "folder")).alias("folder"))
    return {r.part: r.folder for r in last.collect()}  # a row a part


def _last(spark: SparkSession, path: str) -> int:
    return max((int(f.rsplit("/v", 1)[1].split("-")[0]) for f in newest(spark, path).values()), default=0)


def stage(spark: SparkSession, path: str) -> str:
    """A folder for the next version."""
    return f"{path.rstrip('/')}/v{_last(spark, path) + 1:012d}-{uuid.uuid4().hex}"


def switch(spark: SparkSession, path: str, parts: dict[int, str], folder: str) -> None:
    """Make the folders of `parts`, which lie in the staged `folder`, current, all at once."""
    number = int(folder.rsplit("/v", 1)[1].split("-")[0])
    rows = spark.createDataFrame([(number, part, where) for part, where in parts.items()], _SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/versions")


def replace_table(df: DataFrame, path: str, check: Callable[[DataFrame], bool] | None = None, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write `df` as the next version, and make it current if `check` holds for what was written.

    `df` may read the table that it replaces. Where writing fails, or the check does not hold, the
    version before stays current and readable.
    """
    spark = df.sparkSession
    folder = stage(spark, path)
    df.write.partitionBy(*partition_by).parquet(folder)
    if check is not None and not check(spark.read.schema(df.schema).parquet(folder)):
        raise Rejected(f"the version staged for {path} did not pass its check")
    switch(spark, path, {WHOLE: folder}, folder)
    return spark.read.schema(df.schema).parquet(folder)


def current_table(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that `replace_table` writes."""
    return spark.read.parquet(newest(spark, path)[WHOLE])
