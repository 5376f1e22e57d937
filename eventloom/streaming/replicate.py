"""Keeping a published copy up to date from a change stream.

The stream only appends changes, so a micro-batch costs what it brings and never rewrites the
copy. A reader sees snapshot plus changes; `compact` folds the changes into a new snapshot from
time to time, as a versioned copy with tombstones. Applying a change twice, or a change older than
the snapshot's last one for a key, is harmless as long as `sequence` orders the changes of a key; so
changes that a snapshot has taken in can be trimmed, or be left for later.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventloom.operators.publish import SEQUENCE, VERSION, apply_changes, merge_changes, same_keys
from eventloom.sources import versions
from eventloom.streaming.ingest import append

BUCKET = "_bucket"


def collect_changes(feed: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Append the changes of a stream under `path`, exactly once."""
    return append(feed, path, checkpoint, trigger)


def current_copy(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The copy as a reader sees it now."""
    return apply_changes(snapshot, changes, keys)


def compact(snapshot: DataFrame, changes: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """Write the merged, versioned copy as the next snapshot. `path` must not be the one being read.

    Read it with `visible`, or with `current_copy` and the changes that came since.
    """
    merged = merge_changes(snapshot, changes, keys)
    merged.write.mode("overwrite").parquet(path)
    return snapshot.sparkSession.read.schema(merged.schema).parquet(path)


def untaken(changes: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes that a versioned snapshot has not taken in: what is left of the history after trimming."""
    if VERSION not in snapshot.columns:
        return changes
    held = snapshot.select(*keys, VERSION)
    return changes.join(held, same_keys(changes, held, keys) & (changes[SEQUENCE] <= held[VERSION]), "left_anti")


class BucketedCopy:
    """A versioned copy in buckets by the hash of its key: folding changes in writes the buckets they fall into.

    Buckets that no change falls into keep their files, and are not read. The new files of all touched
    buckets become current together (`sources.versions`), so readers see all of a compaction or none.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        """`buckets` is fixed for the life of a copy; a bucket should fit a few tasks, and a row a bucket the driver."""
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    def bucket(self) -> Column:
        """The bucket of a row; null keys have one too."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("long")

    def _write(self, rows: DataFrame) -> None:
        folder = versions.stage(self.spark, self.path)
        rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(folder)
        written = self.spark.read.parquet(folder)
        held = [r[0] for r in written.select(F.col(BUCKET).cast("long")).distinct().collect()] if BUCKET in written.columns else []
        versions.switch(self.spark, self.path, {b: f"{folder}/{BUCKET}={b}" for b in held}, folder)

    def create(self, snapshot: DataFrame, changes: DataFrame) -> None:
        """Write the first copy: `snapshot` with `changes`, which also tell the type of versions, folded in."""
        self._write(merge_changes(snapshot, changes, self.keys))

    def _folders(self, wanted: set[int] | None = None) -> list[str]:
        return [f for b, f in sorted(versions.newest(self.spark, self.path).items()) if wanted is None or b in wanted]

    def read(self) -> DataFrame:
        """The whole versioned copy; see `visible`."""
        return self.spark.read.parquet(*self._folders())

    def compact(self, changes: DataFrame) -> set[int]:
        """Fold `changes` in; returns the buckets they fall into, the only ones that were read and written."""
        touched = {r[0] for r in changes.select(self.bucket()).distinct().collect()}
        if not touched:
            return touched
        folders = self._folders(touched)
        every = self._folders()
        schema = self.spark.read.parquet(every[0]).schema
        held = self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)
        self._write(merge_changes(held, changes, self.keys))
        return touched
