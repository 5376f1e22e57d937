"""Publishing a table to a copy: first the snapshot, then the changes.

A change feed has the article's columns plus

    operation   'insert', 'update' or 'delete'
    sequence    the order of the changes of one key (any orderable type, unique per key);
                a change without one has no place in the order and is left out

A copy that changes were merged into is versioned: it keeps the sequence of each row's last change,
and a tombstone for a deleted row, so that a change older than what the copy has seen stays without
effect, however late it comes. NULL is a key like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPERATION, SEQUENCE = "operation", "sequence"
#: Columns of a versioned copy: the sequence of the last change of a row, and whether it deleted it.
VERSION, DELETED = "_sequence", "_deleted"


def article(df: DataFrame, columns: Sequence[str] | None = None, without: Sequence[str] = ()) -> DataFrame:
    """The published columns: all of them, a list, or all but a few."""
    chosen = [c for c in (columns or df.columns) if c not in set(without)]
    return df.select(*chosen)


def publish_snapshot(df: DataFrame, path: str, existing: str = "keep") -> DataFrame:
    """First copy of a table. An existing copy is kept ('keep') or replaced ('drop')."""
    mode = {"keep": "ignore", "drop": "overwrite"}[existing]
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def latest_changes(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last change of every key.

    `max_by` aggregates in the map tasks first, so a key changed a billion times sends one row
    per task over the network.
    """
    rest = [c for c in feed.columns if c not in set(keys)]
    return (
        feed.groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.col(SEQUENCE)).alias("last"))
        .select(*keys, *[F.col(f"last.{c}").alias(c) for c in rest])
    )


def same_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def merge_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The versioned copy after the feed: a change counts if it is newer than the row's version.

    `target` is a first snapshot, older than any change, or a versioned copy. A row stays unless a
    newer change has its key; a change stays unless the copy has its key at the same version or a
    later one. Both are anti-joins with the last changes, one row a key: where Spark measures them
    small it broadcasts them, and the target is neither shuffled nor sorted.
    """
    last = latest_changes(feed.where(F.col(SEQUENCE).isNotNull()), keys)
    last = last.withColumnsRenamed({SEQUENCE: VERSION}).withColumn(DELETED, F.lower(OPERATION).eqNullSafe("delete")).drop(OPERATION)
    if VERSION not in target.columns:
        kind = last.schema[VERSION].dataType
        untouched = target.join(last, same_keys(target, last, keys), "left_anti")
        untouched = untouched.withColumn(VERSION, F.lit(None).cast(kind)).withColumn(DELETED, F.lit(False))
        return untouched.unionByName(last, allowMissingColumns=True).select(*target.columns, VERSION, DELETED)
    newer = target[VERSION].isNull() | (last[VERSION] > target[VERSION])
    untouched = target.join(last, same_keys(target, last, keys) & newer, "left_anti")
    held = target.select(*keys, VERSION)
    seen = held.join(last, same_keys(held, last, keys) & (held[VERSION] >= last[VERSION]), "left_semi").select(*keys).distinct()
    winners = last.join(seen, same_keys(last, seen, keys), "left_anti")
    return untouched.unionByName(winners, allowMissingColumns=True).select(*target.columns)


def visible(copy: DataFrame) -> DataFrame:
    """A versioned copy as a reader sees it: no tombstones, no versions."""
    return copy.where(~F.col(DELETED)).drop(VERSION, DELETED) if VERSION in copy.columns else copy


def apply_changes(target: DataFrame, feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a reader sees after the feed: changed keys take their last change, deleted keys go."""
    return visible(merge_changes(target, feed, keys))


def add_columns(published: DataFrame, changed: DataFrame) -> DataFrame:
    """Rows of a copy and of a source that has gained columns; old rows get NULL there."""
    return published.unionByName(changed, allowMissingColumns=True)
