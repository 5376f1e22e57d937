"""Bounded samples of labelled rows for training, chosen by a hash of the id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts that a group is chosen in first; ids of a choice that is broadcast at most.
PARTS, MOST_BROADCAST = 256, 100_000


def _order(seed: int) -> list[Column]:
    return [F.xxhash64("doc_id", F.lit(seed)), F.col("doc_id")]


def first_by_hash(rows: DataFrame, n: int, seed: int = 7) -> DataFrame:
    """`n` rows of a narrow table (doc_id, ...) in the order of a hash of the id, ties by id."""
    return rows.orderBy(*_order(seed)).limit(n)


def first_of_each(rows: DataFrame, group: str, n: int, seed: int = 7, parts: int = PARTS) -> DataFrame:
    """`n` rows of each group, chosen likewise.

    A group may hold most of the rows: each of its parts by another hash gives n rows at most, and
    the group's n are chosen from these. No task sorts a whole group.
    """
    part = F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(parts))
    for keys in ([group, "__part"], [group]):
        order = Window.partitionBy(*keys).orderBy(*_order(seed))
        rows = (rows.withColumn("__part", part) if "__part" in keys else rows).withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= n).drop("__n")
    return rows.drop("__part")


def with_texts(docs: DataFrame, chosen: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The texts of a bounded choice of ids, a row for each row of `chosen` whose id `docs` has.

    Of an id's rows one counts, chosen by a hash of its text; where ids do not repeat, which their
    column alone tells, no text is moved for that. `chosen` is a stored table; while it has
    MOST_BROADCAST rows at most it is broadcast, so that no other text is moved either.
    """
    n = chosen.count()
    few = F.broadcast(chosen) if n <= MOST_BROADCAST else chosen
    met = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("binary").alias("text")).join(few, "doc_id")
    if docs.select(docs[doc_id].alias("doc_id")).join(few, "doc_id").groupBy(*chosen.columns).count().where("count > 1").isEmpty():
        return met.select(*chosen.columns, "text")
    by = F.struct(F.col("text").isNull().alias("none"), F.xxhash64("text").alias("hash"))
    return met.groupBy(*chosen.columns).agg(F.min_by("text", by).alias("text"))


def within(rows: DataFrame, size: Column, most: int, seed: int = 7) -> DataFrame:
    """Rows of a sample (doc_id, ...) in the order of the hash while their sizes add up to `most` at most.

    What goes to the driver has this bound however long single texts are. The sums run over the
    narrow sizes of a sample that is bounded already; rows are told apart by place.
    """
    placed = rows.withColumn("__place", F.monotonically_increasing_id()).withColumn("__size", size)
    order = Window.orderBy(*_order(seed), "__place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    small = placed.select("doc_id", "__place", "__size").withColumn("__upto", F.sum("__size").over(order)).where(F.col("__upto") <= most)
    return placed.join(small.select("__place"), "__place", "left_semi").drop("__place", "__size")
