"""Memory reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions.numbers import kb_to_mb
from eventloom.operators.lookup import join_on

# Counter object and counter names.
COUNTER_OBJECT = "SQLServer:Memory Manager"
COUNTERS = (
    "Memory Grants Pending",
    "Memory Grants Outstanding",
    "Target Server Memory (KB)",
    "Total Server Memory (KB)",
    "Stolen Server Memory (KB)",
)


def top_memory_clerks(clerks: DataFrame, n: int = 5) -> DataFrame:
    """The clerk types with most memory; equal sizes are ordered by name."""
    sizes = clerks.groupBy(F.col("type").alias("ClerkType")).agg(F.sum("pages_kb").alias("kb"))
    top = sizes.orderBy(F.desc("kb"), "ClerkType").limit(n)
    return top.select("ClerkType", kb_to_mb(F.col("kb")).alias("SizeMb"))


def pending_memory_grants(state: Mapping[str, DataFrame]) -> DataFrame:
    """Requested and granted memory per session; granted is NULL while waiting."""
    texts = state["sql_text"].select("sql_handle", "text")
    rows = join_on(state["memory_grants"], texts, {"sql_handle": "sql_handle"}, "inner")
    return rows.select(
        "session_id",
        kb_to_mb(F.col("requested_memory_kb")).alias("RequestedMemMb"),
        kb_to_mb(F.col("granted_memory_kb")).alias("GrantedMemMb"),
        "text",
    )


def memory_counters(counters: DataFrame) -> DataFrame:
    rows = counters.where(
        tx.same(F.col("object_name"), COUNTER_OBJECT) & tx.one_of(F.col("counter_name"), COUNTERS)
    )
    return rows.select("counter_name", "cntr_value")


def memory_pressure(counters: DataFrame) -> DataFrame:
    """The counters read together.

    `below_target` is set when the server holds less than it aims for, `grants_waiting` when
    grants are both outstanding and pending.
    """
    rows = memory_counters(counters)

    def total(name: str):
        return F.coalesce(F.sum(F.when(tx.same(F.col("counter_name"), name), F.col("cntr_value"))), F.lit(0))

    pending, outstanding, target, held, stolen = COUNTERS
    sums = rows.agg(
        total(pending).alias("grants_pending"),
        total(outstanding).alias("grants_outstanding"),
        total(target).alias("target_kb"),
        total(held).alias("total_kb"),
        total(stolen).alias("stolen_kb"),
    )
    return sums.select(
        "*",
        (F.col("total_kb") != F.col("target_kb")).alias("below_target"),
        ((F.col("grants_pending") != 0) & (F.col("grants_outstanding") != 0)).alias("grants_waiting"),
    )
