"""Statistics of cached procedure statements."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions.numbers import micros_to_millis, whole
from eventloom.functions.times import minute_boundaries, utc_now
from eventloom.operators.lookup import join_on, name_of

_STATEMENT = ["plan_handle", "statement_start_offset", "statement_end_offset"]


def procedure_stats(
    state: Mapping[str, DataFrame], procedure: str, as_of: Column | None = None, n: int = 50
) -> DataFrame:
    """Rates, averages and last values of the cached statements of one procedure.

    The rows are picked on narrow tables first (the procedure's text handles, then `n` of its
    statements in plan order); batch texts and plans are read for those rows alone.
    """
    now = utc_now() if as_of is None else as_of
    target = state["objects"].where(tx.same(F.col("name"), procedure)).select(
        "object_id", "database_id", F.col("name").alias("sproc")
    )
    handles = join_on(
        state["sql_text"].select("sql_handle", "objectid", "dbid"),
        target,
        {"objectid": "object_id", "dbid": "database_id"},
        "inner",
    ).select("sql_handle", "dbid", "sproc")
    picked = (
        join_on(state["query_stats"], handles, {"sql_handle": "sql_handle"}, "inner")
        .orderBy(*_STATEMENT, "sql_handle")
        .limit(n)
    )
    texts = state["sql_text"].select("sql_handle", "text")
    rows = join_on(picked, texts, {"sql_handle": "sql_handle"}, "inner")
    rows = name_of(rows, state["databases"], {"dbid": "database_id"}, "name", "database_name")
    # Plans are wide: keep those of the picked statements before the outer join moves any.
    plans = state["query_plan"].select(*_STATEMENT, "query_plan")
    plans = join_on(plans, picked.select(*_STATEMENT), {k: k for k in _STATEMENT}, "left_semi")
    rows = join_on(rows, plans, {k: k for k in _STATEMENT}, "left")

    minutes = minute_boundaries(F.col("creation_time"), now)
    runs = F.nullif(F.col("execution_count"), F.lit(0))

    def when_running(rate: Column) -> Column:
        return F.when(minutes != 0, rate)

    def average_ms(total: str) -> Column:
        in_ms = F.col(total).cast("decimal(20,0)") / F.lit(1000).cast("decimal(10,0)")
        return (in_ms / runs.cast("decimal(20,0)")).cast("decimal(32,2)")

    per_minute = when_running((runs.cast("double") / minutes.cast("double")).cast("decimal(10,3)"))
    return rows.select(
        "database_name",
        "sproc",
        "execution_count",
        per_minute.alias("execs_per_minute"),
        when_running((minutes.cast("double") / runs).cast("decimal(12,2)")).alias("minutes_between_execs"),
        average_ms("total_elapsed_time").alias("avg_elapsed_time (ms)"),
        average_ms("total_worker_time").alias("avg_worker_time (ms)"),
        micros_to_millis(F.col("max_elapsed_time")).alias("max_elapsed_time (ms)"),
        micros_to_millis(F.col("max_worker_time")).alias("max_worker_time (ms)"),
        micros_to_millis(F.col("last_worker_time")).alias("last_worker_time (ms)"),
        whole(F.col("total_logical_reads"), runs).alias("avg_reads"),
        whole(F.col("total_physical_reads"), runs).alias("avg_phys_reads"),
        whole(F.col("total_logical_writes"), runs).alias("avg_writes"),
        (average_ms("total_worker_time").cast("decimal(25,2)") * per_minute)
        .cast("decimal(38,5)")
        .alias("avg_cpu_per_minute"),
        "last_execution_time",
        "creation_time",
        tx.statement_slice(
            F.col("text"), F.col("statement_start_offset"), F.col("statement_end_offset"), 10000
        ).alias("statement_text"),
        micros_to_millis(F.col("last_elapsed_time")).alias("last_elapsed_time (ms)"),
        "max_logical_reads",
        "last_logical_reads",
        "max_physical_reads",
        "last_physical_reads",
        "last_logical_writes",
        "plan_handle",
        "sql_handle",
        F.col("query_plan").alias("statement_plan"),
    )


def plan_age(query_stats: DataFrame, plan_costs: DataFrame) -> DataFrame:
    """Cost of compiling a plan times the number of its uses."""
    rows = join_on(query_stats.select("plan_handle", "execution_count"), plan_costs, {"plan_handle": "plan_handle"}, "inner")
    return rows.select(
        "plan_handle",
        "compile_cost",
        "execution_count",
        (F.col("compile_cost") * F.col("execution_count")).alias("plan_age"),
    )


def sql_modules(modules: DataFrame) -> DataFrame:
    """Source text of every module."""
    return modules.select("object_id", "definition")
