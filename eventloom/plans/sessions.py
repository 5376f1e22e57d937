"""Reports over running requests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions.numbers import kb_to_mb, pages_to_kb
from eventloom.functions.times import elapsed_clock, iso_text, utc_now
from eventloom.operators.lookup import in_order, join_on, name_of

State = Mapping[str, DataFrame]

# Commands that mark a request as redo work.
REDO_COMMANDS = ("DB Startup", "PARALLEL REDO HELP TASK", "PARALLEL REDO TASK")


def _others(df: DataFrame, self_session_id: int | None) -> DataFrame:
    """Leave out the session that asks."""
    return df if self_session_id is None else df.where(F.col("session_id") != self_session_id)


def _prefixed(df: DataFrame, prefix: str, *keep: str) -> DataFrame:
    """`keep` as they are, everything else under `prefix`."""
    return df.select(*[F.col(c) if c in keep else F.col(c).alias(prefix + c) for c in df.columns])


def memory_grant_requests(
    state: State, self_session_id: int | None = None, runtime: Column | None = None, ordered: bool = True
) -> DataFrame:
    """Running requests that hold or wait for a memory grant, with session, connection, grant
    and semaphore attributes. Memory is in whole megabytes."""
    r = _others(state["exec_requests"], self_session_id)
    c = state["exec_connections"].select(
        "connection_id",
        F.col("session_id").alias("owner_session_id"),
        "client_net_address",
        "connect_time",
        "last_read",
        "last_write",
    )
    s = state["exec_sessions"].select(
        F.col("session_id").alias("s_session_id"),
        "login_time",
        "login_name",
        "host_name",
        "nt_domain",
        "nt_user_name",
        F.col("status").alias("session_status"),
        "program_name",
        "client_interface_name",
        "last_request_start_time",
        "last_request_end_time",
    )
    d = state["databases"].select("database_id", "name")
    mg = _prefixed(state["memory_grants"], "mg_")
    rs = _prefixed(state["resource_semaphores"], "rs_")
    # Only the part of a text that is shown travels through the shuffle.
    q = state["sql_text"].select("sql_handle", tx.one_line(F.col("text")).alias("text"))

    rows = join_on(r, c, {"connection_id": "connection_id"}, "inner")
    rows = join_on(rows, s, {"owner_session_id": "s_session_id"}, "inner")
    rows = join_on(rows, d, {"database_id": "database_id"}, "inner")
    rows = join_on(rows, mg, {"owner_session_id": "mg_session_id"}, "inner")
    rows = rows.join(rs, F.col("mg_resource_semaphore_id") == F.col("rs_resource_semaphore_id"), "inner")
    rows = join_on(rows, q, {"sql_handle": "sql_handle"}, "inner")

    candidate = (
        F.when(F.col("mg_is_next_candidate") == 1, "Yes")
        .when(F.col("mg_is_next_candidate") == 0, "No")
        .otherwise("Memory has been granted")
    )
    as_is = F.lit(None).cast("string") if runtime is None else iso_text(runtime)
    out = rows.select(
        as_is.alias("runtime"),
        "session_id",
        "blocking_session_id",
        "cpu_time",
        "total_elapsed_time",
        "reads",
        "writes",
        "logical_reads",
        "row_count",
        "wait_time",
        "wait_type",
        "command",
        "text",
        "login_time",
        "name",
        "login_name",
        "host_name",
        "nt_domain",
        "nt_user_name",
        F.col("session_status").alias("status"),
        "client_net_address",
        "program_name",
        "client_interface_name",
        "last_request_start_time",
        "last_request_end_time",
        "connect_time",
        "last_read",
        "last_write",
        F.col("mg_dop").alias("dop"),
        F.col("mg_request_time").alias("request_time"),
        F.col("mg_grant_time").alias("grant_time"),
        *[
            kb_to_mb(F.col(f"mg_{k}_memory_kb")).alias(f"{k}_memory_mb")
            for k in ("requested", "granted", "required", "max_used")
        ],
        F.col("mg_query_cost").alias("query_cost"),
        F.col("mg_timeout_sec").alias("timeout_sec"),
        F.col("mg_resource_semaphore_id").alias("resource_semaphore_id"),
        F.col("mg_wait_time_ms").alias("wait_time_ms"),
        candidate.alias("Next Candidate for Memory Grant"),
        *[
            kb_to_mb(F.col(f"rs_{k}_memory_kb")).alias(f"server_{k}_memory_mb")
            for k in ("target", "max_target", "total", "available", "granted", "used")
        ],
        *[
            F.col(f"rs_{k}").alias(k)
            for k in ("grantee_count", "waiter_count", "timeout_error_count", "forced_grant_count")
        ],
    )
    return in_order(out, ordered, F.desc("wait_time"))


def _with_session(state: State, self_session_id: int | None) -> DataFrame:
    sessions = state["exec_sessions"].select("session_id", "login_name")
    return join_on(_others(state["exec_requests"], self_session_id), sessions, {"session_id": "session_id"}, "inner")


def _statement() -> Column:
    return tx.statement_slice(F.col("text"), F.col("statement_start_offset"), F.col("statement_end_offset"))


def _plans(state: State) -> DataFrame:
    """Whole-batch plans that requests run, one per handle: few plans serve many requests, and are then measured small."""
    plans = state["batch_plan"].select("plan_handle", "query_plan")
    return plans.join(state["exec_requests"].select("plan_handle").distinct(), "plan_handle", "left_semi")


#: Slices of a report's order, a power of two. A plan travels once for every slice it is shown in.
SLICES = 1024


def _sliced(df: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """`slice` added: 0 for the largest values of `key`, SLICES - 1 for the smallest and NULL.

    Cuts are the requests' approximate quantiles, a scalar subquery; a row finds its place by halving.
    """
    cuts = requests.agg(F.percentile_approx(key, [i / SLICES for i in range(1, SLICES)])).scalar()
    steps = [F.lit(SLICES >> i) for i in range(1, SLICES.bit_length())]

    def further(at: Column, step: Column) -> Column:
        return F.when(F.get("cuts", at + step - 1) <= F.col(key), at + step).otherwise(at)

    place = F.lit(SLICES - 1) - F.aggregate(F.array(*steps), F.lit(0), further)
    return df.withColumn("cuts", cuts).withColumn("slice", place).drop("cuts")


def _ordered_with_plans(rows: DataFrame, requests: DataFrame, plans: DataFrame, key: str, how: str) -> DataFrame:
    """`rows` with `query_plan` joined on `plan_handle`, by `key` downwards.

    A join in front of the sort would send a plan through it with every request that runs it. Instead
    rows and plans are dealt out by slices of the order, a plan once to each slice, and meet there.
    """
    dealt = _sliced(rows, requests, key).select("slice", "plan_handle", F.struct(*rows.columns).alias("row"))
    shown = _sliced(requests, requests, key).select("slice", "plan_handle").distinct()
    kept = plans.groupBy("plan_handle").agg(F.collect_list(F.struct("query_plan")).alias("plans"))
    shown = join_on(shown, kept, {"plan_handle": "plan_handle"}, "inner").select("slice", "plan_handle", "plans")
    both = dealt.unionByName(shown, allowMissingColumns=True).repartitionByRange("slice")
    met = both.groupBy("slice", "plan_handle").agg(F.collect_list("row").alias("rows"), F.first("plans", ignorenulls=True).alias("plans"))
    each = met.select("slice", "plans", F.explode("rows").alias("row"))
    each = each.select("slice", "row.*", (F.explode if how == "inner" else F.explode_outer)("plans").alias("plan"))
    return each.orderBy("slice", F.desc(key)).select(*rows.columns, "plan.query_plan")


def _with_plans(state: State, rows: DataFrame, self_session_id: int | None, how: str, ordered: bool) -> DataFrame:
    plans = _plans(state)
    if ordered:
        return _ordered_with_plans(rows, _others(state["exec_requests"], self_session_id), plans, "cpu_time", how)
    return join_on(rows, plans, {"plan_handle": "plan_handle"}, how)


def running_requests_by_cpu(state: State, self_session_id: int | None = None, ordered: bool = True) -> DataFrame:
    """Running requests with waits and grant pages; requests without text or plan are left out."""
    # Requests are narrow until their texts come, which then travel once, in the report's order. Names are looked up
    # by text, and those of the request's database chosen behind the join.
    rows = join_on(_with_session(state, self_session_id), _plans(state).select("plan_handle"), {"plan_handle": "plan_handle"}, "left_semi")
    objects = state["objects"].where(F.col("object_id").isNotNull())
    names = objects.groupBy("object_id").agg(F.collect_list(F.struct(F.col("database_id").alias("of"), F.col("name").alias("StoredProcedureName"))).alias("names"))
    texts = join_on(state["sql_text"].select("sql_handle", "text", "objectid"), names, {"objectid": "object_id"}, "left")
    rows = join_on(rows, texts.drop("objectid"), {"sql_handle": "sql_handle"}, "inner")
    own = F.filter("names", lambda n: n["of"] == F.col("database_id"))
    rows = rows.select(*[c for c in rows.columns if c != "names"], F.explode_outer(own).alias("name")).select("*", "name.StoredProcedureName").drop("name")
    rows = _with_plans(state, rows, self_session_id, "inner", ordered)
    return rows.select(
        "session_id",
        "status",
        "cpu_time",
        "logical_reads",
        _statement().alias("StatementText"),
        "StoredProcedureName",
        "wait_type",
        "wait_time",
        "wait_resource",
        "blocking_session_id",
        F.col("granted_query_memory").alias("buffer"),
        "login_name",
        "query_plan",
        F.col("text").alias("FullSQLText"),
    )


def running_requests_elapsed(state: State, self_session_id: int | None = None, ordered: bool = True) -> DataFrame:
    """Running requests with their elapsed time; the plan is shown where there is one."""
    rows = _with_session(state, self_session_id)
    rows = join_on(rows, state["sql_text"].select("sql_handle", "text"), {"sql_handle": "sql_handle"}, "inner")
    # Only the statement travels on, not the batch it is cut from.
    rows = rows.select("session_id", "status", "cpu_time", "total_elapsed_time", "logical_reads", _statement().alias("statement"), "login_name", "plan_handle")
    rows = _with_plans(state, rows, self_session_id, "left", ordered)
    return rows.select(
        "session_id",
        "status",
        "cpu_time",
        elapsed_clock(F.col("total_elapsed_time")).alias("Elapsed"),
        F.col("logical_reads").alias("LogicalReads"),
        "statement",
        pages_to_kb(F.col("logical_reads")).alias("buffer"),
        "login_name",
        F.col("query_plan").alias("InFlightPlan"),
    )


def redo_requests(state: State) -> DataFrame:
    return state["exec_requests"].where(tx.one_of(F.col("command"), REDO_COMMANDS))


def redo_sessions(state: State, collect_time: Column | None = None) -> DataFrame:
    """Requests doing redo work, with database name and time of collection."""
    rows = redo_requests(state).select("session_id", "database_id")
    rows = name_of(rows, state["databases"], {"database_id": "database_id"}, "name", "DBName")
    when = utc_now() if collect_time is None else collect_time
    return rows.select("session_id", "database_id", "DBName", when.alias("CollectTime"))


def redo_session_count(state: State) -> DataFrame:
    """How many redo requests there are; a capture with none finds nothing."""
    return redo_requests(state).agg(F.count("session_id").alias("REDOCount"))
