import datetime as dt

from pyspark.sql import functions as F

from eventloom.plans import cluster_diagnostics as cd
from eventloom.plans import health_log, memory, procedures, replication, sessions, waits

T0 = dt.datetime(2020, 1, 1)


def test_error_stats_count_known_unknown_and_missing_numbers(spark):
    errors = spark.createDataFrame(
        [(1480, T0), (1480, T0 + dt.timedelta(days=1)), (5, T0), (6, T0), (None, T0), (None, T0)],
        "error_number int, TimeStampUTC timestamp_ntz",
    )
    messages = spark.createDataFrame(
        [(5, 1033, "x" * 100), (5, 1031, "deutsch"), (6, 1031, "deutsch"), (1480, 1033, "catalogue text")],
        "message_id int, language_id int, text string",
    )
    rows = {r.ErrorNum: r for r in health_log.error_event_stats(errors, messages).collect()}
    assert len(rows) == 4
    assert (rows[1480].ErrorCount, rows[1480].FirstDate) == (2, "2020-01-01 00:00:00.000")
    assert rows[1480].LastDate == "2020-01-02 00:00:00.000"
    assert rows[1480]["Abbreviated Message"] == health_log.KNOWN_ERRORS[1480][:81]
    assert rows[5]["Abbreviated Message"] == "x" * 81
    assert rows[6]["Abbreviated Message"] is None
    assert rows[None].ErrorCount == 0


def test_ddl_reports_split_statements(spark):
    stmts = {
        1: "alter availability group g failover",
        2: "CREATE availability group g with (failover_mode = automatic)",
        3: "ALTER availability group g FORCE_something",
        4: "drop availability group g",
        5: None,
        6: "x; create y failover",
    }
    ddl = spark.createDataFrame(
        [(T0, i, "C", s) for i, s in stmts.items()],
        "TimeStampUTC timestamp_ntz, ddl_phase int, ddl_phase_desc string, statement string",
    )

    def ids(df):
        return sorted(int(r.ddl_phase) for r in df.collect())

    assert ids(health_log.non_failover_ddl(ddl)) == [2, 3, 4, 6]
    assert ids(health_log.failover_ddl(ddl)) == [1, 3, 6]
    assert ids(health_log.failover_ddl(ddl, exclude="%CREATE%")) == [1, 3]


def test_event_summary_is_zero_filled_and_closed(spark):
    raw = spark.createDataFrame([("a",), ("a",), ("z",)], "object_name string")
    seed = spark.createDataFrame([("a",), ("b",)], "XEvent string")
    assert [tuple(r) for r in health_log.event_summary(raw, seed).collect()] == [("a", 2), ("b", 0)]
    assert len(health_log.known_event_names(11)) == 7 and len(health_log.known_event_names(12)) == 9


def test_wait_stats_orders(spark):
    rows = [(1, "A", 5, 1), (1, "A", 5, 1), (1, "B", 90, 2), (None, "A", 1, 0), (1, None, 7, 7)]
    w = spark.createDataFrame(rows, "Session_ID int, WaitType string, Duration bigint, Signal_Duration bigint")
    by_count = [tuple(r) for r in waits.wait_stats_by_count(w).collect()]
    assert by_count == [(None, "A", 1, 1, 0), (1, "A", 2, 10, 2), (1, "B", 1, 90, 2), (1, None, 0, 7, 7)]
    assert [r.WaitType for r in waits.wait_stats_by_duration(w).collect()] == ["A", "B", "A", None]


def test_longest_pending_io_keeps_ties_and_drops_unknown(spark):
    io = spark.createDataFrame([(1, 5), (2, 9), (3, 9), (4, None)], "id int, duration int")
    rows = cd.max_pending_io(io).collect()
    assert sorted(r.id for r in rows) == [2, 3] and rows[0].label == "Max duration event:"
    nothing = io.where("duration IS NULL")
    assert cd.max_pending_io(nothing).count() == 0
    assert [tuple(r) for r in cd.pending_io_histogram(io).collect()] == [(5, 1), (9, 2)]


def test_state_comparison_follows_collation(spark):
    c = spark.createDataFrame([("clean",), ("CLEAN ",), ("warning",), (None,)], "State_Desc string").withColumn(
        "TimeStampUTC", F.lit(T0)
    )
    assert [r.State_Desc for r in cd.unhealthy(c).collect()] == ["warning"]


def test_top_states_are_stable(spark):
    states = spark.createDataFrame([(T0, i) for i in range(300)], "TimeStampUTC timestamp_ntz, id int").repartition(7)
    assert [r.id for r in cd.ag_state_top(states, 200).collect()] == list(range(200))


def _requests_state(spark):
    requests = spark.createDataFrame(
        [(51, "c1", 1, "h1", "p1", 10, "DB STARTUP"), (52, "c2", 1, "h1", "p9", 20, "parallel redo task "), (53, "c3", 9, "h9", "p1", 30, "SELECT")],
        "session_id int, connection_id string, database_id int, sql_handle string, plan_handle string, cpu_time bigint, command string",
    ).selectExpr(
        "*", "0 blocking_session_id", "'r' status", "cpu_time*3600000 total_elapsed_time", "cpu_time wait_time", "1L reads", "1L writes",
        "3L logical_reads", "1L row_count", "'W' wait_type", "'R' wait_resource", "4 granted_query_memory",
        "0 statement_start_offset", "-1 statement_end_offset",
    )
    ts = "timestamp_ntz'2020-01-01 00:00:00'"
    return {
        "exec_requests": requests,
        "exec_connections": spark.range(1, 4).selectExpr(
            "'c' || id connection_id", "int(50 + id) session_id", "'ip' client_net_address", f"{ts} connect_time", f"{ts} last_read", f"{ts} last_write"
        ),
        "exec_sessions": spark.range(1, 4).selectExpr(
            "int(50 + id) session_id", f"{ts} login_time", "'me' login_name", "'h' host_name", "'d' nt_domain", "'u' nt_user_name",
            "'s' status", "'p' program_name", "'c' client_interface_name", f"{ts} last_request_start_time", f"{ts} last_request_end_time",
        ),
        "databases": spark.createDataFrame([(1, "db1")], "database_id int, name string"),
        "objects": spark.createDataFrame([(7, 1, "usp")], "object_id int, database_id int, name string"),
        "memory_grants": spark.range(1, 4).selectExpr(
            "int(50 + id) session_id", "1 dop", f"{ts} request_time", f"{ts} grant_time", "2047L requested_memory_kb", "cast(null as bigint) granted_memory_kb",
            "1023L required_memory_kb", "1024L max_used_memory_kb", "1.0D query_cost", "5 timeout_sec", "1 resource_semaphore_id", "9L wait_time_ms",
            "case id when 1 then 1 when 2 then 0 end is_next_candidate", "'h1' sql_handle",
        ),
        "resource_semaphores": spark.range(0, 2).selectExpr(
            "1 resource_semaphore_id", "2048L target_memory_kb", "1L max_target_memory_kb", "1L total_memory_kb", "1L available_memory_kb",
            "1L granted_memory_kb", "1L used_memory_kb", "1 grantee_count", "1 waiter_count", "1 timeout_error_count", "1 forced_grant_count",
        ),
        "sql_text": spark.createDataFrame([("h1", " select\n1 ", 1, 7)], "sql_handle string, text string, dbid int, objectid int"),
        "batch_plan": spark.createDataFrame([("p1", "<plan/>")], "plan_handle string, query_plan string"),
    }


def test_memory_grant_requests(spark):
    state = _requests_state(spark)
    rows = sessions.memory_grant_requests(state).collect()
    # Two semaphores share an id, so each request appears twice; request 53 has no database.
    assert [r.session_id for r in rows] == [52, 52, 51, 51]
    first = rows[-1].asDict()
    assert len(first) == 50 and first["runtime"] is None and first["text"] == "select 1"
    assert (first["requested_memory_mb"], first["granted_memory_mb"], first["required_memory_mb"]) == (1, None, 0)
    assert first["Next Candidate for Memory Grant"] == "Yes"
    assert {r.session_id for r in sessions.memory_grant_requests(state, self_session_id=51).collect()} == {52}


def test_running_requests(spark):
    state = _requests_state(spark)
    (row,) = sessions.running_requests_by_cpu(state).collect()
    assert (row.session_id, row.StatementText, row.StoredProcedureName, row.buffer) == (51, " select\n1 ", "usp", 4)
    rows = sessions.running_requests_elapsed(state).collect()
    assert [(r.session_id, r.Elapsed, r.buffer, r.InFlightPlan) for r in rows] == [
        (52, "20:00:00", 24, None),
        (51, "10:00:00", 24, "<plan/>"),
    ]


def test_redo_sessions(spark):
    state = _requests_state(spark)
    rows = sessions.redo_sessions(state, F.lit(T0)).collect()
    assert sorted((r.session_id, r.DBName, r.CollectTime) for r in rows) == [(51, "db1", T0), (52, "db1", T0)]
    assert sessions.redo_session_count(state).first().REDOCount == 2


def test_procedure_stats_rules(spark):
    base = _requests_state(spark)
    stats = spark.createDataFrame(
        [("h1", "p1", 0, -1, 4, T0, T0), ("h1", "p2", 2, 6, 3, T0 - dt.timedelta(minutes=9), T0)],
        "sql_handle string, plan_handle string, statement_start_offset int, statement_end_offset int, execution_count bigint, "
        "creation_time timestamp_ntz, last_execution_time timestamp_ntz",
    )
    for c in ("total", "max", "last"):
        for k in ("elapsed_time", "worker_time"):
            stats = stats.withColumn(f"{c}_{k}", F.lit(12345).cast("bigint"))
    for c in ("total_logical_reads", "max_logical_reads", "last_logical_reads", "total_physical_reads", "max_physical_reads",
              "last_physical_reads", "total_logical_writes", "last_logical_writes"):
        stats = stats.withColumn(c, F.lit(11).cast("bigint"))
    base["query_stats"] = stats
    base["query_plan"] = spark.createDataFrame(
        [("p2", 2, 6, "<p/>")], "plan_handle string, statement_start_offset int, statement_end_offset int, query_plan string"
    )
    rows = procedures.procedure_stats(base, "USP", as_of=F.lit(T0)).orderBy("plan_handle").collect()
    fresh, old = (r.asDict() for r in rows)
    assert fresh["execs_per_minute"] is None and fresh["avg_cpu_per_minute"] is None
    assert float(old["execs_per_minute"]) == 0.333 and float(old["minutes_between_execs"]) == 3.0
    assert float(fresh["avg_elapsed_time (ms)"]) == 3.09 and fresh["max_elapsed_time (ms)"] == 12
    assert fresh["avg_reads"] == 2 and fresh["statement_text"] == " select\n1 " and old["statement_text"] == "sel"
    assert (fresh["statement_plan"], old["statement_plan"]) == (None, "<p/>")
    assert procedures.procedure_stats(base, "other", as_of=F.lit(T0)).count() == 0


def test_memory_reports(spark):
    clerks = spark.createDataFrame([(f"k{i % 7}", 1024 * i) for i in range(14)], "type string, pages_kb bigint")
    assert [tuple(r) for r in memory.top_memory_clerks(clerks).collect()] == [
        ("k6", 19), ("k5", 17), ("k4", 15), ("k3", 13), ("k2", 11),
    ]
    counters = spark.createDataFrame(
        [("SQLServer:Memory Manager", n, v) for n, v in zip(memory.COUNTERS, [1, 2, 300, 200, 5])]
        + [("SQLServer:Memory Manager", "Other", 1), ("Else", memory.COUNTERS[0], 7)],
        "object_name string, counter_name string, cntr_value bigint",
    )
    assert memory.memory_counters(counters).count() == 5
    row = memory.memory_pressure(counters).first()
    assert (row.grants_pending, row.below_target, row.grants_waiting) == (1, True, True)


def test_articles_merge_publications_of_one_name(spark):
    articles = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (3, "c"), (9, "d")], "publication_id int, article string")
    pubs = spark.createDataFrame([(1, "p"), (2, "p"), (3, "q")], "publication_id int, publication string")
    rows = replication.articles_per_publication(articles, pubs).collect()
    assert {r.Publication: r.CountofName for r in rows} == {"p": 2, "q": 1}
