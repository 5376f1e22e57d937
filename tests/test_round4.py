"""Findings of the fourth review: what is shuffled, written and sent to the driver."""

import gzip
import re

import pytest
from pyspark.sql import functions as F

from catalogue.flow_queries import cluster_documents, stored_log
from eventloom.llm import ann
from eventloom.plans import sessions
from eventloom.sources.events import END, read_event_documents
from eventloom.sources.tables import save_tables
from eventloom.tables.health_log import LEASE_EXPIRED, REPLICA_STATE
from tests.helpers import data, event, raw, ring


def test_a_derived_log_is_stored_by_the_tasks_that_make_it(spark):
    """F8: every text of the raw layer was shuffled."""
    stored = stored_log(spark, raw(spark, *[("a", event("a", "")) for _ in range(8)]).repartition(4))
    assert stored.count() == 8 and stored.select(F.input_file_name()).distinct().count() == 4


def test_only_events_that_tables_take_are_parsed(spark, tmp_path):
    """a family of two tables parsed and stored every record of the log."""
    state = event(REPLICA_STATE.event, data("availability_group_name", "g"))
    events = raw(spark, (REPLICA_STATE.event, state), (LEASE_EXPIRED.event, event(LEASE_EXPIRED.event, "")), (None, state), ("other", event("other", "")), (LEASE_EXPIRED.event, "<event"))
    made = save_tables(events, [REPLICA_STATE, LEASE_EXPIRED], str(tmp_path))
    assert [made[s.table].count() for s in (REPLICA_STATE, LEASE_EXPIRED)] == [1, 1]
    names = [r.object_name for r in spark.read.parquet(f"{tmp_path}/parsed").select("object_name").collect()]
    assert sorted(names) == sorted([REPLICA_STATE.event, LEASE_EXPIRED.event, LEASE_EXPIRED.event])


def test_documents_of_a_derived_log_are_compressed(spark, sf_dir):
    """the log's text, many times the tables, was written as it is."""
    path = cluster_documents(spark, sf_dir)
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "length").collect()
    text = spark.read.option("lineSep", END).text(path).agg(F.sum(F.octet_length("value"))).first()[0]
    assert all(f.path.endswith(".gz") for f in files) and 5 * sum(f.length for f in files) < text


def test_text_before_the_end_may_be_as_long_as_a_compressed_file(spark, tmp_path):
    """A record that ends where a compressed file's length says lost its end tag."""
    dump = event("c", data("d", ring(event("x", data("n", "1")), event("x", ""))))
    for pad in range(2_000):
        records = [event("a", data("m", "x" * pad)), *[event("a", data("n", str(i))) for i in range(40)], dump]
        text = f"<events>{''.join(records)}</events>\n"
        packed = gzip.compress(text.encode(), mtime=0)
        if text[: len(packed)].endswith("</data>") and text[len(packed) :].startswith(END):
            break
    (tmp_path / "a.xml.gz").write_bytes(packed)
    assert text[len(packed) :].startswith(END)
    found = read_event_documents(spark, str(tmp_path)).orderBy("file_offset").collect()
    assert [r.event_data for r in found] == records and len({r.file_offset for r in found}) == 42


def test_queries_of_an_index_are_not_broadcast_beside_each_list(spark, monkeypatch):
    """Spark took the pairs of queries and lists, made by tasks out of few rows, for small and sent them through the driver."""
    rows = spark.range(0, 900).selectExpr("id AS vec_id", "array(CAST(id % 7 + 1 AS FLOAT), CAST(id AS FLOAT), CAST(id * id % 31 AS FLOAT)) AS v")
    index = ann.Index(rows, 4, lists_of=32)
    queries = rows.where("vec_id % 9 = 0").selectExpr("vec_id AS query", "v")
    made = index.search(queries, 4)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    whole = {tuple(r) for r in made.collect()}
    monkeypatch.setattr(ann, "PASS", 30)  # the same in several passes, some of which hold few queries
    assert {tuple(r) for r in index.search(queries, 4).collect()} == whole and len({q for q, *_ in whole}) == 100
    assert index.search(queries.limit(0), 4).count() == 0


@pytest.fixture
def busy(spark):
    """Requests of few plans, with ties, NULL keys, a repeated plan, text and name, a handle without a plan and one without a text."""
    return {
        "exec_requests": spark.range(600).selectExpr("CAST(id % 20 AS INT) AS session_id", "'run' AS status", "CAST(id % 3 AS INT) AS database_id", "IF(id % 50 = 7, NULL, id * 37 % 101) AS cpu_time", "IF(id % 60 = 9, NULL, concat('p', id % 4)) AS plan_handle", "concat('s', id % 9) AS sql_handle", "id AS logical_reads", "'w' AS wait_type", "1L AS wait_time", "'r' AS wait_resource", "0 AS blocking_session_id", "5 AS granted_query_memory", "id * 1000 AS total_elapsed_time", "0 AS statement_start_offset", "-1 AS statement_end_offset"),
        "exec_sessions": spark.range(18).selectExpr("CAST(id AS INT) AS session_id", "concat('u', id) AS login_name"),
        "sql_text": spark.range(9).selectExpr("concat('s', IF(id = 8, 7, id)) AS sql_handle", "concat('text ', id) AS text", "IF(id = 2, NULL, CAST(id AS INT)) AS objectid"),
        "objects": spark.sql("SELECT 1 AS object_id, 0 AS database_id, 'a' AS name UNION ALL SELECT 1, 0, 'b' UNION ALL SELECT 3, 1, 'c' UNION ALL SELECT NULL, 1, 'n' UNION ALL SELECT 4, NULL, 'o'"),
        "batch_plan": spark.sql("SELECT 'p0' AS plan_handle, 'x' AS query_plan UNION ALL SELECT 'p0', 'y' UNION ALL SELECT 'p1', NULL UNION ALL SELECT 'p2', 'z' UNION ALL SELECT NULL, 'none' UNION ALL SELECT 'unused', 'u'"),
    }


@pytest.mark.parametrize("report", [sessions.running_requests_by_cpu, sessions.running_requests_elapsed])
def test_ordered_reports_hold_the_rows_of_plain_joins(spark, busy, report):
    got = [tuple(r) for r in report(busy, self_session_id=5).collect()]
    key = [r[2] for r in got]
    assert key == sorted((k for k in key if k is not None), reverse=True) + [None] * key.count(None) and None in key
    r, t, p = sessions._with_session(busy, 5), busy["sql_text"], busy["batch_plan"]
    plain = r.join(t, "sql_handle").join(p, "plan_handle", "inner" if report is sessions.running_requests_by_cpu else "left")
    if report is sessions.running_requests_by_cpu:
        o = busy["objects"]
        plain = plain.join(o, (plain.objectid == o.object_id) & (plain.database_id == o.database_id), "left")
        names, at = ("logical_reads", "name", "login_name", "query_plan", "text"), (3, 5, 11, 12, 13)
    else:
        names, at = ("logical_reads", "text", "login_name", "query_plan"), (4, 5, 7, 8)
    assert sorted(tuple(str(row[i]) for i in at) for row in got) == sorted(tuple(map(str, row)) for row in plain.select(*names).collect())
    assert sorted(map(str, got)) == sorted(str(tuple(x)) for x in report(busy, self_session_id=5, ordered=False).collect())


def test_a_plan_travels_once_for_a_slice_of_the_order(spark, busy):
    """every request took its plan's text through the sort."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        state = {**busy, "batch_plan": busy["batch_plan"].selectExpr("plan_handle", "repeat(query_plan, 50000) AS query_plan")}
        made = sessions.running_requests_elapsed(state)
        plan = made._jdf.queryExecution().executedPlan()
        lines = plan.toString().splitlines()
        above = next(i for i, line in enumerate(lines) if "Exchange rangepartitioning(slice" in line)
        assert not [line for line in lines[:above] if "Exchange" in line or "Join" in line]  # the order needs no other shuffle
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
