"""Findings of the third review: tasks, files and shuffles that do not grow past their bounds."""

import os

import pytest
from pyspark.sql import functions as F

from catalogue import logs
from catalogue.flow_queries import EXPORTED, export
from eventloom.llm import ann
from eventloom.plans.sessions import _plans, running_requests_elapsed
from eventloom.sources.capture_files import read_captures
from eventloom.sources.events import _of_blocks
from eventloom.sources.tables import save_parsed
from tests.helpers import event, raw


def test_rows_of_a_small_file_are_dealt_out_before_they_become_text(spark, tmp_path):
    """A file of one split made one task build and parse all its records."""
    rows = spark.range(0, 50_000, 1, 1).selectExpr("id AS s_suppkey", "'s' AS s_name", "CAST(id % 25 AS INT) AS s_nationkey", "1.5D AS s_acctbal")
    rows.write.parquet(str(tmp_path / "supplier.parquet"))
    made = logs.raw_events(spark, str(tmp_path), logs.MANAGER_EVENT)
    tasks = [r["count"] for r in made.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(tasks) == 50_000 and len(tasks) == 3 and max(tasks) <= logs.ROWS_A_TASK
    assert made.select("file_offset").distinct().count() == 50_000


def test_exports_that_a_stream_follows_have_a_bounded_number_of_files(spark, tmp_path):
    """batches take so many files, and their number grew with the tasks."""
    rows = spark.range(0, 4_000, 1, 200)
    export(rows, str(tmp_path / "e"))
    found = spark.read.parquet(str(tmp_path / "e"))
    assert found.count() == 4_000 and found.select(F.input_file_name()).distinct().count() <= EXPORTED


def test_many_sessions_of_one_capture(spark, tmp_path):
    """10,001 sessions whose files share a name were refused."""
    raw(spark, ("a", event("a", ""))).drop("file_name").write.parquet(str(tmp_path / "AlwaysOn_health_0_1"))
    files = spark.range(10_001).selectExpr(r"concat('D:\\Log\\', id, '\\AlwaysOn_health_0_', id, '.xel') AS target_file")
    assert read_captures(spark, f"{tmp_path}/*", files).count() == 1


def test_more_captures_than_a_predicate_names(spark, tmp_path):
    names = ("AlwaysOn_health_0_1", "alwayson_HEALTH_0_22", "AlwaysOn_health_x_0_1", "Waits_1_2", "Waits.old_1", "Waits_1x", "system_health_0_1", "a_2_3")
    for folder in names:
        raw(spark, ("a", event("a", ""))).drop("file_name").write.parquet(str(tmp_path / folder))
    files = spark.createDataFrame([("D:\\Log\\AlwaysOn_health_0_133.xel",), ("/log/Waits_0_4.xel",), ("/log/a_2",), (None,)], "target_file string")
    few, many = (sorted(r.file_name.split("/")[-2] for r in read_captures(spark, f"{tmp_path}/*", files, most=n).collect()) for n in (10, 1))
    assert few == many == ["AlwaysOn_health_0_1", "Waits.old_1", "Waits_1_2", "a_2_3", "alwayson_HEALTH_0_22"]


def test_parsed_records_are_written_by_the_tasks_that_parse(spark, tmp_path):
    """parsed records, several times their text, were shuffled."""
    events = raw(spark, *[("a", event("a", "")) for _ in range(8)]).repartition(4)
    stored = save_parsed(events, str(tmp_path / "p"))
    assert stored.count() == 8 and stored.select(F.input_file_name()).distinct().count() == 4


def test_pieces_of_a_record_are_joined_up_in_their_block(spark):
    """each piece of a dump was dealt out three times more."""
    rows = [("f", 0, 1, 10, True, True, "a"), ("f", 0, 2, 20, True, False, "b"), ("f", 0, 4, 40, False, True, "c"), ("f", 0, 5, 50, True, True, "d"), ("f", 0, 6, 60, True, False, "e"), ("f", 0, 7, 70, False, True, "g"), ("f", 9, 1, 80, True, True, "h"), ("f", 9, 2, 90, True, True, "i")]
    made = _of_blocks(spark.createDataFrame(rows, "file_name string, block long, nth long, at long, begun boolean, goes_on boolean, piece string"))
    assert sorted(map(tuple, made.select("at", "begun", "goes_on", "piece").collect())) == [(10, True, False, "ab"), (40, False, False, "cde"), (70, False, True, "g"), (80, True, True, "hi")]


@pytest.fixture
def state(spark):
    return {
        "exec_requests": spark.sql("SELECT 1 AS session_id, 's' AS sql_handle, 'p' AS plan_handle, 'run' AS status, 5L AS cpu_time, 61000L AS total_elapsed_time, 3L AS logical_reads, 0 AS statement_start_offset, 4 AS statement_end_offset UNION ALL SELECT 1, 's', 'none', 'run', 9L, 1L, 1L, 0, -1"),
        "exec_sessions": spark.sql("SELECT 1 AS session_id, 'me' AS login_name"),
        "sql_text": spark.sql("SELECT 's' AS sql_handle, 'abcdef' AS text"),
        "batch_plan": spark.sql("SELECT 'p' AS plan_handle, '<p/>' AS query_plan UNION ALL SELECT 'p', '<p2/>' UNION ALL SELECT 'unused', '<u/>'"),
    }


def test_only_plans_in_use_and_statements_travel(spark, state):
    """whole batches and plans that no request runs went through the joins."""
    assert {r.query_plan for r in _plans(state).collect()} == {"<p/>", "<p2/>"}
    made = running_requests_elapsed(state)
    assert [(r.cpu_time, r.statement) for r in made.collect()] == [(9, "abcdef"), (5, "abc"), (5, "abc")]
    assert {r.InFlightPlan for r in made.collect()} == {None, "<p/>", "<p2/>"}


def test_the_fit_of_an_index_is_not_the_drivers(spark, monkeypatch):
    """the driver held the sample and the distances of the fit."""
    driver, fit = os.getpid(), ann.fitted_centroids

    def elsewhere(*sample):
        assert os.getpid() != driver
        return fit(*sample)

    monkeypatch.setattr(ann, "fitted_centroids", elsewhere)
    rows = spark.range(0, 600).selectExpr("id AS vec_id", "array(CAST(id % 7 + 1 AS FLOAT), CAST(id AS FLOAT)) AS embedding")
    found = ann.nearest(ann.clean(rows), F.col("vec_id") % 100 == 0, k=2, lists_of=64)
    assert found.count() == 12
