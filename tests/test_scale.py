"""Properties of the plans: what is read, parsed, shuffled and broadcast."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalogue import cluster_queries, flow_queries  # noqa: F401
from eventloom.operators.lookup import join_on
from eventloom.operators.publish import apply_changes
from eventloom.operators.shred import shred
from eventloom.plans import replication, waits
from eventloom.plans.health_log import event_summary, version_seed
from eventloom.sources.capture_files import read_captures
from eventloom.sources.tables import save_raw
from eventloom.tables import cluster_diagnostics as sd
from eventloom.tables.health_log import ERROR_REPORTED
from tests.helpers import component, data, event, raw, ring

OWN = [n for n in entry.queries() if n not in entry.LLM_QUERIES]
# These write files or run a stream when they are built: a few of them stand for the rest.
WRITING = {n for n in OWN if re.search("stream|stored|reloaded|published|events_from|saved|accounted|raw_layer|guarded|document|ledger|switched|bucketed|resolved", n)}
WRITING -= {"stored_parsed_layer", "ring_security_stream", "accounted_cluster_log", "published_columns"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The plan AQE ends with; Python's collect plans on its own, so it is run in the JVM."""
    execution = df._jdf.queryExecution()
    df._jdf.collectToPython()
    return execution.executedPlan().toString()


@pytest.fixture
def conf(spark):
    changed = {}

    def set_conf(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(set(OWN) - WRITING))
def test_no_cross_join_and_no_python_in_any_plan(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow", "InPandas"):
        assert node not in text
    assert "Window" not in text  # no window over an unbounded group


def test_routes_reach_the_scan_and_parse_once(spark, tmp_path):
    raw(spark, ("error_reported", event("error_reported", data("error_number", "1"))), ("x", event("x", ""))).write.parquet(
        str(tmp_path / "raw")
    )
    stored = spark.read.parquet(str(tmp_path / "raw"))
    table = shred(stored, ERROR_REPORTED).where("severity > 10").select("error_number")
    text = plan(table)
    assert "PushedFilters: [IsNotNull(object_name), EqualTo(object_name,error_reported)]" in text
    assert "ReadSchema: struct<object_name:string,event_data:string>" in text
    assert text.count("from_xml") == 1


def test_unlikely_records_are_not_parsed(spark):
    events = raw(spark, component(name="events"), name=sd.COMPONENT_EVENT)
    text = shred(events, sd.SYSTEM)._jdf.queryExecution().optimizedPlan().toString()
    below_parse = text[text.index("from_xml") :]
    assert "Contains(lower(event_data" in below_parse


def test_ring_text_is_distinct_before_it_is_parsed(spark):
    dump = component(name="events", payload=ring(event("error_reported", data("a", "1"))))
    events = raw(spark, *[dump] * 50, name=sd.COMPONENT_EVENT).repartition(4)
    table = shred(events, sd.RING_ERROR_REPORTED)
    physical = plan(table)
    # Partial and final aggregate over the text; the final one hands out the parsed rows.
    assert len(re.findall(r"HashAggregate\(keys=\[buffers#\d+\]", physical)) == 2
    logical = table._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[buffers#\d+\], \[from_xml", logical) and logical.count("from_xml") == 1
    assert table.count() == 1


def test_hot_groups_are_reduced_before_the_shuffle(spark):
    w = spark.range(1000).selectExpr("1 Session_ID", "'W' WaitType", "id Duration", "id Signal_Duration")
    text = plan(waits.wait_stats(w))
    assert "partial_sum" in text and "partial_count" in text


def test_hot_join_key_is_split(spark, conf):
    """A handle that holds almost all requests: AQE reads its partition in pieces."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    requests = spark.range(0, 200000, 1, 8).selectExpr("id", "IF(id % 20 = 0, id % 50, 7) AS h", "uuid() AS pad")
    texts = spark.range(50).selectExpr("id AS h", "concat('text ', id) AS text")
    for how in ("inner", "left", "left_semi"):
        joined = join_on(requests, texts, {"h": "h"}, how)
        assert "skew=true" in final_plan(joined), how
        assert joined.count() == 200000


def test_broadcast_is_spark_s_choice_by_size(spark, conf):
    left = spark.range(1000).selectExpr("id", "id % 10 AS k")
    right = spark.range(10).selectExpr("id AS k", "'n' AS name")
    small = final_plan(join_on(left, right, {"k": "k"}, "left"))
    assert "BroadcastHashJoin" in small
    conf(spark__sql__autoBroadcastJoinThreshold="1", spark__sql__adaptive__autoBroadcastJoinThreshold="1")
    large = join_on(left, right, {"k": "k"}, "left")
    assert "SortMergeJoin" in final_plan(large) and "BroadcastHashJoin" not in final_plan(large)
    assert large.count() == 1000


def test_topology_forms_no_pairs_of_duplicates(spark):
    """1000 equal subscriptions times 1000 equal agents stay two rows of work."""
    agents = spark.range(1000).selectExpr("'db' AS publisher_db")
    subscriptions = spark.range(1000).selectExpr("'db' publisher_db", "1 publication_id", "2 subscriber_id", "'sub' subscriber_db")
    state = {
        "logreader_agents": agents,
        "subscriptions": subscriptions,
        "publications": spark.createDataFrame([(1, 3, "p")], "publication_id int, publisher_id int, publication string"),
        "replservers": spark.createDataFrame([(2, "s2"), (3, "s3")], "srvid int, srvname string"),
    }
    rows = replication.replication_topology(state).collect()
    assert [tuple(r) for r in rows] == [("s3", "db", "p", "sub", "s2")]


def test_changes_of_one_hot_key(spark):
    target = spark.range(10).selectExpr("id", "'old' AS v")
    feed = spark.range(0, 100000, 1, 8).selectExpr("IF(id % 3 = 0, id % 10, 5) AS id", "concat('v', id) AS v", "'update' AS operation", "id AS sequence")
    out = apply_changes(target, feed, ["id"])
    assert "partial_max_by" in plan(out)
    last = {(i % 10 if i % 3 == 0 else 5): i for i in range(100000)}
    assert {r.id: r.v for r in out.collect()} == {i: f"v{n}" for i, n in last.items()}


def test_no_broadcast_hint_and_no_driver_side_data():
    """The library collects bounded answers alone: the presence guard, names of capture files, days, buckets, versions."""
    import pathlib

    root = pathlib.Path(entry.__file__).parent / "eventloom"
    sources = {p: p.read_text() for p in root.rglob("*.py") if "llm" not in p.parts}
    assert not [p for p, s in sources.items() if "broadcast(" in s or "crossJoin" in s or "localCheckpoint" in s]
    assert not [p for p, s in sources.items() if "toPandas" in s or "udf" in s.lower().replace("udfs", "")]
    assert sorted(p.name for p, s in sources.items() if ".collect()" in s) == ["capture_files.py", "ledger.py", "replicate.py", "shred.py", "versions.py"]


def exchanges(df) -> int:
    return len(re.findall(r"(?<!Broadcast)Exchange ", plan(df)))


@pytest.mark.parametrize("name,most", [("sd_system", 0), ("ag_state_top200", 0), ("pending_io_histogram", 2), ("ring_connectivity", 3)])
def test_no_exchange_without_need(spark, sf_dir, name, most):
    assert exchanges(entry.queries()[name](spark, sf_dir)) <= most


def test_guard_reads_names_only(spark, tmp_path):
    raw(spark, ("error_reported", "<event/>")).write.parquet(str(tmp_path / "r"))
    names = spark.read.parquet(str(tmp_path / "r")).where(F.col("object_name").isin("error_reported")).select("object_name").distinct()
    assert "ReadSchema: struct<object_name:string>" in plan(names)


def test_event_summary_reads_no_event_text(spark, sf_dir, tmp_path):
    """Counts of a log as it is, and of a stored layer, whose event names are partitions."""
    for name in ("event_summary", "event_summary_before_version_12", "event_summary_of_declared_events"):
        text = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
        assert "<event" not in text and "<data" not in text
    stored = save_raw(raw(spark, ("a", event("a", "")), ("b", event("b", ""))), str(tmp_path / "raw"))
    text = plan(event_summary(stored, version_seed(stored, 12)))
    assert "ReadSchema: struct<>" in text and "event_data" not in text


def test_parse_tasks_of_a_stored_log_are_bounded_by_events(spark, tmp_path):
    """Text that shrinks a hundred times in its file still makes many tasks, of a bounded number of events."""
    rows = spark.range(0, 40_000, 1, 1).selectExpr("'e' AS object_name", "repeat('<event name=\"e\"/>', 20) AS event_data", "'f' AS file_name", "id AS file_offset")
    stored = save_raw(rows, str(tmp_path / "raw"), events_a_file=1_000)
    tasks = [r["count"] for r in stored.where("object_name = 'e'").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(tasks) == 40_000 and len(tasks) >= 8 and max(tasks) <= 32 * 1_000
    by_file = stored.groupBy(F.input_file_name().alias("f")).count().agg(F.max("count")).first()[0]
    assert by_file <= 1_000


def test_resolved_captures_prune_files(spark, tmp_path):
    events = raw(spark, ("a", event("a", ""))).drop("file_name")
    for folder in ("AlwaysOn_health_0_1", "alwayson_HEALTH_0_22", "AlwaysOn_health_x_0_1", "system_health_0_1"):
        events.write.parquet(str(tmp_path / folder))
    files = spark.createDataFrame([("D:\\Log\\AlwaysOn_health_0_133.xel",), (None,)], "target_file string")
    found = read_captures(spark, f"{tmp_path}/*", files)
    assert {r.file_name.split("/")[-2] for r in found.collect()} == {"AlwaysOn_health_0_1", "alwayson_HEALTH_0_22"}
    execution = found._jdf.queryExecution()
    execution.executedPlan().executeCollect()
    scan = re.search(r"FileScan", execution.executedPlan().toString())
    leaves = execution.executedPlan().collectLeaves()
    assert scan and sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.length())) == 2
    assert read_captures(spark, f"{tmp_path}/*", files.limit(0)).count() == 0
