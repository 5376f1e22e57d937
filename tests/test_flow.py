import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.operators import publish
from eventloom.operators.shred import shred
from eventloom.sources.events import only_files, read_event_xml, read_events
from eventloom.sources.state import Snapshot
from eventloom.sources.tables import register, save, save_as_table, save_parsed, save_raw, save_tables, shared_folder
from eventloom.streaming.capture import capture_waits
from eventloom.streaming.ingest import append, append_table, compact_rows, distinct_rows, ring_rows
from eventloom.streaming.replicate import collect_changes, current_copy
from eventloom.tables import cluster_diagnostics as sd
from eventloom.tables.health_log import ERROR_REPORTED
from eventloom.tables.wait_capture import WAIT_INFO
from tests.helpers import action, component, data, event, raw, ring


def error(n):
    return event("error_reported", data("error_number", str(n)) + data("message", "a, \"b\"\n&lt;c&gt;"))


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_formats_round_trip(spark, tmp_path, fmt):
    events = raw(spark, *[error(i) for i in range(5)], name="error_reported").drop("file_name")
    path = str(tmp_path / "AlwaysOn_health")
    writer = events.write.format(fmt)
    (writer.option("header", True).option("escape", '"') if fmt == "csv" else writer).save(path)
    back = read_events(spark, path, fmt)
    assert back.columns == ["object_name", "event_data", "file_name", "file_offset"]
    rows = shred(back, ERROR_REPORTED).collect()
    assert sorted(r.error_number for r in rows) == list(range(5)) and rows[0].message == 'a, "b"\n<c>'
    assert all("AlwaysOn_health" in r.file_name for r in back.select("file_name").distinct().collect())


def test_file_selection(spark, tmp_path):
    for name in ("AlwaysOn_health_0_1", "system_health_0_1"):
        (tmp_path / f"{name}.txt").write_text(event(name, "") + "\n\n" + event(name, "") + "\n")
    every = read_events(spark, str(tmp_path), "text")
    picked = read_events(spark, str(tmp_path), "text", pattern="AlwaysOn_health*")
    assert (every.count(), picked.count()) == (4, 2)
    assert {r.object_name for r in picked.collect()} == {"AlwaysOn_health_0_1"}
    assert only_files(every, "system_health_0_1.txt").count() == 2
    with pytest.raises(ValueError):
        read_events(spark, str(tmp_path), "xel")


def test_xml_documents(spark, tmp_path):
    nested = event("outer", data("d", ring(error(9))))
    (tmp_path / "a.xml").write_text("<events>" + error(1).replace("\n", " ") + nested + error(2) + "</events>")
    rows = shred(read_event_xml(spark, str(tmp_path)), ERROR_REPORTED).collect()
    assert sorted(r.error_number for r in rows) == [1, 2]


def test_layers_and_reload(spark, tmp_path):
    events = raw(spark, ("error_reported", error(1)), ("error_reported", error(2)), ("other", event("other", "")))
    stored = save_raw(events, str(tmp_path / "raw"))
    assert sorted(r.error_number for r in shred(stored, ERROR_REPORTED).collect()) == [1, 2]
    scan = stored.where("object_name = 'other'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(object_name" in scan
    parsed = save_parsed(events, str(tmp_path / "parsed"))
    plan = shred(parsed, ERROR_REPORTED)
    assert "from_xml" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.error_number for r in plan.collect()) == [1, 2]
    for _ in range(2):
        table = save_tables(events, [ERROR_REPORTED], str(tmp_path / "t"))["error_reported"]
    assert table.count() == 2
    save(events.limit(1), str(tmp_path / "once"))
    assert save(events, str(tmp_path / "once")).count() == 3


def test_one_dominant_event_type_is_spread(spark, tmp_path):
    """More rows of one type are written by more tasks: the rebalance splits it by bytes."""
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(advisory, "32k")
    try:
        files = []
        for n in (2_000, 16_000):
            rows = spark.range(0, n, 1, 16).selectExpr(
                "'error_reported' AS object_name", "sha2(CAST(id AS STRING), 256) AS event_data", "'f' AS file_name", "id AS file_offset"
            )
            stored = save_raw(rows, str(tmp_path / f"raw{n}"))
            assert stored.count() == n
            files.append(stored.select(F.input_file_name()).distinct().count())
    finally:
        spark.conf.unset(advisory)
    assert files[1] >= 3 * files[0]


def test_result_tables_get_names(spark):
    register({"some_waits": spark.range(3)})
    assert spark.sql("SELECT count(*) AS n FROM some_waits").first().n == 3


def test_catalogue_table_is_reloaded(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS loads LOCATION '{tmp_path}/db'")
    save_as_table(spark.range(3), "loads.t")
    assert save_as_table(spark.range(5), "loads.t").count() == 5
    spark.sql("DROP DATABASE loads CASCADE")


def test_shared_folder_is_under_the_checkpoint_dir(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base) and shared_folder(spark) != shared_folder(spark)


def test_snapshot_reads_tables(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "databases"))
    snap = Snapshot(spark, str(tmp_path))
    assert snap["databases"].count() == 2 and "databases" in snap
    with pytest.raises(KeyError):
        snap["unknown"]


def wait(session, opcode=1, ts="2024-01-01T00:00:10Z"):
    body = data("wait_type", "1", "W") + data("opcode", str(opcode)) + data("duration", "5") + data("signal_duration", "1")
    return event("wait_info", body + action("event_sequence", "1") + action("scheduler_id", "0") + action("session_id", session), ts)


WAITS = [
    wait(1),
    wait(2),
    wait(1, opcode=0),
    wait(1, ts="2024-01-01T00:00:59.999Z"),
    wait(1, ts="2024-01-01T00:01:00Z"),
    wait(1, ts="2023-12-31T23:59:59Z"),
]


def test_bounded_capture(spark):
    events = raw(spark, *WAITS, name="wait_info")
    sessions = spark.createDataFrame([(1,), (1,), (7,)], "session_id int")
    bounded = capture_waits(events, sessions, dt.datetime(2024, 1, 1))
    assert sorted(r.TimeStamp.second for r in bounded.collect()) == [10, 59]
    assert capture_waits(events, sessions).count() == 4
    assert capture_waits(events, sessions.limit(0)).count() == 0


def test_stream_capture_equals_batch_and_resumes(spark, tmp_path):
    sessions = spark.createDataFrame([(1,)], "session_id int")
    folder = str(tmp_path / "files")

    def run():
        stream = read_events(spark, folder, stream=True)
        append(capture_waits(stream, sessions), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).count()

    events = raw(spark, *WAITS, name="wait_info").drop("file_name")
    events.write.mode("append").parquet(folder)
    assert run() == 4
    assert run() == 4  # nothing new, nothing twice
    events.write.mode("append").parquet(folder)
    assert run() == 8


def test_stream_ingestion(spark, tmp_path):
    raw(spark, *WAITS, name="wait_info").drop("file_name").write.parquet(str(tmp_path / "f"))
    stream = read_events(spark, str(tmp_path / "f"), stream=True)
    append_table(stream, WAIT_INFO, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "o")).count() == 6


def test_stream_keeps_late_ring_events_and_each_once(spark, tmp_path):
    def security(i):
        return event("security_error_ring_buffer_recorded", data("id", str(i)), f"2024-01-{10 - i:02}T00:00:00Z")

    dumps = [component(name="events", payload=ring(*[security(i) for i in ids])) for ids in ([1, 2], [1, 2, 9], [2, 3])]
    folder, out = str(tmp_path / "f"), str(tmp_path / "o")
    counts = []
    for dump in dumps:
        raw(spark, dump, name=sd.COMPONENT_EVENT).drop("file_name").write.mode("append").parquet(folder)
        rows = ring_rows(read_events(spark, folder, stream=True), sd.RING_SECURITY)
        append(rows, out, str(tmp_path / "c")).awaitTermination()
        counts.append(distinct_rows(spark.read.parquet(out)).count())
    assert counts == [2, 3, 4]
    assert compact_rows(spark.read.parquet(out), str(tmp_path / "compact")).count() == 4


def test_apply_changes(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 3), (4, "d", 4)], "id int, name string, n int")
    feed = spark.createDataFrame(
        [(1, "x", 9, "update", 1), (1, None, 8, "UPDATE", 5), (2, None, None, "Delete", 2), (3, None, None, "delete", 3),
         (3, "again", 1, "insert", 4), (7, "new", None, "insert", 1), (8, "gone", 1, "insert", 1), (8, None, None, "delete", 2)],
        "id int, name string, n int, operation string, sequence int",
    )
    once = publish.apply_changes(target, feed, ["id"])
    expected = {(1, None, 8), (3, "again", 1), (4, "d", 4), (7, "new", None)}
    assert {tuple(r) for r in once.collect()} == expected
    assert {tuple(r) for r in publish.apply_changes(once, feed, ["id"]).collect()} == expected


def test_snapshot_modes_columns_and_schema_change(spark, tmp_path):
    path = str(tmp_path / "copy")
    df = spark.createDataFrame([(1, "a")], "id int, name string")
    publish.publish_snapshot(df, path)
    assert publish.publish_snapshot(df.union(df), path).count() == 1  # kept
    assert publish.publish_snapshot(df.union(df), path, existing="drop").count() == 2
    assert publish.article(df, without=["name"]).columns == ["id"]
    assert publish.article(df, ["name"]).columns == ["name"]
    grown = publish.add_columns(df, df.withColumn("extra", F.lit(5)))
    assert sorted(r.extra or 0 for r in grown.collect()) == [0, 5]


def test_change_stream_is_appended_and_read(spark, tmp_path):
    snapshot = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    schema = "id int, name string, operation string, sequence int"
    folder, changes = str(tmp_path / "feed"), str(tmp_path / "changes")
    for batch in ([(1, "z", "update", 1)], [(2, None, "delete", 2), (1, "y", "update", 3)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(schema).parquet(folder)
        collect_changes(stream, changes, str(tmp_path / "cp")).awaitTermination()
    now = current_copy(snapshot, spark.read.parquet(changes), ["id"])
    assert [tuple(r) for r in now.collect()] == [(1, "y")]
