import pytest
from pyspark.sql import functions as F

from eventloom.operators.envelope import quarantine
from eventloom.operators.shred import present_events, shred, shred_all
from eventloom.plans.health_log import all_reports
from eventloom.tables import cluster_diagnostics as sd
from eventloom.tables import health_log as ao
from eventloom.tables import system_health as sh
from tests.helpers import component, data, event, raw, ring


def test_component_payload_and_case_insensitive_route(spark):
    payload = '<system spinlockBackoffs="3" latchWarnings="" sqlCpuUtilization="x" nonYieldingTasksReported="2"/>'
    events = raw(spark, component(name="System ", payload=payload), component(name="resource"), name=sd.COMPONENT_EVENT)
    (row,) = shred(events, sd.SYSTEM).collect()
    assert (row.Component, row.spinlockBackoffs, row.latchWarnings) == ("System ", "3", 0)
    assert (row.sqlCpuUtilization, row.nonYieldingTasksReported, row.pageFaults) == (None, 2, None)
    assert row.ObjectName == sd.COMPONENT_EVENT
    assert shred(events, sd.SYSTEM, cut=True).first().ObjectName == "component_healt"


@pytest.mark.parametrize("spelled", ["system", "<![CDATA[system]]>", "s&#121;stem", "SYSTEM"])
def test_no_spelling_of_a_component_is_missed(spark, spelled):
    events = raw(spark, component(name=spelled), name=sd.COMPONENT_EVENT)
    assert shred(events, sd.SYSTEM).count() == 1


def test_memory_report_positions(spark):
    entries = "".join(f'<entry description="d{i}" value="{i}"/>' for i in range(1, 27))
    events = raw(
        spark,
        component(name="resource", payload=f'<resource lastNotification="L"><memoryReport>{entries}</memoryReport></resource>'),
        name=sd.COMPONENT_EVENT,
    )
    row = shred(events, sd.RESOURCE).first().asDict()
    assert row["AvailPhysMem"] == 1 and row["SysPhysMemHigh"] == 7 and row["Last OS Error"] == 26
    assert row["lastNotification"] == "L" and row["outOfMemoryExceptions"] is None


def test_every_component_record_lands_once(spark):
    events = raw(
        spark,
        component(name="system"),
        component(name="io_subsystem"),
        component(name="query_processing"),
        component(name="resource"),
        component(name="events"),
        component(name="mystery"),
        component(ctype=sd.AVAILABILITY_GROUP, name="ag1", payload='<availabilityGroup resourceID="r" leaseValid="TRUE"/>'),
        event("component_health_result", data("a", "1")),  # no component at all
        component(name="system")[:-3],
        name=sd.COMPONENT_EVENT,
    )
    single = [sd.SYSTEM, sd.IO_SUBSYSTEM, sd.QUERY, sd.RESOURCE, sd.MISC, sd.GROUP_STATE]
    counts = {s.table: shred(events, s).count() for s in single}
    assert counts == {t.table: 1 for t in single}
    assert quarantine(events).count() == 1
    assert shred(events, sd.GROUP_STATE).first().LeaseValid == "TRUE"


def ring_error(number, texts=True, ts="2020-01-01T00:00:00Z", name="error_reported"):
    fields = "".join(data(f"f{i}", f"{number}{i}", f"T{number}{i}" if texts else None) for i in range(1, 9))
    return event(name, fields, ts)


def errors(spark, *payloads, mode="all"):
    events = raw(spark, *[component(name="events", payload=p) for p in payloads], name=sd.COMPONENT_EVENT)
    return shred(events, sd.RING_ERROR_REPORTED, mode=mode)


def test_ring_events_are_distinct_over_records(spark):
    a, b = ring_error(1), ring_error(2, ts="2020-01-02T00:00:00Z")
    rows = errors(spark, ring(a, b), ring(b, a, a), ring(a)).collect()
    assert sorted((r.ErrorNumber, r.CategoryDesc) for r in rows) == [("11", "T15"), ("21", "T25")]


def test_first_mode_counts_positions_over_the_record(spark):
    a, b = ring_error(1, texts=False), ring_error(2)
    (row,) = errors(spark, ring(a, b), mode="first").collect()
    assert (row.ErrorNumber, row.Message, row.CategoryDesc) == ("11", "18", "T25")
    rows = errors(spark, ring(b, a), ring(b, a), mode="first").collect()
    assert [(r.ErrorNumber, r.CategoryDesc) for r in rows] == [("21", "T25")]


def test_all_holds_every_first(spark):
    payloads = [ring(ring_error(i), ring_error(i + 1)) for i in range(1, 6)]
    every = {r.ErrorNumber for r in errors(spark, *payloads).collect()}
    first = {r.ErrorNumber for r in errors(spark, *payloads, mode="first").collect()}
    assert first < every and len(every) == 6


def test_buffers_at_any_depth_several_and_empty(spark):
    deep = f"<x><y>{ring(ring_error(3))}</y></x>"
    two = f"<x>{ring(ring_error(4))}{ring(ring_error(5), attrs='')}</x>"
    empty = '<x><RingBufferTarget truncated="0"/></x>' + ring(ring_error(6)) + "<RingBufferTarget></RingBufferTarget>"
    rows = errors(spark, deep, two, empty).collect()
    assert sorted(r.ErrorNumber for r in rows) == ["31", "41", "51", "61"]
    assert len(errors(spark, two, mode="first").collect()) == 1


def test_other_events_and_plain_records_give_nothing(spark):
    other = ring_error(7, name="error_reported_too")
    assert errors(spark, ring(other), "error_reported").count() == 0
    assert errors(spark, ring(other), mode="first").count() == 0


def test_buffers_with_hidden_tags_are_parsed_whole(spark):
    comment = "<!-- " + ring_error(8).replace("--", "") + " -->"
    quoted = event("error_reported", data("f1", "<![CDATA[</event>]]>") + data("f2", "x"))
    rows = errors(spark, ring(comment, ring_error(9)), ring(quoted)).collect()
    assert {r.ErrorNumber for r in rows} == {"</event>", "91"} and len(rows) == 2


def test_events_inside_events_are_not_cut_short(spark):
    inner = event("error_reported", data("f1", "inner"))
    outer = event("error_reported", data("f1", "outer") + data("f2", inner) + data("f3", "z"))
    rows = errors(spark, ring(outer)).collect()
    assert [(r.ErrorNumber, r.State) for r in rows] == [("outer", "z")]


def test_other_quoting_and_self_closing_ring_events(spark):
    single = "<event package='p' name='error_reported' timestamp='2020-01-01T00:00:00Z'>" + data("a", "5") + "</event>"
    closed = '<event name="error_reported" timestamp="2020-01-03T00:00:00Z"/>'
    rows = errors(spark, ring(single, closed, ring_error(1))).collect()
    assert sorted(str(r.ErrorNumber) for r in rows) == ["11", "5", "None"]


def test_system_health_routes_on_event_and_text(spark):
    name = "sp_server_diagnostics_component_result"
    body = data("component", "1", "IO_SUBSYSTEM") + data("state", "1", "CLEAN")
    io = '<ioSubsystem ioLatchTimeouts="1" intervalLongIos="2" totalLongIos="3"><longestPendingRequests/></ioSubsystem>'
    events = raw(spark, event(name, body + data("data", io)), name=name)
    (row,) = shred(events, sh.COMPONENT_IO).collect()
    assert (row.SubSystem, row.State, row.totalLongIos) == ("IO_SUBSYSTEM", "CLEAN", 3)
    assert row.LongestPendingRequests == "<longestPendingRequests/>"
    assert shred(events, sh.COMPONENT_SYSTEM).count() == 0


def test_sync_state_text_falls_back(spark):
    name = ao.PARTNER_SYNC_STATE.event
    own = event(name, data("sync_state", "1", "beside") + data("sync_state_desc", None, "own"))
    beside = event(name, data("sync_state", "1", "beside"))
    rows = shred(raw(spark, own, beside, name=name), ao.PARTNER_SYNC_STATE).collect()
    assert [r.sync_state_desc for r in rows] == ["own", "beside"]


def test_present_events_guard_reports(spark):
    errors_only = raw(spark, ("error_reported", event("error_reported", data("error_number", "1480"))), ("x", "<event/>"))
    assert present_events(errors_only, ao.TABLES) == {"error_reported"}
    messages = spark.createDataFrame([], "message_id int, language_id int, text string")
    reports = all_reports(errors_only, messages, major_version=11)
    assert set(reports) == {"error_event_stats", "event_summary"}
    assert reports["event_summary"].count() == 7
    assert reports["error_event_stats"].first()["Abbreviated Message"].startswith("The %S_MSG database")


def test_shred_all_is_lazy_and_complete(spark):
    tables = shred_all(raw(spark, "<event/>"), sh.TABLES)
    assert set(tables) == {t.table for t in sh.TABLES} and len(tables) == 13
    assert all(t.agg(F.count("*")).first()[0] == 0 for t in list(tables.values())[:2])
