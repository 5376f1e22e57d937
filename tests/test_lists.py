"""Lists inside component records, opened to a row an entry."""

from eventloom.operators.envelope import parse
from eventloom.operators.fragments import entries
from eventloom.tables import cluster_diagnostics as sd
from eventloom.tables import components
from eventloom.tables import system_health as sh
from tests.helpers import component, data, event, raw


def record(subsystem, markup):
    return event("sp_server_diagnostics_component_result", data("component", "1", subsystem) + data("state", "1", "CLEAN") + data("data", markup))


IO = '<ioSubsystem ioLatchTimeouts="0"><longestPendingRequests>{}</longestPendingRequests></ioSubsystem>'
REQUESTS = [
    '<pendingRequest duration="12" filePath="D:\\a &amp; b.mdf" offset="0x1" handle="0xf"/>',
    '<pendingRequest duration="long" filePath=""/>',
    "<pendingRequest/>",
]
WAITS = '<topWaits><nonPreemptive><byCount><wait waitType="A" waits="3" averageWaitTime="4" maxWaitTime="9000000000"/><wait waitType="B"/></byCount><byDuration/></nonPreemptive><preemptive><byDuration><wait waitType="C" waits="1"/></byDuration></preemptive></topWaits>'
CPU = '<cpuIntensiveRequests><request sessionId="57" requestId="0" command="SELECT" taskAddress="0x2" cpuUtilization="98" cpuTimeMs="7"/><request sessionId="x"/></cpuIntensiveRequests>'
QUERY = f'<queryProcessing maxWorkers="5">{WAITS}{CPU}</queryProcessing>'


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_pending_requests(spark):
    events = raw(spark, record("IO_SUBSYSTEM", IO.format("".join(REQUESTS))), record("io_subsystem", IO.format("")), record("SYSTEM", IO.format(REQUESTS[0])), record("IO_SUBSYSTEM", "<ioSubsystem/>"), "<event", name="sp_server_diagnostics_component_result")
    want = [(1, 12, "D:\\a & b.mdf", "0x1", "0xf"), (2, None, "", None, None), (3, None, None, None, None)]
    for source in (events, parse(events, payload=components.EVERY_PAYLOAD)):
        got = entries(source, sh.PENDING_REQUESTS)
        assert got.columns == ["object_name", "TimeStampUTC", "position", "duration", "filePath", "offset", "handle"]
        assert rows(got, "position", "duration", "filePath", "offset", "handle") == want
    cluster = raw(spark, component(name="io_subsystem", payload=IO.format(REQUESTS[0] * 2)), name=sd.COMPONENT_EVENT)
    assert rows(entries(cluster, sd.PENDING_REQUESTS), "position", "duration") == [(1, 12), (2, 12)]


def test_top_waits_and_cpu_requests(spark):
    events = raw(spark, record("QUERY_PROCESSING", QUERY), record("QUERY_PROCESSING", "<queryProcessing/>"), name="sp_server_diagnostics_component_result")
    waits = entries(events, sh.TOP_WAITS)
    assert waits.columns[2:] == ["kind", "ordered", "position", "waitType", "waits", "averageWaitTime", "maxWaitTime"]
    assert rows(waits, *waits.columns[2:]) == [
        ("nonPreemptive", "byCount", 1, "A", 3, 4, 9000000000), ("nonPreemptive", "byCount", 2, "B", None, None, None), ("preemptive", "byDuration", 1, "C", 1, None, None)
    ]
    requests = rows(entries(events, sh.CPU_REQUESTS), "position", "sessionId", "requestId", "command", "taskAddress", "cpuUtilization", "cpuTimeMs")
    assert requests == [(1, 57, 0, "SELECT", "0x2", 98, 7), (2, None, None, None, None, None, None)]
    one = raw(spark, component(name="query_processing", payload=QUERY), name=sd.COMPONENT_EVENT)
    assert entries(one, sd.TOP_WAITS).count() == 3 and entries(one, sd.CPU_REQUESTS).count() == 2


def test_lists_cost_one_parse(spark):
    events = raw(spark, record("QUERY_PROCESSING", QUERY))
    assert entries(events, sh.TOP_WAITS)._jdf.queryExecution().optimizedPlan().toString().count("from_xml") == 1
