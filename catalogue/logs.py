"""Event logs derived from the given tables: every row of an input table becomes a record.

A log is the union of its sources. Each source writes one `object_name`, so a route on that
column keeps one branch of the union, as it keeps one partition of a stored log.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.xmlsql import E, EventSource, attr, element, in_steps, joined
from eventloom.plans.health_log import KNOWN_ERRORS

SERVER = "chr(92) || 'srv' || chr(92)"


def s(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def two(expr: str) -> str:
    return f"lpad({s(expr)}, 2, '0')"


def clock(key: str) -> str:
    """ISO text derived from a key: minutes, seconds and milliseconds vary."""
    return (
        f"'2024-01-' || {two(f'1 + {key} % 28')} || 'T' || {two(f'{key} % 24')} || ':' || {two(f'{key} % 60')}"
        f" || ':' || {two(f'({key} * 7) % 60')} || '.' || lpad({s(f'{key} % 1000')}, 3, '0')"
    )


def guid(prefix: str, key: str) -> str:
    return f"md5('{prefix}' || {s(key)}) || '-{prefix}x'"


K = "CAST(substr(props, 7, length(props) - 7) AS INT)"
EVENT_TS = "replace(CAST(ts AS STRING), ' ', 'T')"
ORDER_TS = (
    "substr(CAST(o_orderdate AS STRING), 1, 10) || 'T' || "
    f"{two('o_orderkey % 24')} || ':' || {two('o_custkey % 60')} || ':00.250'"
)

ERROR_NUMBER = (
    "CASE event_id % 15 "
    + " ".join(f"WHEN {i} THEN {n}" for i, n in enumerate(KNOWN_ERRORS))
    + " WHEN 12 THEN event_id % 3000 WHEN 13 THEN user_id END"
)

ERROR_EVENT = EventSource(
    "error_reported",
    "events",
    EVENT_TS,
    [
        E("error_number", ERROR_NUMBER),
        E("severity", "CAST(floor(value) AS INT)"),
        E("state", K),
        E("user_defined", "CASE WHEN event_type = 'view' THEN 'false ' ELSE 'true' END"),
        E("category", "user_id % 7", "upper(event_type) || ' CATEGORY OF THE SERVER LOG'"),
        E("destination", "'0x' || lpad(CAST(user_id AS STRING), 22, '0')", "'USER, ' || event_type || ' AND BEYOND'"),
        E("is_intercepted", "'false'", when="event_type <> 'click'"),
        E("message", f"'Row <' || {s(K)} || '> of \"' || event_type || '\" & more'"),
    ],
    key="event_id",
)

_AG = "'AG_' || CAST(o_custkey AS STRING) || '_of_the_primary_site'"
_STATEMENT = f"""CASE o_orderpriority
 WHEN '1-URGENT' THEN 'ALTER AVAILABILITY GROUP [' || {_AG} || ']' || chr(10) || ' FAILOVER;'
 WHEN '2-HIGH' THEN 'ALTER AVAILABILITY GROUP [' || {_AG} || '] Force_allow_data_loss'
 WHEN '3-MEDIUM' THEN 'CREATE AVAILABILITY GROUP [' || {_AG} || ']' || chr(10) || repeat('WITH (FAILOVER_MODE = AUTOMATIC, key = <' || CAST(o_orderkey AS STRING) || '>)' || chr(10), CAST(1 + o_orderkey % 40 AS INT))
 WHEN '4-NOT SPECIFIED' THEN ' alter availability group [x]' || chr(10) || ' grant create any database ' || repeat('a & b ', CAST(o_orderkey % 60 AS INT))
 ELSE CASE WHEN o_orderstatus = 'P' THEN NULL ELSE 'DROP AVAILABILITY GROUP x' || repeat(' ', CAST(o_orderkey % 300 AS INT)) END
END"""

DDL_EVENT = EventSource(
    "alwayson_ddl_executed",
    "orders",
    ORDER_TS,
    [
        E("ddl_action", "o_orderkey % 4", "CASE o_orderstatus WHEN 'P' THEN 'ALTER' WHEN 'F' THEN 'CREATE' ELSE 'DROP' END"),
        E("ddl_phase", "o_custkey % 3", "'COMMIT' || repeat('T', CAST(o_custkey % 9 AS INT))"),
        E("availability_group_name", _AG),
        E("availability_group_id", guid("ag", "o_custkey")),
        E("statement", _STATEMENT),
    ],
    key="o_orderkey",
)

LEASE_EVENT = EventSource(
    "availability_group_lease_expired",
    "customer",
    clock("c_custkey"),
    [
        E("availability_group_name", "c_name || ' ' || c_mktsegment"),
        E("availability_group_id", guid("ag", "c_custkey")),
    ],
    key="c_custkey",
)

MANAGER_EVENT = EventSource(
    "availability_replica_manager_state_change",
    "supplier",
    clock("s_suppkey"),
    [E("current_state", "s_nationkey % 3", "s_name || ' ONLINE AND ACCEPTING'")],
    key="s_suppkey",
)

REPLICA_STATE_EVENT = EventSource(
    "availability_replica_state",
    "part",
    clock("p_partkey"),
    [
        E("current_state", "CASE WHEN p_size % 5 = 0 THEN 'n/a' ELSE CAST(p_size AS STRING) END", "p_type || ' ' || p_name"),
        E("availability_group_name", "p_name || ' group & co, with a name of forty letters'"),
        E("availability_group_id", guid("ag", "p_partkey")),
        E("availability_replica_id", guid("ar", "p_partkey")),
    ],
    key="p_partkey",
)

REPLICA_CHANGE_EVENT = EventSource(
    "availability_replica_state_change",
    "customer",
    clock("c_custkey"),
    [
        E("previous_state", "c_nationkey % 6", "c_mktsegment || '_FORMER_STATE_OF_THE_REPLICA'"),
        E("current_state", "c_nationkey % 4", "'NOW_' || c_mktsegment"),
        E("availability_replica_name", "c_name || '_replica_1'", when="c_mktsegment <> 'BUILDING'"),
        E("availability_group_name", "'group ' || c_name || ' x'"),
        E("availability_replica_id", guid("ar", "c_custkey")),
        E("availability_group_id", guid("ag", "c_nationkey")),
    ],
    key="c_custkey",
)

LOCK_EVENT = EventSource(
    "lock_redo_blocked",
    "orders",
    ORDER_TS,
    [
        E("resource_type", "o_custkey % 12", "'RESOURCE ' || o_orderpriority || ' OF THE LOCK MANAGER'"),
        E("mode", "o_orderkey % 22", "'MODE_' || o_orderstatus"),
        E("owner_type", "o_orderkey % 6", "'OWNER ' || o_orderpriority"),
        E("transaction_id", "o_orderkey * 100000000"),
        E("database_id", "o_custkey % 25"),
        E("lockspace_workspace_id", "'0x' || lpad(CAST(o_orderkey AS STRING), 24, '0')"),
        E("lockspace_sub_id", "o_custkey + 1"),
        E("lockspace_nest_id", "o_custkey + 2"),
        E("resource_0", "o_orderkey + 10"),
        E("resource_1", "''"),
        E("resource_2", "'12.5'"),
        E("object_id", "o_custkey * 3"),
        E("associated_object_id", "CASE WHEN o_orderstatus <> 'P' THEN 72057594038845440 + o_orderkey END"),
        E("duration", "CAST(floor(o_totalprice) AS BIGINT)"),
        E("resource_description", "'KEY: <' || CAST(o_orderkey AS STRING) || '> of the clustered index'"),
    ],
    key="o_orderkey",
)

SYNC_EVENT = EventSource(
    "hadr_db_partner_set_sync_state",
    "part",
    clock("p_partkey"),
    [
        E("database_id", "p_partkey % 25"),
        E("commit_policy", "p_size % 3", "'POLICY ' || p_brand"),
        E("commit_policy_target", "p_size % 4", "'TARGET POLICY ' || p_brand || p_type"),
        E("sync_state", "p_size % 2", "'SYNC ' || p_type"),
        E("sync_state_desc", None, "'DESC ' || p_type || ' of all parts'", when="p_size > 25"),
        E("sync_log_block", "'0x' || lpad(CAST(p_partkey AS STRING), 20, '0')"),
        E("group_id", guid("ag", "p_partkey")),
        E("replica_id", guid("ar", "p_partkey")),
        E("ag_database_id", guid("db", "p_partkey")),
    ],
    key="p_partkey",
)

VALIDATION_EVENT = EventSource(
    "availability_replica_automatic_failover_validation",
    "customer",
    clock("c_custkey"),
    [
        E("availability_replica_name", "c_name || '_replica_1'"),
        E("availability_group_name", "'group ' || c_name || ' x'"),
        E("availability_replica_id", guid("ar", "c_custkey")),
        E("availability_group_id", guid("ag", "c_nationkey")),
        E("forced_quorum", "CASE WHEN c_nationkey < 12 THEN 'TRUE' ELSE 'FALSE' END"),
        E("joined_and_synchronized", "CASE WHEN c_acctbal > 0 THEN 'TRUE ' ELSE 'FALSE ' END"),
        E("previous_primary_or_automatic_failover_target", "'TRUE'", when="c_mktsegment = 'AUTOMOBILE'"),
    ],
    key="c_custkey",
)

UNLISTED_EVENT = EventSource("unlisted_event", "nation", clock("n_nationkey"), [E("name", "n_name")], key="n_nationkey")

HEALTH_LOG = (
    ERROR_EVENT,
    DDL_EVENT,
    LEASE_EVENT,
    MANAGER_EVENT,
    REPLICA_STATE_EVENT,
    REPLICA_CHANGE_EVENT,
    LOCK_EVENT,
    SYNC_EVENT,
    VALIDATION_EVENT,
    UNLISTED_EVENT,
)

WAIT_EVENT = EventSource(
    "wait_info",
    "events",
    EVENT_TS,
    [
        E("wait_type", "user_id % 11", "CASE WHEN event_type <> 'signup' THEN upper(event_type) || '_WAIT' END"),
        E("opcode", "CASE WHEN event_type = 'view' THEN 0 ELSE 1 END", "CASE WHEN event_type = 'view' THEN 'Begin' ELSE 'Completed' END"),
        E("duration", "CAST(floor(value * 10) AS BIGINT)"),
        E("signal_duration", K),
    ],
    [
        E("event_sequence", "event_id"),
        E("scheduler_id", "user_id % 8"),
        E("session_id", "user_id", when="event_type <> 'error'"),
    ],
    key="event_id",
)


# ---------------------------------------------------------------- system health

def numbered(names: str, key: str, **texts: str) -> list[E]:
    """Elements whose values differ by position; `texts` gives some of them a text."""
    return [E(n, f"({key} * {i + 3}) % {1009 + i}", texts.get(n)) for i, n in enumerate(names.split())]


_HEAD = "id timestamp"

SH_SECURITY = EventSource(
    "security_error_ring_buffer_recorded",
    "customer",
    clock("c_custkey"),
    [
        *numbered(_HEAD, "c_custkey"),
        E("session_id", "c_custkey % 500"),
        E("error_code", "'0x' || CAST(c_nationkey AS STRING)"),
        E("api_name", "'Api<' || c_mktsegment || '>'"),
        E("calling_api_name", "''"),
        E("call_stack", "c_name"),
    ],
    key="c_custkey",
)

SH_WAIT = EventSource(
    "wait_info",
    "events",
    EVENT_TS,
    [
        E("wait_type", "user_id % 11", "upper(event_type) || '_WAIT_OF_THE_WHOLE_SERVER'"),
        E("opcode", "1", "CASE WHEN event_type = 'view' THEN 'Begin' ELSE 'Completed' END"),
        E("duration", "CAST(floor(value * 10) AS BIGINT)"),
        E("signal_duration", K),
    ],
    [
        E("callstack", "'0x' || CAST(event_id AS STRING)"),
        E("session_id", "user_id"),
        E("sql_text", "'SELECT ' || props || ' FROM t WHERE a < 1 & b > 2'"),
    ],
    key="event_id",
)

SH_ERROR = EventSource(
    "error_reported",
    "events",
    EVENT_TS,
    [
        E("error_number", "17000 + user_id"),
        E("severity", "CAST(floor(value) AS BIGINT)"),
        E("state", K),
        E("user_defined", "'false'"),
        E("category", "4", "'CATEGORY ' || event_type"),
        E("destination", "'0x00000002'", "'ERRORLOG OF ' || event_type"),
        E("is_intercepted", "'false'"),
        E("message", "'Login failed for <' || event_type || '> & co'"),
    ],
    [
        E("callstack", "'0x' || CAST(event_id AS STRING)"),
        E("session_id", "user_id"),
        E("database_id", "user_id % 25"),
    ],
    key="event_id",
)

_TAIL = "user_mode_time kernel_mode_time page_faults working_set_delta memory_utilization"

SH_DEADLOCK = EventSource(
    "scheduler_monitor_deadlock_ring_buffer_recorded",
    "supplier",
    clock("s_suppkey"),
    numbered(f"{_HEAD} opcode node_id process_utilization system_idle {_TAIL} call_stack", "s_suppkey"),
    key="s_suppkey",
)

_UTIL = "worker yields worker_utilization process_utilization system_idle"

SH_NON_YIELD = EventSource(
    "scheduler_monitor_non_yielding_ring_buffer_recorded",
    "part",
    clock("p_partkey"),
    numbered(f"{_HEAD} opcode node_id scheduler {_UTIL} {_TAIL} call_stack", "p_partkey"),
    key="p_partkey",
)

SH_NON_YIELD_RM = EventSource(
    "scheduler_monitor_non_yielding_rm_ring_buffer_recorded",
    "part",
    clock("p_partkey"),
    numbered(f"{_HEAD} opcode node_id {_UTIL} {_TAIL} memory_allocation call_stack", "p_partkey"),
    key="p_partkey",
)

SH_SYSTEM_HEALTH = EventSource(
    "scheduler_monitor_system_health_ring_buffer_recorded",
    "customer",
    clock("c_custkey"),
    numbered(f"{_HEAD} process_utilization system_idle {_TAIL} call_stack", "c_custkey"),
    key="c_custkey",
)

SH_WAIT_EXTERNAL = EventSource(
    "wait_info_external",
    "orders",
    ORDER_TS,
    [
        E("wait_type", "o_custkey % 40", "'PREEMPTIVE_' || o_orderpriority || '_OF_A_RATHER_LONG_WAIT_TYPE'"),
        E("opcode", "o_orderkey % 2", "CASE o_orderstatus WHEN 'P' THEN 'Begin' ELSE 'Completed' END"),
        E("duration", "CAST(floor(o_totalprice * 100) AS BIGINT) * 1000000"),
    ],
    [
        E("callstack", "'0xF' || CAST(o_orderkey AS STRING)"),
        E("session_id", "o_custkey"),
        E("sql_text", "'EXEC p @x = ''' || o_orderpriority || ''''"),
    ],
    key="o_orderkey",
)

_CONNECT_NAMES = (
    f"{_HEAD} type source session_id os_error sni_error sni_consumer_error sni_provider state local_port remote_port "
    "tds_input_buffer_error tds_output_buffer_error tds_input_buffer_bytes tds_flags total_login_time_ms "
    "login_task_enqueued_ms network_writes_ms network_reads_ms ssl_processing_ms sspi_processing_ms "
    "login_trigger_and_resource_governor_processing_ms connection_id connection_peer_id local_host remote_host"
)


def connectivity(key: str, label: str) -> list[E]:
    return numbered(
        _CONNECT_NAMES,
        key,
        type=f"'ConnectionClose ' || {label}",
        source=f"'Tds of ' || {label}",
        tds_flags=f"'DisconnectDueToReadError, ' || {label} || ' and others'",
    )


SH_CONNECT = EventSource(
    "connectivity_ring_buffer_recorded",
    "customer",
    clock("c_custkey"),
    [*connectivity("c_custkey", "c_mktsegment"), E("call_stack", "c_name")],
    key="c_custkey",
)

# Nested component payloads, all from orders.
SYSTEM_ATTRIBUTES = {
    "spinlockBackoffs": "o_custkey % 10",
    "sickSpinlockType": "'none'",
    "sickSpinlockTypeAfterAv": "CASE WHEN o_orderstatus = 'P' THEN 'a<b' END",
    "latchWarnings": "o_custkey % 3",
    "isAccessViolationOccurred": "o_orderkey % 2",
    "writeAccessViolationCount": "0",
    "totalDumpRequests": "o_custkey % 5",
    "intervalDumpRequests": "CASE WHEN o_orderstatus <> 'F' THEN o_custkey % 4 END",
    "pageFaults": "o_orderkey % 100000",
    "systemCpuUtilization": "o_custkey % 101",
    "sqlCpuUtilization": "o_orderkey % 101",
    "BadPagesDetected": "0",
    "BadPagesFixed": "''",
    "LastBadPageAddress": "'0x' || CAST(o_orderkey AS STRING)",
    "nonYieldingTasksReported": "CASE WHEN o_orderkey % 4 = 0 THEN o_custkey ELSE 0 END",
}
RESOURCE_ATTRIBUTES = {
    "lastNotification": "'RESOURCE_MEMPHYSICAL_' || o_orderstatus",
    "outOfMemoryExceptions": "o_custkey % 2",
    "isAnyPoolOutOfMemory": "0",
    "processOutOfMemoryPeriod": "o_orderkey % 7",
}
MEMORY_ENTRIES = {f"m{i + 1}": f"(o_orderkey * {i + 3}) % {1009 + i} + {i}" for i in range(26)}
IO_ATTRIBUTES = {
    "ioLatchTimeouts": "o_orderkey % 2",
    "intervalLongIos": "o_custkey % 6",
    "totalLongIos": "CASE WHEN o_orderkey % 3 = 0 THEN o_custkey ELSE 0 END",
}
PENDING_DURATION = "o_custkey % 300"
PENDING_PATH = "'D:' || chr(92) || 'data & logs' || chr(92) || 'file' || CAST(o_custkey AS STRING) || '.mdf'"
QUERY_ATTRIBUTES = {
    "maxWorkers": "512",
    "workersCreated": "o_custkey % 512",
    "workersIdle": "o_orderkey % 100",
    "tasksCompletedWithinInterval": "o_orderkey",
    "pendingTasks": "o_custkey % 9",
    "oldestPendingTaskWaitingTime": "o_custkey",
    "hasUnresolvableDeadlockOccurred": "0",
    "hasDeadlockedSchedulersOccurred": "o_orderkey % 2",
    "trackingNonYieldingScheduler": "CASE WHEN o_orderkey % 5 = 0 THEN '0x' || CAST(o_custkey AS STRING) ELSE '0x0' END",
}
TOP_WAITS = {
    "np_count": "'HADR_' || o_orderstatus",
    "np_duration": "'LCK_M_' || o_orderstatus",
    "p_count": "'PREEMPTIVE_' || o_orderstatus",
}

_ENTRIES = " || ".join(element("entry", {"description": f"'{n}'", "value": e}) for n, e in MEMORY_ENTRIES.items())
SYSTEM_XML = element("system", SYSTEM_ATTRIBUTES)
RESOURCE_XML = element(
    "resource", RESOURCE_ATTRIBUTES, element("memoryReport", {"name": "'Process/System Counts'"}, _ENTRIES)
)
PENDING_XML = element(
    "longestPendingRequests",
    None,
    element("pendingRequest", {"duration": PENDING_DURATION, "filePath": PENDING_PATH})
    + " || "
    + element("pendingRequest", {"duration": "99999", "filePath": "'second'"}),
)
# One order status has no pending request at all.
PENDING_OR_NOTHING = f"(CASE WHEN o_orderstatus = 'F' THEN '' ELSE {PENDING_XML} END)"
IO_XML = element("ioSubsystem", IO_ATTRIBUTES, PENDING_OR_NOTHING)


def _waits(first: str | None) -> str:
    if first is None:
        return "''"
    return element("wait", {"waitType": first, "waits": "o_custkey"}) + " || " + element("wait", {"waitType": "'OTHER'"})


TOP_WAITS_XML = element(
    "topWaits",
    None,
    element(
        "nonPreemptive",
        None,
        element("byCount", None, _waits(TOP_WAITS["np_count"]))
        + " || "
        + element("byDuration", None, _waits(TOP_WAITS["np_duration"])),
    )
    + " || "
    + element(
        "preemptive", None, element("byCount", None, _waits(TOP_WAITS["p_count"])) + " || " + element("byDuration", None, _waits(None))
    ),
)
CPU_XML = element("cpuIntensiveRequests", None, element("request", {"sessionId": "o_custkey", "command": "'SELECT <*>'"}))
QUERY_XML = element("queryProcessing", QUERY_ATTRIBUTES, f"{TOP_WAITS_XML} || {CPU_XML}")

COMPONENT_XML = f"""(CASE o_orderpriority WHEN '1-URGENT' THEN {SYSTEM_XML} WHEN '2-HIGH' THEN {IO_XML}
 WHEN '3-MEDIUM' THEN {QUERY_XML} WHEN '4-NOT SPECIFIED' THEN {RESOURCE_XML} ELSE '<other/>' END)"""



def _opened(tag: str, attributes: dict[str, str], *inner: str) -> list[str]:
    """The pieces of `element(tag, attributes, inner)`."""
    return [f"'<{tag}'", *[attr(n, e) for n, e in attributes.items()], "'>'", *inner, f"'</{tag}>'"]


_EACH_ENTRY = [element("entry", {"description": f"'{n}'", "value": e}) for n, e in MEMORY_ENTRIES.items()]
_BY_PRIORITY = {
    "1-URGENT": ["'<system'", *[attr(n, e) for n, e in SYSTEM_ATTRIBUTES.items()], "'/>'"],
    "2-HIGH": _opened("ioSubsystem", IO_ATTRIBUTES, PENDING_OR_NOTHING),
    "3-MEDIUM": _opened("queryProcessing", QUERY_ATTRIBUTES, TOP_WAITS_XML, CPU_XML),
    "4-NOT SPECIFIED": _opened("resource", RESOURCE_ATTRIBUTES, *_opened("memoryReport", {"name": "'Process/System Counts'"}, *_EACH_ENTRY)),
}
#: Letters of SQL that are built in one step.
STEP = 3_000


def component_pieces(unless: str = "FALSE") -> list[str]:
    """SQL texts that follow each other in COMPONENT_XML, all empty where `unless` holds."""
    pieces = []
    for priority, parts in _BY_PRIORITY.items():
        for step in in_steps(parts, STEP):
            pieces.append(f"(CASE WHEN {unless} THEN '' WHEN o_orderpriority = '{priority}' THEN {step} ELSE '' END)")
    known = ", ".join(f"'{p}'" for p in _BY_PRIORITY)
    return [*pieces, f"(CASE WHEN {unless} THEN '' WHEN o_orderpriority IN ({known}) THEN '' ELSE '<other/>' END)"]


COMPONENT_COLUMNS = {
    **{f"sys_{n}": e for n, e in SYSTEM_ATTRIBUTES.items()},
    **{f"res_{n}": e for n, e in RESOURCE_ATTRIBUTES.items()},
    **MEMORY_ENTRIES,
    **{f"io_{n}": e for n, e in IO_ATTRIBUTES.items()},
    "pending_duration": f"CASE WHEN o_orderstatus <> 'F' THEN {PENDING_DURATION} END",
    "pending_path": f"CASE WHEN o_orderstatus <> 'F' THEN {PENDING_PATH} END",
    "pending_xml": PENDING_OR_NOTHING,
    **{f"q_{n}": e for n, e in QUERY_ATTRIBUTES.items()},
    **{f"w_{n}": e for n, e in TOP_WAITS.items()},
    "top_waits_xml": TOP_WAITS_XML,
    "cpu_xml": CPU_XML,
}

SH_COMPONENT = EventSource(
    "sp_server_diagnostics_component_result",
    "orders",
    ORDER_TS,
    [
        E(
            "component",
            "o_orderkey % 5",
            "CASE o_orderpriority WHEN '1-URGENT' THEN CASE WHEN o_orderstatus = 'O' THEN 'system' ELSE 'SYSTEM' END "
            "WHEN '2-HIGH' THEN 'IO_SUBSYSTEM' WHEN '3-MEDIUM' THEN 'QUERY_PROCESSING' "
            "WHEN '4-NOT SPECIFIED' THEN 'RESOURCE' ELSE 'EVENTS' END",
        ),
        E("state", "1", "CASE WHEN o_orderkey % 6 = 0 THEN 'WARNING' ELSE 'CLEAN' END"),
        E("data", markup=COMPONENT_XML, pieces=tuple(component_pieces())),
    ],
    extra=COMPONENT_COLUMNS,
    key="o_orderkey",
)

SYSTEM_HEALTH_LOG = (
    SH_SECURITY,
    SH_WAIT,
    SH_ERROR,
    SH_DEADLOCK,
    SH_NON_YIELD,
    SH_NON_YIELD_RM,
    SH_SYSTEM_HEALTH,
    SH_WAIT_EXTERNAL,
    SH_CONNECT,
    SH_COMPONENT,
)

# ---------------------------------------------------------- cluster diagnostics


def component_record(
    table: str, ts: str, key: str, *, component: str, kind: str, state: str, markup: str, pieces: list[str], node: str, extra=None
) -> EventSource:
    return EventSource(
        "component_health_result",
        table,
        ts,
        [
            E("state", f"{key} % 4"),
            E("failure_condition_level", "3"),
            E("creation_time", f"replace({ts}, 'T', ' ')"),
            E("component_type", kind),
            E("component_name", component),
            E("state_desc", state),
            E("data", markup=markup, pieces=tuple(pieces)),
            E("instance_name", f"{node} || '_INSTANCE'"),
            E("node_name", node),
        ],
        extra=extra or {},
        key=key,
    )


AG_RESOURCE = {"resourceID": guid("rs", "o_custkey"), "leaseValid": "CASE WHEN o_custkey % 7 = 0 THEN 'FALSE' ELSE 'TRUE' END"}
_AG_RECORD = "(o_orderpriority = '5-LOW' AND o_orderstatus = 'O')"

SD_COMPONENT = component_record(
    "orders",
    ORDER_TS,
    "o_orderkey",
    component="""CASE o_orderpriority WHEN '1-URGENT' THEN CASE WHEN o_orderstatus = 'F' THEN 'System' ELSE 'system' END
 WHEN '2-HIGH' THEN 'io_subsystem' WHEN '3-MEDIUM' THEN 'query_processing' WHEN '4-NOT SPECIFIED' THEN 'resource'
 ELSE CASE o_orderstatus WHEN 'P' THEN 'mystery_component' WHEN 'F' THEN 'events' ELSE 'AG_' || CAST(o_custkey AS STRING) END END""",
    kind=f"CASE WHEN {_AG_RECORD} THEN 'alwaysOn:AvailabilityGroup' ELSE 'instance' END",
    state="CASE WHEN o_orderkey % 6 = 0 THEN 'warning' WHEN o_orderkey % 6 = 1 THEN 'Clean' ELSE 'clean' END",
    markup=f"(CASE WHEN {_AG_RECORD} THEN {element('availabilityGroup', AG_RESOURCE)} ELSE {COMPONENT_XML} END)",
    pieces=[f"(CASE WHEN {_AG_RECORD} THEN {element('availabilityGroup', AG_RESOURCE)} ELSE '' END)", *component_pieces(unless=_AG_RECORD)],
    node="'NODE_' || CAST(o_custkey AS STRING)",
    extra={**COMPONENT_COLUMNS, **{f"ag_{n}": e for n, e in AG_RESOURCE.items()}},
)

SD_STATUS = EventSource(
    "availability_group_state_change",
    "customer",
    clock("c_custkey"),
    [
        E("target_state", "c_nationkey % 3", "'STATE ' || c_mktsegment"),
        E("failure_condition_level", "3", "'HEALTH OF ' || c_mktsegment || ' AND ALL OTHERS'"),
        E("cluster_resource_id", guid("rs", "c_custkey")),
        E("group_name", "'group ' || c_name || ' x'"),
        E("instance_name", "c_name || '_INSTANCE'"),
    ],
    key="c_custkey",
)

SD_INFO = EventSource(
    "info_message",
    "part",
    clock("p_partkey"),
    [
        E(
            "info",
            "CASE WHEN p_size % 2 = 0 THEN '[hadrag] component ''' || p_type || ''' Health State has been changed' "
            "ELSE '[hadrag] ' || p_name || ' <started> & running' END",
        ),
        E("instance_name", "p_brand || '_INSTANCE_OF_THE_CLUSTER'"),
        E("node_name", "'NODE_' || p_brand"),
    ],
    key="p_partkey",
)


def ring_parts(*events: str) -> list[str]:
    return ["'<events><session><RingBufferTarget truncated=\"0\" eventCount=\"9\">'", *events, "'</RingBufferTarget></session></events>'"]


def _ring_error(key: str, with_texts: bool) -> list[E]:
    def note(name: str) -> str | None:
        return f"'{name.upper()} TEXT OF ' || CAST({key} AS STRING)" if with_texts or name in ("category", "destination") else None

    names = "error_number severity state user_defined category destination is_intercepted".split()
    values = [E(n, f"({key} * {i + 2}) % {101 + i}", note(n)) for i, n in enumerate(names)]
    return [*values, E("message", f"'Message <' || CAST({key} AS STRING) || '>'", note("message"))]


def _ring_security(key: str) -> list[E]:
    return [
        *numbered("id timestamp session_id error_code", key),
        E("api_name", f"'NetValidate of ' || CAST({key} AS STRING) || ' by the domain controller'"),
        E("calling_api_name", f"'Calling ' || CAST({key} AS STRING)"),
    ]


_RESOURCE_NAMES = (
    "id timestamp memory_utilization_pct total_physical_memory_kb available_physical_memory_kb total_page_file_kb "
    "available_page_file_kb total_virtual_address_space_kb available_virtual_address_space_kb "
    "available_extended_virtual_address_space_kb memory_node_id target_kb reserved_kb committed_kb shared_committed_kb "
    "awe_kb pages_kb notification process_indicators system_indicators pool_indicators node_id apply_low_pm "
    "apply_high_pm revert_high_pm"
)


def _ring_resource(key: str, label: str) -> list[E]:
    texts = {
        "notification": f"'RESOURCE_MEM_' || {label}",
        "apply_low_pm": f"'LOW ' || {label}",
        "apply_high_pm": f"'HIGH ' || {label}",
        "revert_high_pm": f"'REVERT ' || {label}",
    }
    return [
        E(n, f"({key} * {i + 3}) % {1009 + i}", texts.get(n), type_name=f"type_of_{n}")
        for i, n in enumerate(_RESOURCE_NAMES.split())
    ]


_SCHEDULER_NAMES = "id timestamp process_utilization system_idle user_mode_time kernel_mode_time page_faults working_set_delta memory_utilization"


def _ring(event: str, table: str, key: str, data: list[E]) -> EventSource:
    return EventSource(event, table, clock(key), data)


# Keys are coarse, so successive records repeat the same nested events.
RING_ERROR_SHORT = _ring("error_reported", "events", "user_id", _ring_error("user_id", False))
RING_ERROR_LONG = _ring("error_reported", "events", K, _ring_error(K, True))
RING_SECURITY = _ring("security_error_ring_buffer_recorded", "events", "user_id", _ring_security("user_id"))
RING_CONNECT = _ring(
    "connectivity_ring_buffer_recorded", "customer", "c_nationkey", connectivity("c_nationkey", "c_mktsegment")
)
RING_CONNECT_AGAIN = _ring(
    "connectivity_ring_buffer_recorded", "customer", "c_custkey", connectivity("c_custkey", "'all'")
)
RING_RESOURCE = _ring(
    "resource_monitor_ring_buffer_recorded", "customer", "c_nationkey", _ring_resource("c_nationkey", "c_mktsegment")
)
RING_SCHEDULER = _ring(
    "scheduler_monitor_system_health_ring_buffer_recorded", "part", "p_size", numbered(_SCHEDULER_NAMES, "p_size")
)
RING_SCHEDULER_NEXT = _ring(
    "scheduler_monitor_system_health_ring_buffer_recorded", "part", "(p_size + 1)", numbered(_SCHEDULER_NAMES, "(p_size + 1)")
)


def _dump(table: str, ts: str, key: str, *events: EventSource) -> EventSource:
    return component_record(
        table,
        ts,
        key,
        component="'events'",
        kind="'instance'",
        state="'clean'",
        markup=joined(ring_parts(*[e.xml() for e in events])),
        pieces=ring_parts(*[p for e in events for p in e.pieces()]),
        node="'NODE_1'",
    )


SD_DUMPS = [
    _dump("events", EVENT_TS, "event_id", RING_ERROR_SHORT, RING_SECURITY, RING_ERROR_LONG),
    _dump("customer", clock("c_custkey"), "c_custkey", RING_CONNECT, RING_CONNECT_AGAIN, RING_RESOURCE),
    _dump("part", clock("p_partkey"), "p_partkey", RING_SCHEDULER, RING_SCHEDULER_NEXT),
]

CLUSTER_LOG = (SD_COMPONENT, SD_STATUS, SD_INFO, *SD_DUMPS)


# ------------------------------------------------------------------- DataFrames


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows that a task turns into records. A row of a few bytes becomes a record of up to some thousands, so
#: that a file too small to be split can stand for gigabytes of text.
ROWS_A_TASK = 20_000


def dealt(df: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """The same rows dealt out evenly, while they are narrow, to tasks of a bounded number of rows each.

    The number of rows comes from the files' footers.
    """
    parts = math.ceil(df.count() / rows_a_task)
    return df.repartition(parts) if parts > 1 else df


def raw_events(spark: SparkSession, sf_dir: str, source: EventSource) -> DataFrame:
    df = dealt(table(spark, sf_dir, source.table))
    # A long text is built in steps, each behind an `inline`: the code of one step is short enough for the JVM
    # to compile. Behind the last one a predicate on the text does not build it again.
    steps = in_steps(source.pieces(), STEP)
    for i, step in enumerate(steps):
        df = df.select("*", F.inline(F.array(F.struct(F.expr(step).alias(f"step_{i}")))))
    return df.select(
        F.lit(source.event).alias("object_name"),
        F.inline(F.array(F.struct(F.concat(*[f"step_{i}" for i in range(len(steps))]).alias("event_data")))),
        F.lit(f"{source.table}_0_1.xel").alias("file_name"),
        F.expr(f"CAST({source.key} AS BIGINT)").alias("file_offset"),
    )


def broken_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Truncated records, one per region; they belong to no typed table."""
    return table(spark, sf_dir, "region").select(
        F.lit("error_reported").alias("object_name"),
        F.concat(F.lit('<event name="error_reported"><data name="error_number"><value>'), F.col("r_regionkey")).alias("event_data"),
        F.lit("region_0_1.xel").alias("file_name"),
        F.col("r_regionkey").cast("bigint").alias("file_offset"),
    )


def log(spark: SparkSession, sf_dir: str, sources: tuple[EventSource, ...], broken: bool = False) -> DataFrame:
    """The lazy plan of a log (it holds no data)."""
    parts = [raw_events(spark, sf_dir, x) for x in sources]
    if broken:
        parts.append(broken_events(spark, sf_dir))
    return reduce(DataFrame.unionByName, parts)


def log_names(spark: SparkSession, sf_dir: str, sources: tuple[EventSource, ...]) -> DataFrame:
    """The column object_name of `log(..., broken=True)`, without a text being built for it."""
    parts = [table(spark, sf_dir, x.table).select(F.lit(x.event).alias("object_name")) for x in sources]
    return reduce(DataFrame.unionByName, [*parts, broken_events(spark, sf_dir).select("object_name")])


# An event of no listed name, in single quotes, behind a comment, and a record under a foreign root.
NAMELESS = (
    "'<!-- > --><event name=' || chr(39) || 'nobody' || chr(39) || ' note=' || chr(39) || 'a>b' || chr(39) || '>"
    "<data name=\"k\"><value>' || CAST(n_nationkey AS STRING) || '</value></data></event>'"
)
FOREIGN = "'<other a=\"' || CAST(r_regionkey AS STRING) || '\"><event name=\"error_reported\"/></other>'"


def odd_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that no table takes: some without an event type, some that are no events."""
    nameless = table(spark, sf_dir, "nation").selectExpr(
        "CAST(NULL AS STRING) AS object_name", f"{NAMELESS} AS event_data", "'nation_0_2.xel' AS file_name", "CAST(n_nationkey AS BIGINT) AS file_offset"
    )
    foreign = table(spark, sf_dir, "region").selectExpr(
        "'error_reported' AS object_name", f"{FOREIGN} AS event_data", "'region_0_2.xel' AS file_name", "CAST(r_regionkey AS BIGINT) AS file_offset"
    )
    return nameless.unionByName(foreign)
