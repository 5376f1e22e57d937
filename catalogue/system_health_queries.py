"""System-health log: typed tables and reports."""

from __future__ import annotations

from catalogue import logs
from catalogue.registry import big, num, register
from eventloom.operators.fragments import entries
from eventloom.operators.shred import settle, shred
from eventloom.plans import system_health as reports
from eventloom.sources.tables import save_parsed, shared_folder
from eventloom.tables import cluster_diagnostics as cluster
from eventloom.tables import components
from eventloom.tables import system_health as tables


def raw(spark, sf_dir):
    return logs.log(spark, sf_dir, logs.SYSTEM_HEALTH_LOG)


def table(spec):
    return lambda spark, sf_dir: shred(raw(spark, sf_dir), spec)


def sorted_table(spec):
    """For a report that sorts: the sort's sampling pass does not parse again."""
    return lambda spark, sf_dir: settle(table(spec)(spark, sf_dir))


def oracle(source, columns: str, where: str = "") -> str:
    return f"SELECT object_name, ts AS TimeStampUTC, {columns}, event_data AS EventData FROM {source.oracle(True)} {where}"


SECURITY = oracle(
    logs.SH_SECURITY,
    f"""{num('v_session_id')} AS SessionID, v_error_code AS error_code, v_api_name AS api_name,
    v_calling_api_name AS calling_api_name""",
)
WAITS = oracle(
    logs.SH_WAIT,
    """t_wait_type AS WaitType, t_opcode AS OpCode, v_duration AS duration, v_signal_duration AS signal_duration,
    a_v_session_id AS session_id, a_v_sql_text AS SQLText""",
)
_ERROR_COLUMNS = f"""{big('v_error_number')} AS error_number, {big('v_severity')} AS severity, {big('v_state')} AS state,
    v_user_defined AS user_defined, t_category AS category, t_destination AS destination, v_is_intercepted AS is_intercepted,
    v_message AS message, a_v_session_id AS session_id, a_v_database_id AS database_id"""
ERRORS = oracle(logs.SH_ERROR, _ERROR_COLUMNS)
_TAIL = """v_user_mode_time AS UserModeTime, v_kernel_mode_time AS KernelModeTime, v_page_faults AS PageFaults,
    v_working_set_delta AS WorkingSetDelta, v_memory_utilization AS MemoryUtilization"""
DEADLOCK = oracle(
    logs.SH_DEADLOCK,
    f"""v_opcode AS OpCodeVal, {num('v_node_id')} AS NodeID, {num('v_process_utilization')} AS ProcessUtilization,
    {num('v_system_idle')} AS SystemIdle, {_TAIL}, v_call_stack AS CallStack""",
)
_UTIL = """v_worker AS Worker, v_yields AS Yields, v_worker_utilization AS WorkerUtilization,
    v_process_utilization AS ProcessUtilization, v_system_idle AS SystemIdle"""
NON_YIELD = oracle(
    logs.SH_NON_YIELD,
    f"v_opcode AS OpCodeVal, {num('v_node_id')} AS NodeID, v_scheduler AS Scheduler, {_UTIL}, {_TAIL}, v_call_stack AS CallStack",
)
NON_YIELD_RM = oracle(
    logs.SH_NON_YIELD_RM,
    f"""v_opcode AS OpCodeVal, {num('v_node_id')} AS NodeID, {_UTIL}, {_TAIL}, v_memory_allocation AS MemoryAllocation,
    v_call_stack AS CallStack""",
)
SYSTEM_HEALTH = oracle(
    logs.SH_SYSTEM_HEALTH,
    f"v_process_utilization AS ProcessUtilization, v_system_idle AS SystemIdle, {_TAIL}, v_call_stack AS CallStack",
)
WAITS_EXTERNAL = oracle(
    logs.SH_WAIT_EXTERNAL,
    """v_wait_type AS WaitTypeVal, t_wait_type AS WaitTypeText, v_opcode AS OpCodeVal, t_opcode AS OpCodeText,
    v_duration AS Duration, a_v_session_id AS SessionID, a_v_sql_text AS SQLText, a_v_callstack AS CallStack""",
)


def attributes(prefix: str, names: dict[str, str], text_names: set[str], without: tuple[str, ...] = ()) -> str:
    """Oracle columns of a component's attributes; attributes are text in `text_names`, else ints."""
    return ", ".join(
        f"CAST({prefix}{n} AS VARCHAR) AS {n}" if n in text_names else f"{num(f'CAST({prefix}{n} AS VARCHAR)')} AS {n}"
        for n in names
        if n not in without
    )


# The memory report in order; entries 7 to 10 are ints.
MEMORY_REPORT = [
    "AvailPhysMem", "AvailVirtMem", "AvailPagingFile", "WorkingSet", "%CommittedMemInWS", "PageFaults", "SysPhysMemHigh",
    "SysPhysMemLow", "ProcPhysMemLow", "ProcVirtMemLow", "VM Reserved", "VM Committed", "LckdPagesAllocated",
    "LargePagesAllocated", "Emergency Memory", "Emergency Memory In Use", "Target Committed", "Current Committed",
    "Pages Allocated", "Pages Reserved", "Pages Free", "Pages In Use", "Page Alloc Potential", "NUMA Growth Phase",
    "Last OOM Factor", "Last OS Error",
]

SYSTEM_COLUMNS = attributes(
    "sys_", logs.SYSTEM_ATTRIBUTES, {"spinlockBackoffs", "sickSpinlockType", "sickSpinlockTypeAfterAv", "LastBadPageAddress"}
)
CLUSTER_SYSTEM_COLUMNS = attributes(
    "sys_",
    logs.SYSTEM_ATTRIBUTES,
    {"spinlockBackoffs", "sickSpinlockType", "sickSpinlockTypeAfterAv", "LastBadPageAddress"},
    without=("totalDumpRequests",),
)
RESOURCE_COLUMNS = attributes("res_", logs.RESOURCE_ATTRIBUTES, {"lastNotification"}) + "".join(
    f', CAST(m{i + 1} AS {"INTEGER" if 6 <= i <= 9 else "BIGINT"}) AS "{n}"' for i, n in enumerate(MEMORY_REPORT)
)
IO_COLUMNS = attributes("io_", logs.IO_ATTRIBUTES, set())
QUERY_COLUMNS = (
    attributes("q_", logs.QUERY_ATTRIBUTES, {"trackingNonYieldingScheduler"})
    + """, w_np_count AS topNonPreemptWaitByCount, w_np_duration AS topNonPreemptWaitByDuration,
    w_p_count AS topPreemptWaitByCount, CAST(NULL AS VARCHAR) AS topPreemptWaitByDuration,
    top_waits_xml AS topWaits, cpu_xml AS cpuIntensiveRequests"""
)


def _component(columns: str, subsystem: str) -> str:
    return oracle(
        logs.SH_COMPONENT,
        f"t_component AS SubSystem, t_state AS State, {columns}",
        f"WHERE upper(t_component) = '{subsystem}'",
    )


COMPONENT_SYSTEM = _component(SYSTEM_COLUMNS, "SYSTEM")
COMPONENT_RESOURCE = _component(RESOURCE_COLUMNS, "RESOURCE")
COMPONENT_IO = _component(f"{IO_COLUMNS}, pending_xml AS LongestPendingRequests", "IO_SUBSYSTEM")
COMPONENT_QUERY = _component(QUERY_COLUMNS, "QUERY_PROCESSING")

CONNECT = oracle(
    logs.SH_CONNECT,
    """v_type AS TypeVal, t_type AS TypeText, t_source AS Source, v_session_id AS Session_ID, v_os_error AS OS_Error,
    v_sni_error AS SNI_error, v_sni_consumer_error AS SNI_consumer_error, v_sni_provider AS SNI_provider, v_state AS State,
    v_local_port AS LocalPort, v_remote_port AS RemotePort, v_tds_input_buffer_error AS TDSInputBufError,
    v_tds_output_buffer_error AS TDSOutputBufError, v_tds_input_buffer_bytes AS TDSInputBufBytes, v_tds_flags AS TDSFlags,
    t_tds_flags AS TDSFlagsText, v_total_login_time_ms AS TotalLoginTimeMS, v_login_task_enqueued_ms AS LoginTaskEnquedMS,
    v_network_writes_ms AS NetworkWritesMS, v_network_reads_ms AS NetworkReadsMS, v_ssl_processing_ms AS SSLProcessingMS,
    v_sspi_processing_ms AS SSPIProcessingMS,
    v_login_trigger_and_resource_governor_processing_ms AS LoginTrig_ResGovProcessingMS, v_connection_id AS ConnectionID,
    v_connection_peer_id AS ConnectionPeerID, v_local_host AS LocalHost, v_remote_host AS RemoteHost,
    v_call_stack AS CallStack""",
)

for name, spec, sql in [
    ("sh_wait_info", tables.WAIT_INFO, WAITS),
    ("sh_error_reported", tables.ERROR_REPORTED, ERRORS),
    ("sh_wait_info_external", tables.WAIT_INFO_EXTERNAL, WAITS_EXTERNAL),
]:
    register(name, table(spec), sql)

# The ten tables listed whole, in time order.
_LISTED = {
    tables.SCHEDULER_DEADLOCK.table: DEADLOCK,
    tables.SCHEDULER_NON_YIELDING.table: NON_YIELD,
    tables.SCHEDULER_NON_YIELDING_RM.table: NON_YIELD_RM,
    tables.SCHEDULER_SYSTEM_HEALTH.table: SYSTEM_HEALTH,
    tables.COMPONENT_SYSTEM.table: COMPONENT_SYSTEM,
    tables.COMPONENT_RESOURCE.table: COMPONENT_RESOURCE,
    tables.COMPONENT_IO.table: COMPONENT_IO,
    tables.COMPONENT_QUERY.table: COMPONENT_QUERY,
    tables.CONNECTIVITY.table: CONNECT,
    tables.SECURITY_ERROR.table: SECURITY,
}


def listing(spec):
    return lambda spark, sf_dir: reports.listing(sorted_table(spec)(spark, sf_dir))


for spec in reports.LISTED:
    register(f"{spec.table.lower()}_listing", listing(spec), _LISTED[spec.table])

register(
    "system_waits",
    lambda sp, d: reports.system_waits(sorted_table(tables.WAIT_INFO)(sp, d)),
    f"""SELECT TimeStampUTC, left(WaitType, 25) AS WaitType, left(OpCode, 6) AS OpCode, left(duration, 12) AS "Duration(ms)",
    left(signal_duration, 15) AS "Signal Duration(ms)" FROM ({WAITS})""",
)
register(
    "system_external_waits",
    lambda sp, d: reports.system_external_waits(sorted_table(tables.WAIT_INFO_EXTERNAL)(sp, d)),
    f"""SELECT TimeStampUTC, left(WaitTypeText, 40) AS WaitTypeText, left(OpCodeText, 6) AS OpCode,
    left(Duration, 12) AS "Duration(ms)" FROM ({WAITS_EXTERNAL})""",
)
register(
    "system_errors",
    lambda sp, d: reports.system_errors(sorted_table(tables.ERROR_REPORTED)(sp, d)),
    f"""SELECT TimeStampUTC, left(CAST(error_number AS VARCHAR), 11) AS ErrorNumber, left(CAST(severity AS VARCHAR), 10) AS Severity,
    left(CAST(state AS VARCHAR), 10) AS State, left(user_defined, 10) AS UserDefined, left(category, 10) AS Category,
    left(destination, 10) AS Destination, left(is_intercepted, 15) AS IsIntercepted, message, session_id, database_id,
    EventData FROM ({ERRORS})""",
)


# ------------------------------------------- lists inside components, a row an entry


def opened(spec, sources, stored=False):
    def query(spark, sf_dir):
        events = logs.log(spark, sf_dir, sources)
        return entries(save_parsed(events, f"{shared_folder(spark)}/parsed", components.EVERY_PAYLOAD) if stored else events, spec)

    return query


def _entries(source, select: str, condition: str) -> str:
    return f"SELECT object_name, ts AS TimeStampUTC, {select} FROM {source.oracle()} WHERE {condition}"


def _pending(source, component: str) -> str:
    is_io = f"lower({component}) = 'io_subsystem' AND pending_path IS NOT NULL"
    none = "CAST(NULL AS VARCHAR) AS \"offset\", CAST(NULL AS VARCHAR) AS handle"
    first = _entries(source, f"1 AS position, CAST(pending_duration AS INTEGER) AS duration, pending_path AS filePath, {none}", is_io)
    return f"{first} UNION ALL " + _entries(source, f"2 AS position, 99999 AS duration, 'second' AS filePath, {none}", is_io)


def _top(source, component: str) -> str:
    is_query = f"lower({component}) = 'query_processing'"
    none = "CAST(NULL AS BIGINT) AS averageWaitTime, CAST(NULL AS BIGINT) AS maxWaitTime"
    out = []
    for kind, order, wait in [("nonPreemptive", "byCount", "np_count"), ("nonPreemptive", "byDuration", "np_duration"), ("preemptive", "byCount", "p_count")]:
        mark = f"'{kind}' AS kind, '{order}' AS ordered"
        out.append(_entries(source, f"{mark}, 1 AS position, w_{wait} AS waitType, CAST(q_oldestPendingTaskWaitingTime AS BIGINT) AS waits, {none}", is_query))
        out.append(_entries(source, f"{mark}, 2 AS position, 'OTHER' AS waitType, CAST(NULL AS BIGINT) AS waits, {none}", is_query))
    return " UNION ALL ".join(out)


def _cpu(source, component: str) -> str:
    none = "CAST(NULL AS INTEGER) AS cpuUtilization, CAST(NULL AS BIGINT) AS cpuTimeMs"
    request = "1 AS position, CAST(q_oldestPendingTaskWaitingTime AS INTEGER) AS sessionId, CAST(NULL AS INTEGER) AS requestId, 'SELECT <*>' AS command"
    return _entries(source, f"{request}, CAST(NULL AS VARCHAR) AS taskAddress, {none}", f"lower({component}) = 'query_processing'")


register("sh_pending_requests", opened(tables.PENDING_REQUESTS, (logs.SH_COMPONENT,)), _pending(logs.SH_COMPONENT, "t_component"))
register("sh_top_waits", opened(tables.TOP_WAITS, (logs.SH_COMPONENT,)), _top(logs.SH_COMPONENT, "t_component"))
register("sh_cpu_requests", opened(tables.CPU_REQUESTS, (logs.SH_COMPONENT,)), _cpu(logs.SH_COMPONENT, "t_component"))
register("sd_pending_requests", opened(cluster.PENDING_REQUESTS, (logs.SD_COMPONENT,)), _pending(logs.SD_COMPONENT, "v_component_name"))
register("sd_stored_top_waits", opened(cluster.TOP_WAITS, (logs.SD_COMPONENT,), stored=True), _top(logs.SD_COMPONENT, "v_component_name"))
