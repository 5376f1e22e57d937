"""Cluster-diagnostics log: typed tables, ring buffers and reports."""

from __future__ import annotations

from catalogue import logs
from catalogue.registry import register
from catalogue.system_health_queries import (
    CLUSTER_SYSTEM_COLUMNS,
    IO_COLUMNS,
    QUERY_COLUMNS,
    RESOURCE_COLUMNS,
)
from eventloom.operators.shred import settle, shred
from eventloom.plans import cluster_diagnostics as reports
from eventloom.sources.tables import save, shared_folder
from eventloom.tables import cluster_diagnostics as tables


def raw(spark, sf_dir):
    return logs.log(spark, sf_dir, logs.CLUSTER_LOG)


def table(spec, mode: str = "all"):
    return lambda spark, sf_dir: shred(raw(spark, sf_dir), spec, cut=True, mode=mode)


def report(make, spec):
    """A report that sorts: the sort's sampling pass does not parse again."""
    return lambda spark, sf_dir: make(settle(table(spec)(spark, sf_dir)))


def one_pass(make, spec):
    """A report that reads its input once: a top-n or an aggregate."""
    return lambda spark, sf_dir: make(table(spec)(spark, sf_dir))


def stored(spec):
    """The typed table written once and read back, for reports that read it more than once."""

    def query(spark, sf_dir):
        return save(shred(raw(spark, sf_dir), spec, cut=True), shared_folder(spark))

    return query


_COMMON = """left(object_name, 15) AS ObjectName, v_component_name AS Component, ts AS TimeStampUTC,
 CAST(v_creation_time AS TIMESTAMP) AS CreationTime, v_state_desc AS State_Desc"""


def _component(columns: str, component: str) -> str:
    return f"SELECT {_COMMON}, {columns} FROM {logs.SD_COMPONENT.oracle()} WHERE lower(v_component_name) = '{component}'"


SYSTEM = _component(CLUSTER_SYSTEM_COLUMNS, "system")
IO = _component(f"{IO_COLUMNS}, CAST(pending_duration AS INTEGER) AS duration, pending_path AS filePath", "io_subsystem")
QUERY = _component(QUERY_COLUMNS, "query_processing")
RESOURCE = _component(RESOURCE_COLUMNS, "resource")
STATUS = f"""
SELECT left(object_name, 15) AS ObjectName, ts AS TimeStampUTC, left(v_instance_name, 25) AS InstanceName,
 left(v_group_name, 25) AS AGName, left(v_target_state, 11) AS TargetState, left(t_target_state, 25) AS TargetStateDesc,
 left(v_failure_condition_level, 21) AS FailureConditionLevel, left(t_failure_condition_level, 25) AS HealthState,
 left(v_cluster_resource_id, 36) AS AGClusterResourceID FROM {logs.SD_STATUS.oracle()}"""
INFO = f"""
SELECT left(object_name, 15) AS ObjectName, ts AS TimeStampUTC, left(v_node_name, 25) AS NodeName,
 left(v_instance_name, 25) AS InstanceName, v_info AS InfoMessage FROM {logs.SD_INFO.oracle()}"""
MISC = f"""
SELECT left(object_name, 15) AS ObjectName, ts AS TimeStampUTC, v_component_name AS Component, event_data AS EventData
FROM {logs.SD_COMPONENT.oracle(with_xml=True)}
WHERE lower(v_component_name) NOT IN ('resource', 'io_subsystem', 'system', 'query_processing', 'events')
 AND v_component_type <> 'alwaysOn:AvailabilityGroup'"""
AG_STATE = f"""
SELECT left(object_name, 15) AS ObjectName, left(v_node_name, 25) AS NodeName, left(v_instance_name, 25) AS InstanceName,
 v_component_name AS AGName, ts AS TimeStampUTC, CAST(v_creation_time AS TIMESTAMP) AS CreationTimeUTC,
 left(v_state, 10) AS State, left(v_state_desc, 25) AS State_Desc, left(v_failure_condition_level, 25) AS FailureConditionLevel,
 left(ag_resourceID, 36) AS AGResourceID, left(ag_leaseValid, 10) AS LeaseValid
FROM {logs.SD_COMPONENT.oracle()} WHERE v_component_type = 'alwaysOn:AvailabilityGroup'"""

register("sd_system", table(tables.SYSTEM), SYSTEM)
register("sd_iosubsystem", table(tables.IO_SUBSYSTEM), IO)
register("sd_query", table(tables.QUERY), QUERY)
register("sd_resource", table(tables.RESOURCE), RESOURCE)
register("sd_infomessage", table(tables.INFO_MESSAGE), INFO)
register("sd_agstate", table(tables.GROUP_STATE), AG_STATE)

_NOT_CLEAN = "WHERE lower(State_Desc) <> 'clean'"
register("unhealthy_resource", report(reports.unhealthy, tables.RESOURCE), f"SELECT * FROM ({RESOURCE}) {_NOT_CLEAN}")
register("unhealthy_query", report(reports.unhealthy, tables.QUERY), f"SELECT * FROM ({QUERY}) {_NOT_CLEAN}")
register("unhealthy_system", report(reports.unhealthy, tables.SYSTEM), f"SELECT * FROM ({SYSTEM}) {_NOT_CLEAN}")
register("unhealthy_io", report(reports.unhealthy, tables.IO_SUBSYSTEM), f"SELECT * FROM ({IO}) {_NOT_CLEAN}")
register("long_ios", report(reports.long_ios, tables.IO_SUBSYSTEM), f"SELECT * FROM ({IO}) WHERE totalLongIos > 0")
register("pending_ios", report(reports.pending_ios, tables.IO_SUBSYSTEM), f"SELECT * FROM ({IO}) WHERE duration > 0")
register(
    "io_latch_timeouts",
    report(reports.io_latch_timeouts, tables.IO_SUBSYSTEM),
    f"SELECT * FROM ({IO}) WHERE ioLatchTimeouts > 0",
)
register(
    "max_pending_io",
    lambda spark, sf_dir: reports.max_pending_io(stored(tables.IO_SUBSYSTEM)(spark, sf_dir)),
    f"SELECT 'Max duration event:' AS label, * FROM ({IO}) WHERE duration IN (SELECT max(duration) FROM ({IO}))",
)
register(
    "pending_io_histogram",
    one_pass(reports.pending_io_histogram, tables.IO_SUBSYSTEM),
    f"""SELECT duration AS "Duration ms", count(duration) AS "Count" FROM ({IO}) WHERE duration IS NOT NULL GROUP BY duration""",
)
register(
    "nonyielding_schedulers",
    report(reports.nonyielding_schedulers, tables.QUERY),
    f"SELECT * FROM ({QUERY}) WHERE trackingNonYieldingScheduler <> '0x0'",
)
register(
    "nonyielding_tasks",
    report(reports.nonyielding_tasks, tables.SYSTEM),
    f"SELECT * FROM ({SYSTEM}) WHERE nonYieldingTasksReported <> 0",
)
register("ag_status_changes", report(reports.ag_status_changes, tables.GROUP_STATUS_CHANGE), STATUS)
register(
    "ag_state_top200",
    one_pass(reports.ag_state_top, tables.GROUP_STATE),
    f"""SELECT * FROM ({AG_STATE}) ORDER BY TimeStampUTC, ObjectName, NodeName, InstanceName, AGName, CreationTimeUTC, State,
 State_Desc, FailureConditionLevel, AGResourceID, LeaseValid LIMIT 200""",
)
register(
    "health_state_messages",
    report(reports.health_state_messages, tables.INFO_MESSAGE),
    f"SELECT * FROM ({INFO}) WHERE InfoMessage ILIKE '%health state%'",
)
register(
    "other_info_messages",
    report(reports.other_info_messages, tables.INFO_MESSAGE),
    f"SELECT * FROM ({INFO}) WHERE InfoMessage NOT ILIKE '%health state%'",
)
register(
    "misc_events",
    report(reports.misc_events, tables.MISC),
    MISC,
)


def distinct_rows(columns: str, *sources) -> str:
    union = " UNION ALL ".join(f"SELECT {columns} FROM {x.oracle()}" for x in sources)
    return f"SELECT DISTINCT * FROM ({union})"


_CONNECT = """ts AS RBEventTimeStampUTC, left(v_id, 10) AS ID, left(v_timestamp, 20) AS "timestamp",
 left(v_type, 10) AS ConnectivityRecordType, left(t_type, 20) AS ConnectivityRecordTypeDesc, left(v_source, 20) AS Source,
 left(t_source, 20) AS SourceType, left(v_session_id, 10) AS SessionID, left(v_os_error, 10) AS OSError,
 left(v_sni_error, 10) AS SNIError, left(v_sni_consumer_error, 10) AS SNIConsumerError, left(v_sni_provider, 10) AS SNIProvider,
 left(v_state, 10) AS State, left(v_local_port, 10) AS LocalPort, left(v_remote_port, 10) AS RemotePort,
 left(v_tds_input_buffer_error, 10) AS TDSInputBufferError, left(v_tds_output_buffer_error, 10) AS TDSOutputBufferError,
 left(v_tds_input_buffer_bytes, 10) AS TDSInputBufferBYtes, left(v_tds_flags, 10) AS TDSFlag, left(t_tds_flags, 30) AS TDSFlagDesc,
 left(v_total_login_time_ms, 10) AS total_login_time_ms, left(v_login_task_enqueued_ms, 10) AS login_task_enqueued_ms,
 left(v_network_writes_ms, 10) AS network_writes_ms, left(v_network_reads_ms, 10) AS network_reads_ms,
 left(v_ssl_processing_ms, 10) AS ssl_processing_ms, left(v_sspi_processing_ms, 10) AS sspi_processing_ms,
 left(v_login_trigger_and_resource_governor_processing_ms, 10) AS login_trigger_and_resource_governor_processing_ms,
 left(v_connection_id, 36) AS connection_id, left(v_connection_peer_id, 36) AS connection_peer_id,
 left(v_local_host, 15) AS local_host, left(v_remote_host, 15) AS remote_host"""

_RESOURCE_MONITOR = """ts AS RBEventTimeStampUTC, left(v_id, 10) AS ID, left(v_timestamp, 20) AS "timestamp",
 left(v_node_id, 10) AS NodeID, left(v_memory_node_id, 10) AS memory_node_id, left(v_memory_utilization_pct, 20) AS MemoryUtilizationPct,
 left(v_total_physical_memory_kb, 20) AS TotalPhysicalMemoryKB, left(v_available_physical_memory_kb, 20) AS AvailPhysicalMemoryKB,
 left(v_total_page_file_kb, 20) AS TotalPageFileKB, left(v_available_page_file_kb, 20) AS AvailPageFileKB,
 left(v_total_virtual_address_space_kb, 20) AS TotalVirtualAddressSpaceKB,
 left(v_available_virtual_address_space_kb, 20) AS AvailVirtualAddressSpaceKB,
 left(v_available_extended_virtual_address_space_kb, 20) AS AvailExtndVirtualAddrSpaceKB, left(v_target_kb, 20) AS TargetKB,
 left(v_reserved_kb, 20) AS ReservedKB, left(v_committed_kb, 20) AS CommittedKB, left(v_shared_committed_kb, 20) AS SharedCommittedKB,
 left(v_awe_kb, 20) AS AWE_KB, left(v_pages_kb, 20) AS Pages_KB, left('type_of_notification', 20) AS NotificationType,
 left(v_notification, 20) AS NotificationValue, left(t_notification, 20) AS NotificationText,
 left(v_process_indicators, 10) AS ProcessIndicators, left(v_system_indicators, 10) AS SystemIndicators,
 left(v_pool_indicators, 10) AS PoolIndicators, left(v_apply_low_pm, 10) AS ApplyLowPMValue, left(t_apply_low_pm, 10) AS ApplyLowPMText,
 left(v_apply_high_pm, 10) AS ApplyHighPMValue, left(t_apply_high_pm, 10) AS ApplyHighPMText,
 left(v_revert_high_pm, 10) AS RevertHighPMValue, left(t_revert_high_pm, 10) AS RevertHighPMText"""

_SCHEDULER = """ts AS RBEventTimeStampUTC, left(v_id, 10) AS ID, left(v_timestamp, 20) AS "timestamp",
 left(v_process_utilization, 19) AS process_utilization, left(v_system_idle, 11) AS system_idle,
 left(v_user_mode_time, 20) AS user_mode_time, left(v_kernel_mode_time, 20) AS kernel_mode_time,
 left(v_page_faults, 11) AS page_faults, left(v_working_set_delta, 20) AS working_set_delta,
 left(v_memory_utilization, 18) AS memory_utilization"""

_SECURITY = """ts AS RBEventTimeStampUTC, left(v_id, 10) AS ID, left(v_timestamp, 20) AS "timestamp",
 left(v_session_id, 10) AS SessionID, left(v_error_code, 10) AS ErrorCode, left(v_api_name, 30) AS APIName,
 left(v_calling_api_name, 30) AS CallingAPIName"""

_ERROR = """ts AS RBEventTimeStampUTC, left(v_error_number, 11) AS ErrorNumber, left(v_severity, 10) AS Severity,
 left(v_state, 10) AS State, left(v_user_defined, 10) AS UserDefined, left(v_category, 10) AS Category,
 {t5} AS CategoryDesc, left(v_destination, 11) AS Destination, {t6} AS DestinationDesc,
 left(v_is_intercepted, 13) AS IsIntercepted, v_message AS Message"""

# Short events carry two texts, so they have no fifth one; long events carry eight.
_SHORT = _ERROR.format(t5="CAST(NULL AS VARCHAR)", t6="CAST(NULL AS VARCHAR)")
_LONG = _ERROR.format(t5="left(t_category, 15)", t6="left(t_destination, 35)")
RING_ERRORS = f"""SELECT DISTINCT * FROM (SELECT {_SHORT} FROM {logs.RING_ERROR_SHORT.oracle()}
 UNION ALL SELECT {_LONG} FROM {logs.RING_ERROR_LONG.oracle()})"""

# Per record, the short event comes first and its two texts are followed by those of the long one.
_FIRST = _ERROR.format(t5="left(third, 15)", t6="left(fourth, 35)")
_LONG_TEXTS = {e.name: e.text for e in logs.RING_ERROR_LONG.data}
_WITH_LONG = logs.RING_ERROR_SHORT.oracle().replace(
    f" FROM {logs.RING_ERROR_SHORT.table})",
    f", {_LONG_TEXTS['state']} AS third, {_LONG_TEXTS['user_defined']} AS fourth FROM {logs.RING_ERROR_SHORT.table})",
)
RING_ERRORS_FIRST = f"SELECT DISTINCT {_FIRST} FROM {_WITH_LONG}"


def ring(spec, mode: str = "all"):
    return lambda spark, sf_dir: reports.ring_buffer_listing(table(spec, mode)(spark, sf_dir))


register("ring_error_reported", ring(tables.RING_ERROR_REPORTED), RING_ERRORS)
register("ring_error_reported_first_per_record", ring(tables.RING_ERROR_REPORTED, "first"), RING_ERRORS_FIRST)
register(
    "ring_scheduler_monitor",
    ring(tables.RING_SCHEDULER_MONITOR),
    distinct_rows(_SCHEDULER, logs.RING_SCHEDULER, logs.RING_SCHEDULER_NEXT),
)
register("ring_resource_monitor", ring(tables.RING_RESOURCE_MONITOR), distinct_rows(_RESOURCE_MONITOR, logs.RING_RESOURCE))
register(
    "ring_connectivity",
    ring(tables.RING_CONNECTIVITY),
    distinct_rows(_CONNECT, logs.RING_CONNECT, logs.RING_CONNECT_AGAIN),
)
register("ring_security", ring(tables.RING_SECURITY), distinct_rows(_SECURITY, logs.RING_SECURITY))
register(
    "ring_connectivity_first_per_record",
    ring(tables.RING_CONNECTIVITY, "first"),
    distinct_rows(_CONNECT, logs.RING_CONNECT),
)
