"""System-health log (`*system_health_*.xel` exports); columns are read by position.

Fixed values: event names, positions and output column names.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions.text import same
from eventloom.functions.typed import BIGINT, INT
from eventloom.operators import envelope
from eventloom.operators.specs import Source, TableSpec, action, column, fragment, run, stamp, text, value
from eventloom.tables import components

FILE_PATTERN = "*system_health_*.xel"


def _table(name: str, event: str, columns: dict[str, Source], **more) -> TableSpec:
    common = {"object_name": column("object_name"), "TimeStampUTC": stamp()}
    return TableSpec(table=name, event=event, columns={**common, **columns}, **more).keeping_raw()


SECURITY_ERROR = _table(
    "SH_security_error_ring_buffer_recorded",
    "security_error_ring_buffer_recorded",
    {"SessionID": value(3, INT), **run(4, "error_code api_name calling_api_name")},
)

WAIT_INFO = _table(
    "SH_wait_info",
    "wait_info",
    {
        "WaitType": text(1),
        "OpCode": text(2),
        **run(3, "duration signal_duration"),
        "session_id": action(2),
        "SQLText": action(3),
    },
)

ERROR_REPORTED = _table(
    "SH_error_reported",
    "error_reported",
    {
        **run(1, "error_number severity state", BIGINT),
        "user_defined": value(4),
        "category": text(1),
        "destination": text(2),
        **run(7, "is_intercepted message"),
        "session_id": action(2),
        "database_id": action(3),
    },
)

SCHEDULER_DEADLOCK = _table(
    "SH_SchdMon_Deadlock_RB",
    "scheduler_monitor_deadlock_ring_buffer_recorded",
    {
        "OpCodeVal": value(3),
        **run(4, "NodeID ProcessUtilization SystemIdle", INT),
        **run(7, "UserModeTime KernelModeTime PageFaults WorkingSetDelta MemoryUtilization CallStack"),
    },
)

SCHEDULER_NON_YIELDING = _table(
    "SH_SchdMon_NonYield_RB",
    "scheduler_monitor_non_yielding_ring_buffer_recorded",
    {
        "OpCodeVal": value(3),
        "NodeID": value(4, INT),
        **run(5, "Scheduler Worker Yields WorkerUtilization ProcessUtilization SystemIdle"),
        **run(11, "UserModeTime KernelModeTime PageFaults WorkingSetDelta MemoryUtilization CallStack"),
    },
)

SCHEDULER_NON_YIELDING_RM = _table(
    "SH_SchdMon_NonYield_RM_RB",
    "scheduler_monitor_non_yielding_rm_ring_buffer_recorded",
    {
        "OpCodeVal": value(3),
        "NodeID": value(4, INT),
        **run(5, "Worker Yields WorkerUtilization ProcessUtilization SystemIdle"),
        **run(10, "UserModeTime KernelModeTime PageFaults WorkingSetDelta MemoryUtilization"),
        **run(15, "MemoryAllocation CallStack"),
    },
)

SCHEDULER_SYSTEM_HEALTH = _table(
    "SH_SchdMon_SysHealth_RB",
    "scheduler_monitor_system_health_ring_buffer_recorded",
    {
        **run(3, "ProcessUtilization SystemIdle"),
        **run(5, "UserModeTime KernelModeTime PageFaults WorkingSetDelta MemoryUtilization CallStack"),
    },
)

WAIT_INFO_EXTERNAL = _table(
    "SH_wait_info_ext",
    "wait_info_external",
    {
        "WaitTypeVal": value(1),
        "WaitTypeText": text(1),
        "OpCodeVal": value(2),
        "OpCodeText": text(2),
        "Duration": value(3),
        "SessionID": action(2),
        "SQLText": action(3),
        "CallStack": action(1),
    },
)


def _component(name: str, subsystem: str, columns: dict[str, Source], payload: dict[str, str]) -> TableSpec:
    return _table(
        name,
        "sp_server_diagnostics_component_result",
        {"SubSystem": text(1), "State": text(2), **columns},
        where=lambda: same(F.get("texts", F.lit(0)), subsystem),
        reads=frozenset({envelope.TEXTS}),
        spells=subsystem,
        payload=payload,
    )


COMPONENT_SYSTEM = _component("SH_sp_svr_diag_system", "SYSTEM", components.system(), components.SYSTEM_PAYLOAD)
COMPONENT_RESOURCE = _component(
    "SH_sp_svr_diag_resource", "RESOURCE", components.resource(), components.RESOURCE_PAYLOAD
)
COMPONENT_IO = _component(
    "SH_sp_svr_diag_IO",
    "IO_SUBSYSTEM",
    {**components.io(), "LongestPendingRequests": fragment("longestPendingRequests")},
    components.IO_PAYLOAD,
)
COMPONENT_QUERY = _component(
    "SH_sp_svr_diag_query", "QUERY_PROCESSING", components.query_processing(), components.QUERY_PAYLOAD
)

PENDING_REQUESTS = components.pending_requests("SH_pending_requests", COMPONENT_IO)
TOP_WAITS = components.top_waits("SH_top_waits", COMPONENT_QUERY)
CPU_REQUESTS = components.cpu_requests("SH_cpu_requests", COMPONENT_QUERY)

CONNECTIVITY = _table(
    "SH_connect_RB",
    "connectivity_ring_buffer_recorded",
    {
        "TypeVal": value(3),
        "TypeText": text(1),
        "Source": text(2),
        **run(5, "Session_ID OS_Error SNI_error SNI_consumer_error SNI_provider State LocalPort RemotePort"),
        **run(13, "TDSInputBufError TDSOutputBufError TDSInputBufBytes TDSFlags"),
        "TDSFlagsText": text(3),
        **run(17, "TotalLoginTimeMS LoginTaskEnquedMS NetworkWritesMS NetworkReadsMS SSLProcessingMS"),
        **run(22, "SSPIProcessingMS LoginTrig_ResGovProcessingMS ConnectionID ConnectionPeerID"),
        **run(26, "LocalHost RemoteHost CallStack"),
    },
)

TABLES = [
    SECURITY_ERROR,
    WAIT_INFO,
    ERROR_REPORTED,
    SCHEDULER_DEADLOCK,
    SCHEDULER_NON_YIELDING,
    SCHEDULER_NON_YIELDING_RM,
    SCHEDULER_SYSTEM_HEALTH,
    WAIT_INFO_EXTERNAL,
    COMPONENT_SYSTEM,
    COMPONENT_RESOURCE,
    COMPONENT_IO,
    COMPONENT_QUERY,
    CONNECTIVITY,
]
