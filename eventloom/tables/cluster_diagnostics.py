"""Failover-cluster diagnostics log (`*SQLDIAG_*.xel` exports).

Fixed values: event names, component names, positions, output column names and widths.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.text import one_of, same
from eventloom.functions.typed import DATETIME
from eventloom.operators import envelope
from eventloom.operators.specs import Source, TableSpec, attribute, column, run, stamp, text, type_name, value
from eventloom.tables import components

FILE_PATTERN = "*SQLDIAG_*.xel"

COMPONENT_EVENT = "component_health_result"
AVAILABILITY_GROUP = "alwaysOn:AvailabilityGroup"
KNOWN_COMPONENTS = ("resource", "io_subsystem", "system", "query_processing", "events")


def _object_name() -> dict[str, Source]:
    return {"ObjectName": column("object_name", 15)}


def _nth_value(n: int) -> Column:
    return F.get(F.col("values"), F.lit(n - 1))


def _component(name: str, component: str, columns: dict[str, Source], payload: dict[str, str]) -> TableSpec:
    common = {
        **_object_name(),
        "Component": value(5),
        "TimeStampUTC": stamp(),
        "CreationTime": value(3, DATETIME),
        "State_Desc": value(6),
    }
    return TableSpec(
        table=name,
        # Only this event type carries components, so the route can prune on the event name.
        event=COMPONENT_EVENT,
        columns={**common, **columns},
        where=lambda: same(_nth_value(5), component),
        reads=frozenset({envelope.VALUES}),
        spells=component,
        spells_at=5,
        payload=payload,
    )


SYSTEM = _component(
    "SD_System", "system", components.system(without=("totalDumpRequests",)), components.SYSTEM_PAYLOAD
)
IO_SUBSYSTEM = _component(
    "SD_iosubsystem",
    "io_subsystem",
    {**components.io(), **components.longest_pending_request()},
    components.IO_PAYLOAD,
)
QUERY = _component(
    "SD_query", "query_processing", components.query_processing(), components.QUERY_PAYLOAD
)
RESOURCE = _component("SD_resource", "resource", components.resource(), components.RESOURCE_PAYLOAD)

PENDING_REQUESTS = components.pending_requests("SD_pending_requests", IO_SUBSYSTEM)
TOP_WAITS = components.top_waits("SD_top_waits", QUERY)
CPU_REQUESTS = components.cpu_requests("SD_cpu_requests", QUERY)

GROUP_STATUS_CHANGE = TableSpec(
    table="SD_AGStatusChange",
    event="availability_group_state_change",
    columns={
        **_object_name(),
        "TimeStampUTC": stamp(),
        "InstanceName": value(5, width=25),
        "AGName": value(4, width=25),
        "TargetState": value(1, width=11),
        "TargetStateDesc": text(1, 25),
        "FailureConditionLevel": value(2, width=21),
        "HealthState": text(2, 25),
        "AGClusterResourceID": value(3, width=36),
    },
)

INFO_MESSAGE = TableSpec(
    table="SD_InfoMessage",
    event="info_message",
    columns={
        **_object_name(),
        "TimeStampUTC": stamp(),
        "NodeName": value(3, width=25),
        "InstanceName": value(2, width=25),
        "InfoMessage": value(1),
    },
)


def _unknown_component() -> Column:
    return ~one_of(_nth_value(5), KNOWN_COMPONENTS) & ~same(_nth_value(4), AVAILABILITY_GROUP)


MISC = TableSpec(
    table="SD_misc",
    event=COMPONENT_EVENT,
    columns={
        **_object_name(),
        "TimeStampUTC": stamp(),
        "Component": value(5),
        "EventData": column("event_data"),
    },
    where=_unknown_component,
    reads=frozenset({envelope.VALUES}),
)

GROUP_STATE = TableSpec(
    table="SD_AGState",
    event=COMPONENT_EVENT,
    columns={
        **_object_name(),
        "NodeName": value(9, width=25),
        "InstanceName": value(8, width=25),
        "AGName": value(5),
        "TimeStampUTC": stamp(),
        "CreationTimeUTC": value(3, DATETIME),
        "State": value(1, width=10),
        "State_Desc": value(6, width=25),
        "FailureConditionLevel": value(2, width=25),
        "AGResourceID": attribute("availabilityGroup", "resourceID", width=36),
        "LeaseValid": attribute("availabilityGroup", "leaseValid", width=10),
    },
    where=lambda: same(_nth_value(4), AVAILABILITY_GROUP),
    reads=frozenset({envelope.VALUES}),
    spells=AVAILABILITY_GROUP,
    spells_at=4,
    payload=components.AVAILABILITY_GROUP_PAYLOAD,
)


def _ring(name: str, event: str, columns: dict[str, Source]) -> TableSpec:
    return TableSpec(
        table=name,
        event=COMPONENT_EVENT,
        columns={"RBEventTimeStampUTC": stamp(), **columns},
        ring_buffer=event,
    )


RING_ERROR_REPORTED = _ring(
    "SD_events_RB_error_reported",
    "error_reported",
    {
        "ErrorNumber": value(1, width=11),
        **run(2, "Severity State UserDefined Category", width=10),
        "CategoryDesc": text(5, 15),
        "Destination": value(6, width=11),
        "DestinationDesc": text(6, 35),
        "IsIntercepted": value(7, width=13),
        "Message": value(8),
    },
)

RING_SCHEDULER_MONITOR = _ring(
    "SD_events_RB_schedmon",
    "scheduler_monitor_system_health_ring_buffer_recorded",
    {
        "ID": value(1, width=10),
        "timestamp": value(2, width=20),
        "process_utilization": value(3, width=19),
        "system_idle": value(4, width=11),
        **run(5, "user_mode_time kernel_mode_time", width=20),
        "page_faults": value(7, width=11),
        "working_set_delta": value(8, width=20),
        "memory_utilization": value(9, width=18),
    },
)

RING_RESOURCE_MONITOR = _ring(
    "SD_events_RB_ResourceMon",
    "resource_monitor_ring_buffer_recorded",
    {
        "ID": value(1, width=10),
        "timestamp": value(2, width=20),
        "NodeID": value(22, width=10),
        "memory_node_id": value(11, width=10),
        **run(
            3,
            "MemoryUtilizationPct TotalPhysicalMemoryKB AvailPhysicalMemoryKB TotalPageFileKB AvailPageFileKB "
            "TotalVirtualAddressSpaceKB AvailVirtualAddressSpaceKB AvailExtndVirtualAddrSpaceKB",
            width=20,
        ),
        **run(12, "TargetKB ReservedKB CommittedKB SharedCommittedKB AWE_KB Pages_KB", width=20),
        "NotificationType": type_name(18, 20),
        "NotificationValue": value(18, width=20),
        "NotificationText": text(1, 20),
        **run(19, "ProcessIndicators SystemIndicators PoolIndicators", width=10),
        "ApplyLowPMValue": value(23, width=10),
        "ApplyLowPMText": text(2, 10),
        "ApplyHighPMValue": value(24, width=10),
        "ApplyHighPMText": text(3, 10),
        "RevertHighPMValue": value(25, width=10),
        "RevertHighPMText": text(4, 10),
    },
)

RING_CONNECTIVITY = _ring(
    "SD_events_RB_Connectivity",
    "connectivity_ring_buffer_recorded",
    {
        "ID": value(1, width=10),
        "timestamp": value(2, width=20),
        "ConnectivityRecordType": value(3, width=10),
        "ConnectivityRecordTypeDesc": text(1, 20),
        "Source": value(4, width=20),
        "SourceType": text(2, 20),
        **run(
            5,
            "SessionID OSError SNIError SNIConsumerError SNIProvider State LocalPort RemotePort "
            "TDSInputBufferError TDSOutputBufferError TDSInputBufferBYtes TDSFlag",
            width=10,
        ),
        "TDSFlagDesc": text(3, 30),
        **run(17, "total_login_time_ms login_task_enqueued_ms network_writes_ms network_reads_ms", width=10),
        **run(21, "ssl_processing_ms sspi_processing_ms", width=10),
        "login_trigger_and_resource_governor_processing_ms": value(23, width=10),
        **run(24, "connection_id connection_peer_id", width=36),
        **run(26, "local_host remote_host", width=15),
    },
)

RING_SECURITY = _ring(
    "SD_events_RB_Security",
    "security_error_ring_buffer_recorded",
    {
        "ID": value(1, width=10),
        "timestamp": value(2, width=20),
        **run(3, "SessionID ErrorCode", width=10),
        **run(5, "APIName CallingAPIName", width=30),
    },
)

RING_TABLES = [
    RING_ERROR_REPORTED,
    RING_SCHEDULER_MONITOR,
    RING_RESOURCE_MONITOR,
    RING_CONNECTIVITY,
    RING_SECURITY,
]

TABLES = [
    SYSTEM,
    IO_SUBSYSTEM,
    QUERY,
    RESOURCE,
    GROUP_STATUS_CHANGE,
    INFO_MESSAGE,
    MISC,
    *RING_TABLES,
    GROUP_STATE,
]
