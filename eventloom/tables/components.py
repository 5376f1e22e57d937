"""Nested component payloads shared by the system-health and the cluster-diagnostics logs.

Fixed values: component names, attribute names and the order of the memory report.
"""

from __future__ import annotations

from eventloom.functions.typed import BIGINT, INT, STRING
from eventloom.operators.fragments import ListSpec
from eventloom.operators.specs import Source, TableSpec, attribute, fragment, nested


def _struct(names: list[str], *more: str) -> str:
    return "STRUCT<" + ", ".join([f"_{n} STRING" for n in names] + list(more)) + ">"


_SYSTEM = {
    "spinlockBackoffs": STRING,
    "sickSpinlockType": STRING,
    "sickSpinlockTypeAfterAv": STRING,
    "latchWarnings": INT,
    "isAccessViolationOccurred": INT,
    "writeAccessViolationCount": INT,
    "totalDumpRequests": INT,
    "intervalDumpRequests": INT,
    "pageFaults": INT,
    "systemCpuUtilization": INT,
    "sqlCpuUtilization": INT,
    "BadPagesDetected": INT,
    "BadPagesFixed": INT,
    "LastBadPageAddress": STRING,
    "nonYieldingTasksReported": INT,
}

_RESOURCE = {
    "lastNotification": STRING,
    "outOfMemoryExceptions": INT,
    "isAnyPoolOutOfMemory": INT,
    "processOutOfMemoryPeriod": INT,
}

_MEMORY_REPORT = {
    "AvailPhysMem": BIGINT,
    "AvailVirtMem": BIGINT,
    "AvailPagingFile": BIGINT,
    "WorkingSet": BIGINT,
    "%CommittedMemInWS": BIGINT,
    "PageFaults": BIGINT,
    "SysPhysMemHigh": INT,
    "SysPhysMemLow": INT,
    "ProcPhysMemLow": INT,
    "ProcVirtMemLow": INT,
    "VM Reserved": BIGINT,
    "VM Committed": BIGINT,
    "LckdPagesAllocated": BIGINT,
    "LargePagesAllocated": BIGINT,
    "Emergency Memory": BIGINT,
    "Emergency Memory In Use": BIGINT,
    "Target Committed": BIGINT,
    "Current Committed": BIGINT,
    "Pages Allocated": BIGINT,
    "Pages Reserved": BIGINT,
    "Pages Free": BIGINT,
    "Pages In Use": BIGINT,
    "Page Alloc Potential": BIGINT,
    "NUMA Growth Phase": BIGINT,
    "Last OOM Factor": BIGINT,
    "Last OS Error": BIGINT,
}

_IO = {"ioLatchTimeouts": INT, "intervalLongIos": INT, "totalLongIos": INT}

_QUERY = {
    "maxWorkers": INT,
    "workersCreated": INT,
    "workersIdle": INT,
    "tasksCompletedWithinInterval": INT,
    "pendingTasks": INT,
    "oldestPendingTaskWaitingTime": INT,
    "hasUnresolvableDeadlockOccurred": INT,
    "hasDeadlockedSchedulersOccurred": INT,
    "trackingNonYieldingScheduler": STRING,
}

_WAITS = "ARRAY<STRUCT<wait ARRAY<STRUCT<_waitType STRING>>>>"
_WAIT_KIND = f"ARRAY<STRUCT<byCount {_WAITS}, byDuration {_WAITS}>>"

SYSTEM_PAYLOAD = {"system": _struct(list(_SYSTEM))}
RESOURCE_PAYLOAD = {
    "resource": _struct(list(_RESOURCE), "memoryReport ARRAY<STRUCT<entry ARRAY<STRUCT<_value STRING>>>>")
}
IO_PAYLOAD = {
    "ioSubsystem": _struct(
        list(_IO), "longestPendingRequests ARRAY<STRUCT<pendingRequest ARRAY<STRUCT<_duration STRING, _filePath STRING>>>>"
    )
}
QUERY_PAYLOAD = {
    "queryProcessing": _struct(
        list(_QUERY), f"topWaits ARRAY<STRUCT<nonPreemptive {_WAIT_KIND}, preemptive {_WAIT_KIND}>>"
    )
}

# The lists inside components, with every attribute of their entries.
PENDING_REQUEST = {"duration": INT, "filePath": STRING, "offset": STRING, "handle": STRING}
TOP_WAIT = {"waitType": STRING, "waits": BIGINT, "averageWaitTime": BIGINT, "maxWaitTime": BIGINT}
CPU_REQUEST = {
    "sessionId": INT,
    "requestId": INT,
    "command": STRING,
    "taskAddress": STRING,
    "cpuUtilization": INT,
    "cpuTimeMs": BIGINT,
}

_EVERY_WAIT = f"ARRAY<STRUCT<wait ARRAY<{_struct(list(TOP_WAIT))}>>>"
_EVERY_WAIT_KIND = f"ARRAY<STRUCT<byCount {_EVERY_WAIT}, byDuration {_EVERY_WAIT}>>"
IO_LISTS_PAYLOAD = {
    "ioSubsystem": _struct(list(_IO), f"longestPendingRequests ARRAY<STRUCT<pendingRequest ARRAY<{_struct(list(PENDING_REQUEST))}>>>")
}
QUERY_LISTS_PAYLOAD = {
    "queryProcessing": _struct(
        list(_QUERY),
        f"topWaits ARRAY<STRUCT<nonPreemptive {_EVERY_WAIT_KIND}, preemptive {_EVERY_WAIT_KIND}>>",
        f"cpuIntensiveRequests ARRAY<STRUCT<request ARRAY<{_struct(list(CPU_REQUEST))}>>>",
    )
}
AVAILABILITY_GROUP_PAYLOAD = {"availabilityGroup": _struct(["resourceID", "leaseValid"])}

# For a stored parsed layer that serves every component table.
EVERY_PAYLOAD = {
    **SYSTEM_PAYLOAD,
    **RESOURCE_PAYLOAD,
    **IO_LISTS_PAYLOAD,
    **QUERY_LISTS_PAYLOAD,
    **AVAILABILITY_GROUP_PAYLOAD,
}


def system(without: tuple[str, ...] = ()) -> dict[str, Source]:
    return {n: attribute("system", n, kind) for n, kind in _SYSTEM.items() if n not in without}


def resource() -> dict[str, Source]:
    out = {n: attribute("resource", n, kind) for n, kind in _RESOURCE.items()}
    entries = "flatten(transform(resource.memoryReport, r -> coalesce(r.entry, array())))"
    for i, (name, kind) in enumerate(_MEMORY_REPORT.items()):
        out[name] = nested(f"get(filter({entries}._value, x -> x IS NOT NULL), {i})", kind)
    return out


def io() -> dict[str, Source]:
    return {n: attribute("ioSubsystem", n, kind) for n, kind in _IO.items()}


_PENDING = "flatten(transform(ioSubsystem.longestPendingRequests, r -> coalesce(r.pendingRequest, array())))"
_CPU = "flatten(transform(queryProcessing.cpuIntensiveRequests, r -> coalesce(r.request, array())))"


def _top_waits(kind: str, order: str) -> str:
    """The waits of one of the four lists, in document order."""
    orders = f"flatten(transform(queryProcessing.topWaits, w -> coalesce(w.{kind}, array()))).{order}"
    return f"flatten(transform(flatten(filter({orders}, o -> o IS NOT NULL)), o -> coalesce(o.wait, array())))"


def pending_requests(table: str, of: TableSpec) -> ListSpec:
    return ListSpec(table, of, IO_LISTS_PAYLOAD, [({}, _PENDING)], PENDING_REQUEST)


def top_waits(table: str, of: TableSpec) -> ListSpec:
    """The marks are the kind of wait and what the list is ordered by."""
    lists = [({"kind": k, "ordered": o}, _top_waits(k, o)) for k in ("nonPreemptive", "preemptive") for o in ("byCount", "byDuration")]
    return ListSpec(table, of, QUERY_LISTS_PAYLOAD, lists, TOP_WAIT)


def cpu_requests(table: str, of: TableSpec) -> ListSpec:
    return ListSpec(table, of, QUERY_LISTS_PAYLOAD, [({}, _CPU)], CPU_REQUEST)


def longest_pending_request() -> dict[str, Source]:
    requests = _PENDING

    def first(attr: str) -> str:
        return f"get(filter({requests}.{attr}, x -> x IS NOT NULL), 0)"

    return {"duration": nested(first("_duration"), INT), "filePath": nested(first("_filePath"))}


def query_processing() -> dict[str, Source]:
    out = {n: attribute("queryProcessing", n, kind) for n, kind in _QUERY.items()}

    def first_wait(kind: str, order: str) -> Source:
        return nested(f"get(filter({_top_waits(kind, order)}._waitType, x -> x IS NOT NULL), 0)")

    out["topNonPreemptWaitByCount"] = first_wait("nonPreemptive", "byCount")
    out["topNonPreemptWaitByDuration"] = first_wait("nonPreemptive", "byDuration")
    out["topPreemptWaitByCount"] = first_wait("preemptive", "byCount")
    out["topPreemptWaitByDuration"] = first_wait("preemptive", "byDuration")
    out["topWaits"] = fragment("topWaits")
    out["cpuIntensiveRequests"] = fragment("cpuIntensiveRequests")
    return out
