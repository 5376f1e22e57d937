"""Health log and wait capture: typed tables and reports.

Typed tables are registered with widths applied. Oracles read the derivation's plain columns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import logs
from catalogue.registry import big, num, register
from catalogue.state import DerivedState, oracle as state_oracle
from eventloom.operators.shred import bad_literals, settle, shred
from eventloom.operators.envelope import quarantine
from eventloom.plans import health_log as reports
from eventloom.plans import waits as wait_reports
from eventloom.tables import health_log as tables
from eventloom.tables.wait_capture import WAIT_INFO


def raw(spark, sf_dir):
    return logs.log(spark, sf_dir, logs.HEALTH_LOG, broken=True)


def typed(spec):
    return lambda spark, sf_dir: shred(raw(spark, sf_dir), spec, cut=True)


def report(make, spec):
    return lambda spark, sf_dir: make(settle(shred(raw(spark, sf_dir), spec, cut=True)))


def waits(spark, sf_dir):
    return shred(logs.log(spark, sf_dir, (logs.WAIT_EVENT,)), WAIT_INFO)


ERRORS = f"""
SELECT ts AS TimeStampUTC, {num('v_error_number')} AS error_number, {num('v_severity')} AS severity, {num('v_state')} AS state,
       left(v_user_defined, 5) AS user_defined, left(t_category, 25) AS category_desc, left(v_category, 5) AS category,
       left(v_destination, 20) AS destination, left(t_destination, 20) AS destination_desc,
       left(v_is_intercepted, 5) AS is_intercepted, v_message AS message
FROM {logs.ERROR_EVENT.oracle()}"""

DDL = f"""
SELECT left(object_name, 34) AS XEvent, ts AS TimeStampUTC, {num('v_ddl_action')} AS ddl_action, t_ddl_action AS ddl_action_desc,
       {num('v_ddl_phase')} AS ddl_phase, left(t_ddl_phase, 10) AS ddl_phase_desc,
       left(v_availability_group_name, 25) AS availability_group_name, left(v_availability_group_id, 36) AS availability_group_id,
       v_statement AS statement
FROM {logs.DDL_EVENT.oracle()}"""

LEASES = f"""
SELECT left(object_name, 33) AS XEvent, ts AS TimeStampUTC, left(v_availability_group_name, 25) AS AGName,
       left(v_availability_group_id, 36) AS AG_ID
FROM {logs.LEASE_EVENT.oracle()}"""

MANAGER = f"""
SELECT left(object_name, 42) AS XEvent, ts AS TimeStampUTC, {num('v_current_state')} AS current_state,
       left(t_current_state, 30) AS current_state_desc
FROM {logs.MANAGER_EVENT.oracle()}"""

STATES = f"""
SELECT left(object_name, 34) AS XEvent, ts AS TimeStampUTC, {num('v_current_state')} AS current_state,
       left(t_current_state, 20) AS current_state_desc, left(v_availability_group_name, 36) AS availability_group_name,
       left(v_availability_group_id, 36) AS availability_group_id, left(v_availability_replica_id, 36) AS availability_replica_id
FROM {logs.REPLICA_STATE_EVENT.oracle()}"""

CHANGES = f"""
SELECT left(object_name, 34) AS XEvent, ts AS TimeStampUTC,
       coalesce(left(v_availability_replica_name, 25), 'Data Unavailable') AS availability_replica_name,
       left(v_availability_group_name, 25) AS availability_group_name,
       {num('v_previous_state')} AS previous_state, left(t_previous_state, 30) AS previous_state_desc,
       {num('v_current_state')} AS current_state, left(t_current_state, 30) AS current_state_desc,
       left(v_availability_replica_id, 36) AS availability_replica_id, left(v_availability_group_id, 36) AS availability_group_id
FROM {logs.REPLICA_CHANGE_EVENT.oracle()}"""

LOCKS = f"""
SELECT left(object_name, 42) AS XEvent, ts AS TimeStampUTC, {num('v_resource_type')} AS ResourceType,
       left(t_resource_type, 25) AS ResourceTypeDesc, {num('v_mode')} AS Mode, left(t_mode, 25) AS ModeDesc,
       {num('v_owner_type')} AS OwnerType, left(t_owner_type, 25) AS OwnerTypeDesc, {big('v_transaction_id')} AS TransactionID,
       {num('v_database_id')} AS database_id, left(v_lockspace_workspace_id, 22) AS lockspace_workspace_id,
       {big('v_lockspace_sub_id')} AS lockspace_sub_id, {big('v_lockspace_nest_id')} AS lockspace_nest_id,
       {big('v_resource_0')} AS resource_0, CAST(0 AS BIGINT) AS resource_1, CAST(NULL AS BIGINT) AS resource_2,
       {big('v_object_id')} AS object_id, {big('v_associated_object_id')} AS associated_object_id,
       {num('v_duration')} AS duration, left(v_resource_description, 25) AS resource_description
FROM {logs.LOCK_EVENT.oracle()}"""

SYNC = f"""
SELECT left(object_name, 42) AS XEvent, ts AS TimeStampUTC, {num('v_database_id')} AS database_id,
       {num('v_commit_policy')} AS commit_policy, left(t_commit_policy, 20) AS commit_policy_desc,
       {num('v_commit_policy_target')} AS commit_policy_target, left(t_commit_policy_target, 20) AS commit_policy_target_desc,
       {num('v_sync_state')} AS sync_state, left(coalesce(t_sync_state_desc, t_sync_state), 20) AS sync_state_desc,
       left(v_sync_log_block, 20) AS sync_log_block, left(v_group_id, 36) AS group_id, left(v_replica_id, 36) AS replica_id,
       left(v_ag_database_id, 36) AS ag_database_id
FROM {logs.SYNC_EVENT.oracle()}"""

VALIDATION = f"""
SELECT left(object_name, 42) AS XEvent, ts AS TimeStampUTC, left(v_availability_replica_name, 25) AS availability_replica_name,
       left(v_availability_group_name, 25) AS availability_group_name, left(v_availability_replica_id, 36) AS availability_replica_id,
       left(v_availability_group_id, 36) AS availability_group_id, left(v_forced_quorum, 5) AS forced_quorum,
       left(v_joined_and_synchronized, 5) AS joined_and_synchronized,
       left(v_previous_primary_or_automatic_failover_target, 5) AS previous_primary_or_automatic_failover_target
FROM {logs.VALIDATION_EVENT.oracle()}"""

WAITS = f"""
SELECT object_name, ts AS TimeStamp, t_wait_type AS WaitType, {big('v_duration')} AS Duration,
       {big('v_signal_duration')} AS Signal_Duration, {num('a_v_session_id')} AS Session_ID,
       {num('a_v_scheduler_id')} AS Scheduler_ID, {num('a_v_event_sequence')} AS EventSequenceNum, event_data AS EventData
FROM {logs.WAIT_EVENT.oracle(True)}"""

for spec, sql in [
    (tables.ERROR_REPORTED, ERRORS),
    (tables.DDL_EXECUTED, DDL),
    (tables.LEASE_EXPIRED, LEASES),
    (tables.REPLICA_MANAGER_STATE_CHANGE, MANAGER),
    (tables.REPLICA_STATE, STATES),
    (tables.REPLICA_STATE_CHANGE, CHANGES),
    (tables.LOCK_REDO_BLOCKED, LOCKS),
    (tables.PARTNER_SYNC_STATE, SYNC),
    (tables.FAILOVER_VALIDATION, VALIDATION),
]:
    register(f"ao_{spec.table.lower().removeprefix('ao_')}", typed(spec), sql)
register("wait_info", waits, WAITS)

# Full values: the same table without widths.
register(
    "ao_error_reported_full_width",
    lambda spark, sf_dir: shred(raw(spark, sf_dir), tables.ERROR_REPORTED),
    f"""
SELECT ts AS TimeStampUTC, {num('v_error_number')} AS error_number, {num('v_severity')} AS severity, {num('v_state')} AS state,
       v_user_defined AS user_defined, t_category AS category_desc, v_category AS category,
       v_destination AS destination, t_destination AS destination_desc, v_is_intercepted AS is_intercepted, v_message AS message
FROM {logs.ERROR_EVENT.oracle()}""",
)

# ------------------------------------------------------------------------ reports

_KNOWN = " ".join(f"WHEN {n} THEN '{m}'" for n, m in reports.KNOWN_ERRORS.items())
_ISO = "'%Y-%m-%d %H:%M:%S.%g'"

ERROR_STATS = f"""
SELECT c.error_number AS ErrorNum, c.n AS ErrorCount, strftime(c.first_seen, {_ISO}) AS FirstDate,
       strftime(c.last_seen, {_ISO}) AS LastDate,
       left(CASE c.error_number {_KNOWN} ELSE m.text END, 81) AS "Abbreviated Message"
FROM (SELECT error_number, count(error_number) AS n, min(TimeStampUTC) AS first_seen, max(TimeStampUTC) AS last_seen
      FROM ({ERRORS}) GROUP BY error_number) c
LEFT JOIN {state_oracle('messages')} m ON c.error_number = m.message_id AND m.language_id = 1033"""


def error_event_stats(spark, sf_dir):
    state = DerivedState(spark, sf_dir)
    return reports.error_event_stats(shred(raw(spark, sf_dir), tables.ERROR_REPORTED), state["messages"])


register("error_event_stats", error_event_stats, ERROR_STATS)

register(
    "non_failover_ddl",
    report(reports.non_failover_ddl, tables.DDL_EXECUTED),
    f"""
SELECT TimeStampUTC, CAST(ddl_phase AS VARCHAR) AS ddl_phase, ddl_phase_desc,
       CASE WHEN length(rtrim(statement)) > 220 THEN left(statement, 1155) || chr(10)
            ELSE left(replace(statement, chr(10), ''), 220) END AS statement
FROM ({DDL})
WHERE statement NOT ILIKE '%FAILOVER%' OR (statement ILIKE '%FAILOVER%' AND statement ILIKE '%CREATE%')""",
)

_FAILOVER = f"""
SELECT TimeStampUTC, CAST(ddl_phase AS VARCHAR) AS ddl_phase, ddl_phase_desc,
       left(replace(statement, chr(10), ''), 80) AS statement
FROM ({DDL})
WHERE (statement ILIKE '%FAILOVER%' OR statement ILIKE '%FORCE%') AND statement NOT ILIKE """
register("failover_ddl", report(reports.failover_ddl, tables.DDL_EXECUTED), _FAILOVER + "'CREATE%'")
register(
    "failover_ddl_without_any_create",
    report(lambda t: reports.failover_ddl(t, exclude="%CREATE%"), tables.DDL_EXECUTED),
    _FAILOVER + "'%CREATE%'",
)
register(
    "replica_manager_state_changes",
    report(reports.replica_manager_state_changes, tables.REPLICA_MANAGER_STATE_CHANGE),
    f"SELECT strftime(TimeStampUTC, {_ISO}) AS TimeStampUTC, current_state_desc AS State FROM ({MANAGER})",
)
register("replica_states", report(reports.replica_states, tables.REPLICA_STATE), STATES)
register(
    "replica_state_changes",
    report(reports.replica_state_changes, tables.REPLICA_STATE_CHANGE),
    f"""SELECT TimeStampUTC, availability_group_name AS AGName, previous_state_desc AS "Prev state",
       current_state_desc AS "New State" FROM ({CHANGES})""",
)
register(
    "lease_expirations",
    report(reports.lease_expirations, tables.LEASE_EXPIRED),
    f"SELECT TimeStampUTC, AGName, AG_ID FROM ({LEASES})",
)
register("blocked_redo", report(reports.blocked_redo, tables.LOCK_REDO_BLOCKED), LOCKS)
register("partner_sync_state", report(reports.partner_sync_state, tables.PARTNER_SYNC_STATE), SYNC)
register("failover_validation", report(reports.failover_validation, tables.FAILOVER_VALIDATION), VALIDATION)

_LOGGED = " UNION ALL ".join(
    [f"SELECT '{x.event}' AS object_name FROM {x.table}" for x in logs.HEALTH_LOG]
    + ["SELECT 'error_reported' AS object_name FROM region"]
)
_COUNTS = f"(SELECT object_name, count(*) AS n FROM ({_LOGGED}) GROUP BY object_name)"


def _summary_oracle(seed: str) -> str:
    return f"""SELECT s.XEvent AS XEvent, coalesce(c.n, 0) AS "COUNT" FROM {seed} s
LEFT JOIN {_COUNTS} c ON s.XEvent = left(c.object_name, 50)"""


def names(spark, sf_dir):
    """Counting by event name asks for no other column of the log, so no event text is built, read or stored."""
    return logs.log_names(spark, sf_dir, logs.HEALTH_LOG)


def event_summary(version):
    def query(spark, sf_dir):
        events = names(spark, sf_dir)
        return reports.event_summary(events, reports.version_seed(events, version))

    return query


_SEED = "(SELECT unnest([" + ", ".join(f"'{n}'" for n in reports.known_event_names(11)) + "]) AS XEvent)"
_SEED_12 = "(SELECT unnest([" + ", ".join(f"'{n}'" for n in reports.known_event_names(12)) + "]) AS XEvent)"
register("event_summary", event_summary(12), _summary_oracle(_SEED_12))
register("event_summary_before_version_12", event_summary(11), _summary_oracle(_SEED))


def declared_event_summary(spark, sf_dir):
    state = DerivedState(spark, sf_dir)
    seed = reports.declared_events(state["xe_sessions"], state["xe_session_events"])
    return reports.event_summary(names(spark, sf_dir), seed)


register(
    "event_summary_of_declared_events",
    declared_event_summary,
    _summary_oracle(
        f"""(SELECT left(e.event_name, 50) AS XEvent FROM {state_oracle('xe_session_events')} e
 JOIN {state_oracle('xe_sessions')} x ON e.event_session_address = x.address WHERE x.name = 'AlwaysOn_Health')"""
    ),
)

_STATS = f"""SELECT Session_ID, WaitType, count(WaitType) AS Counts, CAST(sum(Duration) AS BIGINT) AS Sum_Duration,
 CAST(sum(Signal_Duration) AS BIGINT) AS Sum_SignalDuration FROM ({WAITS}) GROUP BY Session_ID, WaitType"""
register("wait_stats_by_count", lambda sp, d: wait_reports.wait_stats_by_count(waits(sp, d)), _STATS)
register("wait_stats_by_duration", lambda sp, d: wait_reports.wait_stats_by_duration(waits(sp, d)), _STATS)

# ---------------------------------------------------------------- envelope checks

register(
    "quarantined_events",
    lambda spark, sf_dir: quarantine(raw(spark, sf_dir)),
    """SELECT 'error_reported' AS object_name,
 '<event name="error_reported"><data name="error_number"><value>' || CAST(r_regionkey AS VARCHAR) AS event_data,
 'region_0_1.xel' AS file_name, CAST(r_regionkey AS BIGINT) AS file_offset FROM region""",
)

_BAD = {n: 0 for n, s in tables.LOCK_REDO_BLOCKED.columns.items() if s.kind in ("int", "bigint")}
register(
    "bad_literals",
    lambda spark, sf_dir: bad_literals(raw(spark, sf_dir), tables.LOCK_REDO_BLOCKED),
    "SELECT column_name, CASE WHEN column_name = 'resource_2' THEN (SELECT count(*) FROM orders) ELSE 0 END AS bad FROM "
    "(SELECT unnest([" + ", ".join(f"'{n}'" for n in _BAD) + "]) AS column_name)",
)



def routed_rows(spark, sf_dir):
    """Rows per typed table and in quarantine: together they are all routed records."""
    events = raw(spark, sf_dir)
    counted = [
        shred(events, spec).agg(F.count("*").alias("records")).select(F.lit(spec.table).alias("table_name"), "records")
        for spec in tables.TABLES
    ]
    counted.append(quarantine(events).agg(F.count("*").alias("records")).select(F.lit("quarantine").alias("table_name"), "records"))
    out = counted[0]
    for c in counted[1:]:
        out = out.unionByName(c)
    return out


register(
    "routed_rows",
    routed_rows,
    " UNION ALL ".join(
        [
            f"SELECT '{spec.table}' AS table_name, count(*) AS records FROM {x.table}"
            for spec, x in zip(tables.TABLES, logs.HEALTH_LOG)
        ]
        + ["SELECT 'quarantine' AS table_name, count(*) AS records FROM region"]
    ),
)
