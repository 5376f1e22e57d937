"""Availability-group health log (`AlwaysOn_health*.xel` exports).

Fixed values: event names, element names, output column names and widths are those of the log
and of the established table layout.
"""

from __future__ import annotations

from dataclasses import replace

from eventloom.functions.typed import BIGINT, INT
from eventloom.operators.specs import TableSpec, column, stamp, text, value

FILE_PATTERN = "AlwaysOn_health*.xel"

ERROR_REPORTED = TableSpec(
    table="error_reported",
    event="error_reported",
    columns={
        "TimeStampUTC": stamp(),
        "error_number": value("error_number", INT),
        "severity": value("severity", INT),
        "state": value("state", INT),
        "user_defined": value("user_defined", width=5),
        "category_desc": text("category", 25),
        "category": value("category", width=5),
        "destination": value("destination", width=20),
        "destination_desc": text("destination", 20),
        "is_intercepted": value("is_intercepted", width=5),
        "message": value("message"),
    },
)

DDL_EXECUTED = TableSpec(
    table="AO_ddl_executed",
    event="alwayson_ddl_executed",
    columns={
        "XEvent": column("object_name", 34),
        "TimeStampUTC": stamp(),
        "ddl_action": value("ddl_action", INT),
        "ddl_action_desc": text("ddl_action"),
        "ddl_phase": value("ddl_phase", INT),
        "ddl_phase_desc": text("ddl_phase", 10),
        "availability_group_name": value("availability_group_name", width=25),
        "availability_group_id": value("availability_group_id", width=36),
        "statement": value("statement"),
    },
)

LEASE_EXPIRED = TableSpec(
    table="AO_lease_expired",
    event="availability_group_lease_expired",
    columns={
        "XEvent": column("object_name", 33),
        "TimeStampUTC": stamp(),
        "AGName": value("availability_group_name", width=25),
        "AG_ID": value("availability_group_id", width=36),
    },
)

REPLICA_MANAGER_STATE_CHANGE = TableSpec(
    table="AR_Repl_Mgr_State_Change",
    event="availability_replica_manager_state_change",
    columns={
        "XEvent": column("object_name", 42),
        "TimeStampUTC": stamp(),
        "current_state": value("current_state", INT),
        "current_state_desc": text("current_state", 30),
    },
)

REPLICA_STATE = TableSpec(
    table="AR_state",
    event="availability_replica_state",
    columns={
        "XEvent": column("object_name", 34),
        "TimeStampUTC": stamp(),
        "current_state": value("current_state", INT),
        "current_state_desc": text("current_state", 20),
        "availability_group_name": value("availability_group_name", width=36),
        "availability_group_id": value("availability_group_id", width=36),
        "availability_replica_id": value("availability_replica_id", width=36),
    },
)

REPLICA_STATE_CHANGE = TableSpec(
    table="AR_state_change",
    event="availability_replica_state_change",
    columns={
        "XEvent": column("object_name", 34),
        "TimeStampUTC": stamp(),
        "availability_replica_name": value("availability_replica_name", width=25, default="Data Unavailable"),
        "availability_group_name": value("availability_group_name", width=25),
        "previous_state": value("previous_state", INT),
        "previous_state_desc": text("previous_state", 30),
        "current_state": value("current_state", INT),
        "current_state_desc": text("current_state", 30),
        "availability_replica_id": value("availability_replica_id", width=36),
        "availability_group_id": value("availability_group_id", width=36),
    },
)

LOCK_REDO_BLOCKED = TableSpec(
    table="lock_redo_blocked",
    event="lock_redo_blocked",
    columns={
        "XEvent": column("object_name", 42),
        "TimeStampUTC": stamp(),
        "ResourceType": value("resource_type", INT),
        "ResourceTypeDesc": text("resource_type", 25),
        "Mode": value("mode", INT),
        "ModeDesc": text("mode", 25),
        "OwnerType": value("owner_type", INT),
        "OwnerTypeDesc": text("owner_type", 25),
        "TransactionID": value("transaction_id", BIGINT),
        "database_id": value("database_id", INT),
        "lockspace_workspace_id": value("lockspace_workspace_id", width=22),
        "lockspace_sub_id": value("lockspace_sub_id", BIGINT),
        "lockspace_nest_id": value("lockspace_nest_id", BIGINT),
        "resource_0": value("resource_0", BIGINT),
        "resource_1": value("resource_1", BIGINT),
        "resource_2": value("resource_2", BIGINT),
        "object_id": value("object_id", BIGINT),
        "associated_object_id": value("associated_object_id", BIGINT),
        "duration": value("duration", INT),
        "resource_description": value("resource_description", width=25),
    },
)

PARTNER_SYNC_STATE = TableSpec(
    table="hadr_db_partner_set_sync_state",
    event="hadr_db_partner_set_sync_state",
    columns={
        "XEvent": column("object_name", 42),
        "TimeStampUTC": stamp(),
        "database_id": value("database_id", INT),
        "commit_policy": value("commit_policy", INT),
        "commit_policy_desc": text("commit_policy", 20),
        "commit_policy_target": value("commit_policy_target", INT),
        "commit_policy_target_desc": text("commit_policy_target", 20),
        "sync_state": value("sync_state", INT),
        # The description sits in an element of its own; logs that lack it carry it beside sync_state.
        "sync_state_desc": replace(text("sync_state_desc", 20), fallback=text("sync_state", 20)),
        "sync_log_block": value("sync_log_block", width=20),
        "group_id": value("group_id", width=36),
        "replica_id": value("replica_id", width=36),
        "ag_database_id": value("ag_database_id", width=36),
    },
)

FAILOVER_VALIDATION = TableSpec(
    table="availability_replica_automatic_failover_validation",
    event="availability_replica_automatic_failover_validation",
    columns={
        "XEvent": column("object_name", 42),
        "TimeStampUTC": stamp(),
        "availability_replica_name": value("availability_replica_name", width=25),
        "availability_group_name": value("availability_group_name", width=25),
        "availability_replica_id": value("availability_replica_id", width=36),
        "availability_group_id": value("availability_group_id", width=36),
        "forced_quorum": value("forced_quorum", width=5),
        "joined_and_synchronized": value("joined_and_synchronized", width=5),
        "previous_primary_or_automatic_failover_target": value(
            "previous_primary_or_automatic_failover_target", width=5
        ),
    },
)

TABLES = [
    ERROR_REPORTED,
    DDL_EXECUTED,
    LEASE_EXPIRED,
    REPLICA_MANAGER_STATE_CHANGE,
    REPLICA_STATE,
    REPLICA_STATE_CHANGE,
    LOCK_REDO_BLOCKED,
    PARTNER_SYNC_STATE,
    FAILOVER_VALIDATION,
]

# Event types that exist only from this product version on.
SINCE_MAJOR_VERSION = {PARTNER_SYNC_STATE.event: 12, FAILOVER_VALIDATION.event: 12}
