"""Availability-group synchronisation status."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.lookup import in_order, join_on, name_of, renamed


def ag_sync_status(state: Mapping[str, DataFrame], full: bool = False, ordered: bool = True) -> DataFrame:
    """One row per database replica, with its replica, group and role where they are known.

    The database id is only shown for local rows (ids differ between servers); the name lookup
    runs for all rows. `full` appends every column of the four tables under drs_, ar_, ags_ and
    hars_.
    """
    drs = renamed(state["database_replica_states"], "drs_")
    ar = renamed(state["availability_replicas"], "ar_").withColumn("ar_key", F.col("ar_replica_id"))
    ags = renamed(state["availability_groups"], "ags_").withColumn("ags_key", F.col("ags_group_id"))
    hars = (
        renamed(state["replica_role_states"], "hars_")
        .withColumn("hars_group_key", F.col("hars_group_id"))
        .withColumn("hars_replica_key", F.col("hars_replica_id"))
    )
    rows = join_on(drs, ar, {"drs_replica_id": "ar_key"}, "left")
    rows = join_on(rows, ags, {"ar_group_id": "ags_key"}, "left")
    rows = join_on(
        rows, hars, {"ar_group_id": "hars_group_key", "ar_replica_id": "hars_replica_key"}, "left"
    )
    rows = name_of(rows, state["databases"], {"drs_database_id": "database_id"}, "name", "DBName")
    local_id = F.when(F.col("drs_is_local") == 1, F.col("drs_database_id")).alias("database_id")
    sync_state = F.col("drs_synchronization_state_desc").alias("SyncState")
    sync_mode = F.col("ar_availability_mode_desc").alias("SyncMode")
    progress = [
        F.col(f"drs_{c}").alias(c)
        for c in [
            "last_hardened_lsn",
            "end_of_log_lsn",
            "last_redone_lsn",
            "last_hardened_time",
            "last_redone_time",
            "log_send_queue_size",
            "redo_queue_size",
        ]
    ]
    head = [F.col("ags_name").alias("AGGroupName"), F.col("ar_replica_server_name").alias("InstanceName")]
    head += [F.col("hars_role_desc").alias("role_desc"), F.col("DBName")]
    if full:
        stars = [
            F.col(f"{p}{c}")
            for p, t in [
                ("drs_", "database_replica_states"),
                ("ar_", "availability_replicas"),
                ("ags_", "availability_groups"),
                ("hars_", "replica_role_states"),
            ]
            for c in state[t].columns
        ]
        columns = [*head, local_id, sync_mode, sync_state, *progress, *stars]
    else:
        columns = [*head, sync_state, sync_mode, local_id, *progress]
    ordered_rows = in_order(
        rows, ordered, "ags_name", "drs_group_database_id", "hars_role_desc", "ar_replica_server_name"
    )
    return ordered_rows.select(*columns)
