"""Reports over the availability-group health log.

Every report takes a typed table (stored, or lazily shredded) and returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions import text as tx
from eventloom.functions.times import iso_text
from eventloom.operators.lookup import in_order, join_on
from eventloom.operators.shred import present_events, settle, shred
from eventloom.tables import health_log as logs

# Error numbers with an abbreviated message of their own.
KNOWN_ERRORS = {
    35202: "A connection for availability group ... has been successfully established...",
    1480: 'The %S_MSG database "%.*ls" is changing roles ... because the AG failed over ...',
    35206: "A connection timeout has occurred on a previously established connection ...",
    35201: "A connection timeout has occurred while attempting to establish a connection ...",
    41050: "Waiting for local WSFC service to start.",
    41051: "Local WSFC service started.",
    41052: "Waiting for local WSFC node to start.",
    41053: "Local WSFC node started.",
    41054: "Waiting for local WSFC node to come online.",
    41055: "Local WSFC node is online.",
    41048: "Local WSFC service has become unavailable.",
    41049: "Local WSFC node is no longer online.",
}
MESSAGE_WIDTH = 81
ENGLISH = 1033


def error_event_stats(errors: DataFrame, messages: DataFrame, ordered: bool = True) -> DataFrame:
    """Per error number: occurrences, first and last time, abbreviated message.

    Errors are counted before the catalogue is joined, so the join sees one row per number.
    Occurrences without a number form a group that counts 0.
    """
    counts = errors.groupBy(F.col("error_number").alias("ErrorNum")).agg(
        F.count("error_number").alias("ErrorCount"),
        F.min("TimeStampUTC").alias("first_seen"),
        F.max("TimeStampUTC").alias("last_seen"),
    )
    english = messages.where(F.col("language_id") == ENGLISH).select("message_id", "text")
    known = F.create_map(*[F.lit(x) for pair in KNOWN_ERRORS.items() for x in pair])
    described = join_on(counts, english, {"ErrorNum": "message_id"}, "left").select(
        "ErrorNum",
        "ErrorCount",
        iso_text(F.col("first_seen")).alias("FirstDate"),
        iso_text(F.col("last_seen")).alias("LastDate"),
        F.left(F.coalesce(F.try_element_at(known, F.col("ErrorNum")), F.col("text")), F.lit(MESSAGE_WIDTH)).alias(
            "Abbreviated Message"
        ),
    )
    return in_order(described, ordered, F.desc("ErrorCount"), "ErrorNum")



def _ddl_report(ddl: DataFrame, statement, ordered: bool) -> DataFrame:
    out = ddl.select(
        "TimeStampUTC",
        F.col("ddl_phase").cast("string").alias("ddl_phase"),
        "ddl_phase_desc",
        statement.alias("statement"),
    )
    return in_order(out, ordered, "TimeStampUTC")


def non_failover_ddl(ddl: DataFrame, ordered: bool = True) -> DataFrame:
    """DDL that is not a failover; CREATE statements that mention failover count as such."""
    stmt = F.col("statement")
    rows = ddl.where(~stmt.ilike("%FAILOVER%") | stmt.ilike("%CREATE%"))
    return _ddl_report(rows, tx.shorten_statement(stmt), ordered)


def failover_ddl(ddl: DataFrame, exclude: str = "CREATE%", ordered: bool = True) -> DataFrame:
    """Failover and forced-failover DDL.

    `exclude` is the pattern of statements left out: 'CREATE%' drops statements that begin with
    CREATE, '%CREATE%' those that contain it.
    """
    stmt = F.col("statement")
    rows = ddl.where((stmt.ilike("%FAILOVER%") | stmt.ilike("%FORCE%")) & ~stmt.ilike(exclude))
    return _ddl_report(rows, tx.shorten_failover_statement(stmt), ordered)


def replica_manager_state_changes(changes: DataFrame, ordered: bool = True) -> DataFrame:
    out = changes.select(
        iso_text(F.col("TimeStampUTC")).alias("TimeStampUTC"), F.col("current_state_desc").alias("State")
    )
    return in_order(out, ordered, "TimeStampUTC")


def replica_states(states: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(states, ordered, "TimeStampUTC")


def replica_state_changes(changes: DataFrame, ordered: bool = True) -> DataFrame:
    out = changes.select(
        "TimeStampUTC",
        F.col("availability_group_name").alias("AGName"),
        F.col("previous_state_desc").alias("Prev state"),
        F.col("current_state_desc").alias("New State"),
    )
    return in_order(out, ordered, "TimeStampUTC")


def lease_expirations(leases: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(leases.select("TimeStampUTC", "AGName", "AG_ID"), ordered, "TimeStampUTC")


def blocked_redo(blocked: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(blocked, ordered, "TimeStampUTC")


def partner_sync_state(states: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(states, ordered, "TimeStampUTC")


def failover_validation(rows: DataFrame, ordered: bool = True) -> DataFrame:
    return in_order(rows, ordered, "TimeStampUTC")


def known_event_names(major_version: int) -> list[str]:
    """The event types this product version can write."""
    return [t.event for t in logs.TABLES if major_version >= logs.SINCE_MAJOR_VERSION.get(t.event, 0)]


def declared_events(sessions: DataFrame, session_events: DataFrame, session_name: str = "AlwaysOn_Health") -> DataFrame:
    """The event types a capture session declares, as a seed for `event_summary`."""
    mine = sessions.where(tx.same(F.col("name"), session_name)).select("address")
    events = join_on(session_events, mine, {"event_session_address": "address"}, "left_semi")
    return events.select(F.left("event_name", F.lit(50)).alias("XEvent"))


def event_summary(raw: DataFrame, seed: DataFrame, ordered: bool = True) -> DataFrame:
    """Events per type, zero for seeded types that never occur; other types are left out."""
    counts = raw.groupBy(F.left("object_name", F.lit(50)).alias("XEvent")).agg(F.count("*").alias("n"))
    out = join_on(seed.select("XEvent"), counts, {"XEvent": "XEvent"}, "left").select(
        "XEvent", F.coalesce("n", F.lit(0)).alias("COUNT")
    )
    return in_order(out, ordered, F.desc("COUNT"), "XEvent")


def version_seed(raw: DataFrame, major_version: int) -> DataFrame:
    names = [(n,) for n in known_event_names(major_version)]
    return raw.sparkSession.createDataFrame(names, "XEvent string")


def all_reports(raw: DataFrame, messages: DataFrame, major_version: int = 12, cut: bool = False) -> dict[str, DataFrame]:
    """The reports whose events occur in `raw`; one aggregation decides, nothing else runs yet."""
    present = present_events(raw, logs.TABLES)

    def table(spec):
        return settle(shred(raw, spec, cut))

    makers = [
        (logs.ERROR_REPORTED, "error_event_stats", lambda t: error_event_stats(t, messages)),
        (logs.DDL_EXECUTED, "non_failover_ddl", non_failover_ddl),
        (logs.DDL_EXECUTED, "failover_ddl", failover_ddl),
        (logs.REPLICA_MANAGER_STATE_CHANGE, "replica_manager_state_changes", replica_manager_state_changes),
        (logs.REPLICA_STATE, "replica_states", replica_states),
        (logs.REPLICA_STATE_CHANGE, "replica_state_changes", replica_state_changes),
        (logs.LEASE_EXPIRED, "lease_expirations", lease_expirations),
        (logs.LOCK_REDO_BLOCKED, "blocked_redo", blocked_redo),
        (logs.PARTNER_SYNC_STATE, "partner_sync_state", partner_sync_state),
        (logs.FAILOVER_VALIDATION, "failover_validation", failover_validation),
    ]
    out = {name: make(table(spec)) for spec, name, make in makers if spec.event in present}
    out["event_summary"] = event_summary(raw, version_seed(raw, major_version))
    return out
