"""Streaming, file formats, stored layers and change publishing.

Files written on the way go to the shared folder the session names.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue import logs
from catalogue.cluster_queries import RESOURCE, distinct_rows as oracle_rows
from catalogue.health_queries import ERRORS, STATES, WAITS
from catalogue.registry import ORACLES, register
from catalogue.state import DerivedState, oracle as state_oracle
from catalogue.state_queries import REDO
from eventloom.operators import publish
from eventloom.operators.shred import shred, sorted_out
from eventloom.plans.health_log import all_reports
from eventloom.plans.sessions import redo_requests
from eventloom.sources.capture_files import capture_files, read_captures
from eventloom.sources.events import only_files, read_event_documents, read_event_xml, read_events
from eventloom.sources.tables import loaded_tables, reload_tables, save, save_as_table, save_parsed, save_raw, save_tables, shared_folder
from eventloom.sources.tables import register as name_for_sql
from eventloom.sources.versions import Rejected
from eventloom.streaming.capture import capture_waits, capture_while_seen
from eventloom.streaming.ingest import append, append_table, distinct_rows, ingest_tables, ingested, ring_rows, write_batch
from eventloom.streaming.ledger import load_dumps, loaded_events
from eventloom.streaming.replicate import BucketedCopy, collect_changes, compact, current_copy, untaken
from eventloom.tables import cluster_diagnostics, components, health_log, system_health
from eventloom.tables.wait_capture import WAIT_INFO


def wait_log(spark, sf_dir):
    return logs.log(spark, sf_dir, (logs.WAIT_EVENT,))


# ---------------------------------------------------------------- capture

START = datetime(2024, 1, 5)
SPAN = timedelta(days=10)

_CAPTURED = f"""SELECT w.* FROM ({WAITS}) w JOIN (SELECT CAST(ts AS TIMESTAMP) AS t, v_opcode, a_v_event_sequence AS e
 FROM {logs.WAIT_EVENT.oracle()}) o ON w.EventSequenceNum = CAST(o.e AS BIGINT)
WHERE o.v_opcode = '1' AND w.Session_ID IN (SELECT session_id FROM {state_oracle('exec_requests')} WHERE {REDO})"""


def _redo_ids(spark, sf_dir):
    return redo_requests(DerivedState(spark, sf_dir)).select("session_id").distinct()


register(
    "captured_waits",
    lambda spark, sf_dir: capture_waits(wait_log(spark, sf_dir), _redo_ids(spark, sf_dir), START, SPAN),
    f"""{_CAPTURED} AND w.TimeStamp >= TIMESTAMP '{START}' AND w.TimeStamp < TIMESTAMP '{START + SPAN}'""",
)


def captured_waits_stream(spark, sf_dir):
    """The same filter on a stream of capture files."""
    base = shared_folder(spark)
    save_raw(wait_log(spark, sf_dir), f"{base}/capture")
    stream = read_events(spark, f"{base}/capture", stream=True, pattern="*.parquet")
    waits = capture_waits(stream, _redo_ids(spark, sf_dir))
    append(waits, f"{base}/waits", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(waits.schema).parquet(f"{base}/waits")


register("captured_waits_stream", captured_waits_stream, _CAPTURED)



def captured_intervals_stream(spark, sf_dir):
    """Redo sessions seen at their own times, and the waits of each for three days from then: two streams."""
    base = shared_folder(spark)
    seen = redo_requests(DerivedState(spark, sf_dir)).selectExpr("session_id", f"CAST({logs.clock('session_id')} AS TIMESTAMP_NTZ) AS seen_at")
    seen = save(seen, f"{base}/seen")
    wait_log(spark, sf_dir).drop("file_name").write.parquet(f"{base}/files")
    snapshots = spark.readStream.schema(seen.schema).parquet(f"{base}/seen")
    waits = capture_while_seen(read_events(spark, f"{base}/files", stream=True), snapshots, timedelta(days=3), timedelta(days=400))
    append(waits, f"{base}/waits", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(waits.schema).parquet(f"{base}/waits")


register(
    "captured_intervals_stream",
    captured_intervals_stream,
    f"""SELECT w.* FROM ({WAITS}) w JOIN (SELECT v_opcode, a_v_event_sequence AS e FROM {logs.WAIT_EVENT.oracle()}) o ON w.EventSequenceNum = CAST(o.e AS BIGINT)
WHERE o.v_opcode = '1' AND EXISTS (SELECT 1 FROM (SELECT session_id, CAST({logs.clock('session_id')} AS TIMESTAMP) AS seen_at FROM {state_oracle('exec_requests')} WHERE {REDO}) s
  WHERE s.session_id = w.Session_ID AND w.TimeStamp >= s.seen_at AND w.TimeStamp < s.seen_at + INTERVAL 3 DAY)""",
)

# --------------------------------------------------------------- ingestion


def ingested_waits_stream(spark, sf_dir):
    base = shared_folder(spark)
    wait_log(spark, sf_dir).drop("file_name").write.parquet(f"{base}/files")
    stream = read_events(spark, f"{base}/files", stream=True)
    append_table(stream, WAIT_INFO, f"{base}/wait_info", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/wait_info")


register("ingested_waits_stream", ingested_waits_stream, WAITS)


#: Files of an export that a stream follows: the number of its batches has a bound, and each is read by many tasks.
EXPORTED, ROW_GROUP = 24, 16 << 20


def export(events, path, files=EXPORTED):
    """Add files of records to a folder, `files` at most, however many tasks the records come from."""
    events.coalesce(files).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(path)


def ingested_health_stream(spark, sf_dir):
    """Rows of all health tables, fed by one stream in several batches; the last batch comes twice."""
    base = shared_folder(spark)
    log = logs.log(spark, sf_dir, logs.HEALTH_LOG, broken=True).drop("file_name")
    for part in range(2):
        export(log.where(F.col("file_offset") % 2 == part), f"{base}/files")
    stream = read_events(spark, f"{base}/files", stream=True, files_per_batch=12)
    ingest_tables(stream, health_log.TABLES, f"{base}/tables", f"{base}/checkpoint").awaitTermination()
    last = spark.read.parquet(f"{base}/tables/parsed").agg(F.max("batch")).first()[0]
    again = spark.read.parquet(f"{base}/tables/parsed/batch={last}").select("object_name", "event_data", "file_name", "file_offset")
    write_batch(save(again, f"{base}/again"), last, health_log.TABLES, f"{base}/tables")
    counts = [ingested(spark, f"{base}/tables", s).agg(F.count("*").alias("records")).select(F.lit(s.table).alias("table_name"), "records") for s in health_log.TABLES]
    return reduce(DataFrame.unionByName, counts)


_TABLE_ROWS = " UNION ALL ".join(f"SELECT '{spec.table}' AS table_name, count(*) AS records FROM {x.table}" for spec, x in zip(health_log.TABLES, logs.HEALTH_LOG))
register("ingested_health_stream", ingested_health_stream, _TABLE_ROWS)

# ------------------------------------------------------- duplicate removal


def ring_security_stream(spark, sf_dir):
    """Three and more batches whose events come in any order of time, repeated across batches."""
    base = shared_folder(spark)
    dumps = logs.log(spark, sf_dir, logs.CLUSTER_LOG).drop("file_name")
    for part in (2, 0, 1):
        export(dumps.where(F.col("file_offset") % 3 == part), f"{base}/files", 12)
    export(dumps.where(F.col("file_offset") % 7 == 0), f"{base}/files", 12)
    stream = read_events(spark, f"{base}/files", stream=True, files_per_batch=2)
    append(ring_rows(stream, cluster_diagnostics.RING_SECURITY), f"{base}/ring", f"{base}/checkpoint").awaitTermination()
    return distinct_rows(spark.read.parquet(f"{base}/ring"))


_SECURITY_FULL = """ts AS RBEventTimeStampUTC, v_id AS ID, v_timestamp AS "timestamp", v_session_id AS SessionID,
 v_error_code AS ErrorCode, v_api_name AS APIName, v_calling_api_name AS CallingAPIName"""
register("ring_security_stream", ring_security_stream, oracle_rows(_SECURITY_FULL, logs.RING_SECURITY))


def ring_security_ledger(spark, sf_dir):
    """The same dumps in four loads, late ones and repeats among them: a text is parsed once, a day without news is not touched."""
    path = f"{shared_folder(spark)}/ring"
    dumps = logs.log(spark, sf_dir, logs.CLUSTER_LOG)
    for name, part in [("c", F.col("file_offset") % 3 == 2), ("a", F.col("file_offset") % 3 == 0), ("b", F.col("file_offset") % 3 == 1), ("again", F.col("file_offset") % 7 == 0)]:
        load_dumps(dumps.where(part), cluster_diagnostics.RING_SECURITY, path, name)
    return loaded_events(spark, path, cluster_diagnostics.RING_SECURITY)


register("ring_security_ledger", ring_security_ledger, oracle_rows(_SECURITY_FULL, logs.RING_SECURITY))

# ------------------------------------------------------ file formats and layers


def errors_from(fmt: str):
    """Error events written in one file format and read back from it."""

    def query(spark, sf_dir):
        path = f"{shared_folder(spark)}/AlwaysOn_health"
        events = logs.raw_events(spark, sf_dir, logs.ERROR_EVENT)
        if fmt == "text":
            events.select("event_data").write.text(path)
        else:
            writer = events.drop("file_name").write.format(fmt)
            (writer.option("header", True).option("escape", '"') if fmt == "csv" else writer).save(path)
        return shred(read_events(spark, path, fmt), health_log.ERROR_REPORTED, cut=True)

    return query


for fmt in ("parquet", "orc", "json", "csv", "text"):
    register(f"events_from_{fmt}", errors_from(fmt), ERRORS)


def errors_from_xml(spark, sf_dir):
    """Event elements parsed by the file reader itself."""
    path = f"{shared_folder(spark)}/AlwaysOn_health"
    logs.raw_events(spark, sf_dir, logs.ERROR_EVENT).select("event_data").write.text(path)
    return shred(read_event_xml(spark, path, one_per_line=True), health_log.ERROR_REPORTED, cut=True)


register("events_from_xml", errors_from_xml, ERRORS)


def document(events, path, compression="none"):
    """Event elements of many lines under no line's bounds: one text a file, under a root."""
    events.select("event_data").write.option("lineSep", "  ").text(path, compression=compression)
    return path


def cluster_documents(spark, sf_dir):
    """Documents of the cluster log, in compressed files of a bounded number of events each: the text is many times the tables."""
    return document(logs.log(spark, sf_dir, logs.CLUSTER_LOG), f"{shared_folder(spark)}/SQLDIAG", "gzip")


def errors_from_documents(spark, sf_dir):
    """Multi-line documents split between tasks at their end tags."""
    path = document(logs.raw_events(spark, sf_dir, logs.ERROR_EVENT), f"{shared_folder(spark)}/AlwaysOn_health")
    return shred(read_event_documents(spark, path), health_log.ERROR_REPORTED, cut=True)


register("events_from_documents", errors_from_documents, ERRORS)


def document_offsets(spark, sf_dir):
    """Records and different places of documents whose records hold events of their own in dumps."""
    found = read_event_documents(spark, cluster_documents(spark, sf_dir))
    return found.groupBy("object_name").agg(F.count("*").alias("records"), F.countDistinct("file_name", "file_offset").alias("places"))


register(
    "document_offsets",
    document_offsets,
    "SELECT object_name, count(*) AS records, count(*) AS places FROM (" + " UNION ALL ".join(f"SELECT '{x.event}' AS object_name FROM {x.table}" for x in logs.CLUSTER_LOG) + ") GROUP BY object_name",
)


def ring_from_documents(spark, sf_dir):
    """Ring-buffer events of dumps that documents hold."""
    return shred(read_event_documents(spark, cluster_documents(spark, sf_dir)), cluster_diagnostics.RING_SECURITY)


register("ring_from_documents", ring_from_documents, oracle_rows(_SECURITY_FULL, logs.RING_SECURITY))


def stored_log(spark, log):
    """A derived log's raw layer: its tasks hold events of one type and a bounded number each, so they are not spread again."""
    return save_raw(log, f"{shared_folder(spark)}/raw", spread=False)


def stored_raw_layer(spark, sf_dir):
    """The raw log stored by event type; the route reads one partition."""
    raw = stored_log(spark, logs.log(spark, sf_dir, logs.HEALTH_LOG))
    return shred(raw, health_log.REPLICA_STATE, cut=True)


register("stored_raw_layer", stored_raw_layer, STATES)


def stored_parsed_layer(spark, sf_dir):
    """The parsed log stored as columns; shredding it parses nothing again."""
    parsed = save_parsed(logs.log(spark, sf_dir, logs.HEALTH_LOG), f"{shared_folder(spark)}/parsed")
    return shred(parsed, health_log.REPLICA_STATE, cut=True)


register("stored_parsed_layer", stored_parsed_layer, STATES)


def stored_parsed_components(spark, sf_dir):
    """A component table out of a parsed layer that serves all of them."""
    log = logs.log(spark, sf_dir, (logs.SD_COMPONENT,))
    parsed = save_parsed(log, f"{shared_folder(spark)}/parsed", components.EVERY_PAYLOAD)
    return shred(parsed, cluster_diagnostics.RESOURCE, cut=True)


register("stored_parsed_components", stored_parsed_components, RESOURCE)


def stored_tables(spark, sf_dir):
    """A typed table loaded, reloaded in place, and read back."""
    raw = logs.log(spark, sf_dir, logs.HEALTH_LOG)
    base = shared_folder(spark)
    save_tables(raw, [health_log.REPLICA_STATE], base, cut=True)
    return save_tables(raw, [health_log.REPLICA_STATE], base, cut=True)[health_log.REPLICA_STATE.table]


register("reloaded_table", stored_tables, STATES)


def catalogue_table(spark, sf_dir):
    """A typed table in the session's catalogue, loaded and loaded again under its name."""
    name, path = f"eventloom_{uuid.uuid4().hex}", f"{shared_folder(spark)}/states"
    states = shred(logs.log(spark, sf_dir, logs.HEALTH_LOG), health_log.REPLICA_STATE, cut=True)
    save_as_table(states.limit(0), name, path)
    return save_as_table(states, name, path)


register("reloaded_catalogue_table", catalogue_table, STATES)


def switched_tables(spark, sf_dir):
    """A family loaded; a second load does not pass its check, and readers keep the first."""
    base, log = shared_folder(spark), logs.log(spark, sf_dir, logs.HEALTH_LOG)
    specs = [health_log.REPLICA_STATE, health_log.LEASE_EXPIRED]
    reload_tables(log, specs, base, cut=True)
    try:
        reload_tables(log.where("file_offset % 2 = 0"), specs, base, cut=True, check=lambda name, t: t.count() >= loaded_tables(spark, base, specs)[name].count())
    except Rejected:
        pass
    return loaded_tables(spark, base, specs)[health_log.REPLICA_STATE.table]


register("switched_tables", switched_tables, STATES)


def saved_tables(sources, specs):
    """Rows of every typed table of a log, all written from one parse of each record."""

    def query(spark, sf_dir):
        saved = save_tables(logs.log(spark, sf_dir, sources, broken=True), specs, shared_folder(spark))
        counts = [df.agg(F.count("*").alias("records")).select(F.lit(name).alias("table_name"), "records") for name, df in saved.items()]
        return reduce(DataFrame.unionByName, counts)

    return query


register(
    "saved_tables",
    saved_tables(logs.HEALTH_LOG, health_log.TABLES),
    " UNION ALL ".join(f"SELECT '{spec.table}' AS table_name, count(*) AS records FROM {x.table}" for spec, x in zip(health_log.TABLES, logs.HEALTH_LOG)),
)


def guarded_reports(spark, sf_dir):
    """Rows of each report whose events occur in a stored log."""
    raw = stored_log(spark, logs.log(spark, sf_dir, logs.HEALTH_LOG, broken=True))
    made = all_reports(raw, DerivedState(spark, sf_dir)["messages"], cut=True)
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("records")).select(F.lit(n).alias("report"), "records") for n, df in made.items()])


register(
    "guarded_reports",
    guarded_reports,
    " UNION ALL ".join(
        f"SELECT '{n}' AS report, count(*) AS records FROM ({ORACLES[n]})"
        for n in "error_event_stats non_failover_ddl failover_ddl replica_manager_state_changes replica_states replica_state_changes "
        "lease_expirations blocked_redo partner_sync_state failover_validation event_summary".split()
    ),
)

# -------------------------------------------------------- every record accounted for


def accounted(sources, specs):
    """Records of a stored log by what became of them, odd ones included."""

    def query(spark, sf_dir):
        log = logs.log(spark, sf_dir, sources, broken=True).unionByName(logs.odd_events(spark, sf_dir))
        return sorted_out(stored_log(spark, log), specs).groupBy("fate").agg(F.count("*").alias("records"))

    return query


def _accounted(**fates) -> str:
    """Oracle: the records of each fate are the rows of the tables they were made from."""
    return " UNION ALL ".join(
        f"SELECT '{fate.replace('_', ' ')}' AS fate, " + " + ".join(f"(SELECT count(*) FROM {t})" for t in tables) + " AS records"
        for fate, tables in fates.items()
    )


_BROKEN = ["region", "region"]  # cut short, and under a foreign root
# Components that no table takes: of the server's own events, whose payload is no ring buffer here.
_SH, _SH_KNOWN = logs.SH_COMPONENT.oracle(), "upper(t_component) IN ('SYSTEM', 'RESOURCE', 'IO_SUBSYSTEM', 'QUERY_PROCESSING')"
_SD, _SD_EVENTS = logs.SD_COMPONENT.oracle(), "coalesce(lower(v_component_name) = 'events', FALSE)"
register(
    "accounted_health_log",
    accounted(logs.HEALTH_LOG, health_log.TABLES),
    _accounted(typed=[x.table for x in logs.HEALTH_LOG if x is not logs.UNLISTED_EVENT], unrouted=["nation", "nation"], quarantine=_BROKEN),
)
register(
    "accounted_system_health",
    accounted(logs.SYSTEM_HEALTH_LOG, system_health.TABLES),
    _accounted(
        typed=[x.table for x in logs.SYSTEM_HEALTH_LOG if x is not logs.SH_COMPONENT] + [f"{_SH} WHERE {_SH_KNOWN}"],
        unrouted=["nation", f"{_SH} WHERE NOT {_SH_KNOWN}"],
        quarantine=_BROKEN,
    ),
)
register(
    "accounted_cluster_log",
    accounted(logs.CLUSTER_LOG, cluster_diagnostics.TABLES),
    _accounted(
        typed=[f"{_SD} WHERE NOT {_SD_EVENTS}", logs.SD_STATUS.table, logs.SD_INFO.table],
        ring_buffer=[x.table for x in logs.SD_DUMPS],
        unrouted=["nation", f"{_SD} WHERE {_SD_EVENTS}"],
        quarantine=_BROKEN,
    ),
)


def raw_layer(sources):
    """The raw layer of a log, stored and read back in full."""
    columns = ["object_name", "event_data", "file_name", "file_offset"]
    return lambda spark, sf_dir: stored_log(spark, logs.log(spark, sf_dir, sources)).select(columns)


def _raw_oracle(sources) -> str:
    return " UNION ALL ".join(
        f"SELECT '{x.event}' AS object_name, {x.xml()} AS event_data, '{x.table}_0_1.xel' AS file_name, CAST({x.key} AS BIGINT) AS file_offset FROM {x.table}"
        for x in sources
    )


for _name, _sources in [("health_log", logs.HEALTH_LOG), ("system_health", logs.SYSTEM_HEALTH_LOG), ("cluster_log", logs.CLUSTER_LOG)]:
    register(f"raw_layer_{_name}", raw_layer(_sources), _raw_oracle(_sources))


def one_capture_file(spark, sf_dir):
    """Records of a single capture file, through a named view."""
    raw = stored_log(spark, logs.log(spark, sf_dir, logs.HEALTH_LOG))
    name_for_sql({"one_file_events": only_files(raw, f"{logs.LEASE_EVENT.table}_0_1.xel")})
    return spark.sql("SELECT object_name, file_offset FROM one_file_events")


register(
    "one_capture_file",
    one_capture_file,
    " UNION ALL ".join(
        f"SELECT '{x.event}' AS object_name, CAST({x.key} AS BIGINT) AS file_offset FROM {x.table}"
        for x in logs.HEALTH_LOG
        if x.table == logs.LEASE_EVENT.table
    ),
)



def resolved_capture(spark, sf_dir):
    """The exports of the health session's own capture, found in the server's tables; the scan opens no others."""
    base, state = shared_folder(spark), DerivedState(spark, sf_dir)
    log = logs.log(spark, sf_dir, (logs.ERROR_EVENT, logs.LEASE_EVENT, logs.MANAGER_EVENT)).drop("file_name")
    for folder, source in [("AlwaysOn_health_0_7", logs.ERROR_EVENT), ("AlwaysOn_health_of_others_0_7", logs.LEASE_EVENT), ("system_health_0_7", logs.MANAGER_EVENT)]:
        log.where(F.col("object_name") == source.event).write.parquet(f"{base}/exports/{folder}")
    files = capture_files(state["xe_sessions"], state["xe_targets"], "AlwaysOn_Health", "AlwaysOn_health*.xel")
    return read_captures(spark, f"{base}/exports/*", files).select("object_name", "file_offset")


register("resolved_capture", resolved_capture, "SELECT 'error_reported' AS object_name, event_id AS file_offset FROM events")

# ------------------------------------------------------------- publishing

_CUSTOMER = "c_custkey AS user_id, c_name AS name, c_acctbal AS value"
_FEED = """user_id, 'changed by ' || event_type AS name, value,
 CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'insert' ELSE 'update' END AS operation, event_id AS sequence"""


def _source(spark, sf_dir):
    return logs.table(spark, sf_dir, "customer").selectExpr(*[c.strip() for c in _CUSTOMER.split(",")])


def _feed(spark, sf_dir):
    return spark.sql(f"SELECT {_FEED} FROM {{events}}", events=logs.table(spark, sf_dir, "events"))


_APPLIED = f"""
WITH last AS (SELECT * FROM (SELECT {_FEED}, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1)
SELECT user_id, name, value FROM (SELECT {_CUSTOMER} FROM customer) c WHERE user_id NOT IN (SELECT user_id FROM last)
UNION ALL SELECT user_id, name, value FROM last WHERE lower(operation) <> 'delete'"""

register(
    "published_snapshot",
    lambda spark, sf_dir: publish.publish_snapshot(_source(spark, sf_dir), f"{shared_folder(spark)}/copy"),
    f"SELECT {_CUSTOMER} FROM customer",
)
register(
    "published_columns",
    lambda spark, sf_dir: publish.publish_snapshot(
        publish.article(_source(spark, sf_dir), without=["value"]), f"{shared_folder(spark)}/copy", existing="drop"
    ),
    "SELECT c_custkey AS user_id, c_name AS name FROM customer",
)
register(
    "applied_changes",
    lambda spark, sf_dir: publish.apply_changes(_source(spark, sf_dir), _feed(spark, sf_dir), ["user_id"]),
    _APPLIED,
)


def replicated_copy(spark, sf_dir):
    """A change stream collected, folded into the snapshot, and read."""
    base = shared_folder(spark)
    feed = _feed(spark, sf_dir)
    feed.write.parquet(f"{base}/feed")
    stream = spark.readStream.schema(feed.schema).parquet(f"{base}/feed")
    collect_changes(stream, f"{base}/changes", f"{base}/checkpoint").awaitTermination()
    snapshot = publish.publish_snapshot(_source(spark, sf_dir), f"{base}/snapshot")
    changes = spark.read.schema(feed.schema).parquet(f"{base}/changes")
    folded = compact(snapshot, changes, ["user_id"], f"{base}/folded")
    # Changes already folded in are applied once more without effect.
    return current_copy(folded, changes, ["user_id"])


register("replicated_copy", replicated_copy, _APPLIED)


def _late_source(spark, sf_dir):
    source = _source(spark, sf_dir)
    return source.unionByName(source.where("user_id = 1").withColumn("user_id", F.lit(None).cast("long")))


def _late_feed(spark, sf_dir):
    feed = _feed(spark, sf_dir)
    return feed.unionByName(feed.where("user_id <= 3").withColumn("user_id", F.lit(None).cast("long")))


def late_changes(spark, sf_dir):
    """The newest half of a feed is folded in first; the older half, repeats and NULL keys come later."""
    base = shared_folder(spark)
    source = _late_source(spark, sf_dir)
    feed = save(_late_feed(spark, sf_dir), f"{base}/feed")
    newest = spark.sql("SELECT * FROM {feed} WHERE sequence > (SELECT (min(sequence) + max(sequence)) DIV 2 FROM {feed})", feed=feed)
    folded = compact(source, newest, ["user_id"], f"{base}/folded")
    again = compact(folded, feed.unionByName(feed), ["user_id"], f"{base}/again")
    return current_copy(again, untaken(feed, again, ["user_id"]), ["user_id"])


def bucketed_copy(spark, sf_dir):
    """The same feed folded into a copy in buckets, the older half last and twice: only buckets with changes are written."""
    feed = save(_late_feed(spark, sf_dir), f"{shared_folder(spark)}/feed")
    newest = spark.sql("SELECT * FROM {feed} WHERE sequence > (SELECT (min(sequence) + max(sequence)) DIV 2 FROM {feed})", feed=feed)
    copy = BucketedCopy(spark, f"{shared_folder(spark)}/copy", ["user_id"], buckets=16)
    copy.create(_late_source(spark, sf_dir), newest)
    for changes in (feed.where("sequence % 3 = 0"), feed, feed.where("user_id < 40")):
        copy.compact(changes)
    return publish.visible(copy.read())


_LATE = f"""
WITH feed AS (SELECT {_FEED} FROM events), every AS (SELECT * FROM feed UNION ALL SELECT NULL, name, value, operation, sequence FROM feed WHERE user_id <= 3),
 last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY sequence DESC) AS rn FROM every) WHERE rn = 1),
 source AS (SELECT {_CUSTOMER} FROM customer UNION ALL SELECT NULL, c_name, c_acctbal FROM customer WHERE c_custkey = 1)
SELECT user_id, name, value FROM source s WHERE NOT EXISTS (SELECT 1 FROM last l WHERE l.user_id IS NOT DISTINCT FROM s.user_id)
UNION ALL SELECT user_id, name, value FROM last WHERE lower(operation) <> 'delete'"""
register("late_changes", late_changes, _LATE)
register("bucketed_copy", bucketed_copy, _LATE)
register(
    "added_column",
    lambda spark, sf_dir: publish.add_columns(
        _source(spark, sf_dir), _source(spark, sf_dir).withColumn("segment", F.lower("name"))
    ),
    f"SELECT {_CUSTOMER}, CAST(NULL AS VARCHAR) AS segment FROM customer UNION ALL "
    f"SELECT {_CUSTOMER}, lower(c_name) AS segment FROM customer",
)
