"""Server state tables derived from the given tables, as SQL both engines run.

`{ts}` is the zone-less timestamp type of the dialect.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
import re

from pyspark.sql import DataFrame, SparkSession

from catalogue.logs import clock, table

STATE_SQL = {
    "exec_requests": f"""
        SELECT CAST(o_custkey AS INT) AS session_id, 'conn-' || CAST(o_custkey AS STRING) AS connection_id,
               CAST(o_custkey % 25 AS INT) AS database_id, CAST(o_orderkey % 7 AS INT) AS blocking_session_id,
               CASE o_orderstatus WHEN 'P' THEN 'running' WHEN 'F' THEN 'suspended' ELSE 'background' END AS status,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'DB STARTUP' WHEN '2-HIGH' THEN 'PARALLEL REDO TASK'
                    WHEN '3-MEDIUM' THEN 'Parallel Redo Help Task' WHEN '4-NOT SPECIFIED' THEN 'SELECT'
                    ELSE 'INSERT' END AS command,
               CAST(floor(o_totalprice) AS BIGINT) AS cpu_time,
               CAST(floor(o_totalprice * 1000) AS BIGINT) AS total_elapsed_time,
               CAST(o_orderkey % 1000 AS BIGINT) AS wait_time, o_orderkey % 11 AS reads, o_orderkey % 13 AS writes,
               o_orderkey % 9973 AS logical_reads, o_custkey AS row_count,
               CASE WHEN o_orderstatus = 'F' THEN 'LCK_M_X' END AS wait_type,
               'KEY: ' || CAST(o_orderkey AS STRING) AS wait_resource,
               CAST(o_custkey % 100 AS INT) AS granted_query_memory,
               'sql-' || CAST(o_custkey AS STRING) AS sql_handle,
               'plan-' || CAST(o_orderkey % 400 AS STRING) AS plan_handle,
               CAST((o_orderkey % 50) * 2 AS INT) AS statement_start_offset,
               CAST(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE (o_orderkey % 50) * 2 + 2 * (o_custkey % 200) END AS INT) AS statement_end_offset
        FROM {{orders}}""",
    "exec_connections": f"""
        SELECT 'conn-' || CAST(c_custkey AS STRING) AS connection_id, CAST(c_custkey AS INT) AS session_id,
               '10.0.0.' || CAST(c_nationkey AS STRING) AS client_net_address,
               CAST({clock("c_custkey")} AS {{ts}}) AS connect_time, CAST({clock("(c_custkey + 1)")} AS {{ts}}) AS last_read,
               CAST({clock("(c_custkey + 2)")} AS {{ts}}) AS last_write
        FROM {{customer}}""",
    "exec_sessions": f"""
        SELECT CAST(c_custkey AS INT) AS session_id, CAST({clock("c_custkey")} AS {{ts}}) AS login_time, c_name AS login_name,
               'host-' || CAST(c_nationkey AS STRING) AS host_name, 'DOMAIN' AS nt_domain, lower(c_name) AS nt_user_name,
               CASE WHEN c_acctbal > 0 THEN 'running' ELSE 'sleeping' END AS status, c_mktsegment AS program_name,
               'ODBC' AS client_interface_name, CAST({clock("(c_custkey + 3)")} AS {{ts}}) AS last_request_start_time,
               CAST({clock("(c_custkey + 4)")} AS {{ts}}) AS last_request_end_time
        FROM {{customer}}""",
    "databases": "SELECT n_nationkey AS database_id, n_name AS name FROM {nation}",
    "objects": """
        SELECT CAST(p_partkey AS INT) AS object_id, CAST(p_partkey % 25 AS INT) AS database_id,
               'usp_' || p_type AS name FROM {part}""",
    "memory_grants": f"""
        SELECT CAST(c_custkey AS INT) AS session_id, CAST(c_nationkey % 8 AS INT) AS dop,
               CAST({clock("c_custkey")} AS {{ts}}) AS request_time,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN CAST({clock("(c_custkey + 5)")} AS {{ts}}) END AS grant_time,
               c_custkey * 1000 AS requested_memory_kb,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey * 900 END AS granted_memory_kb,
               c_custkey * 100 AS required_memory_kb, c_custkey * 850 AS max_used_memory_kb,
               CAST(c_acctbal AS DOUBLE) AS query_cost, CAST(c_nationkey * 10 AS INT) AS timeout_sec,
               CAST(c_custkey % 6 AS INT) AS resource_semaphore_id,
               CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey * 7 END AS wait_time_ms,
               CASE c_nationkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS is_next_candidate,
               'sql-' || CAST(c_custkey AS STRING) AS sql_handle
        FROM {{customer}}""",
    "resource_semaphores": """
        SELECT r_regionkey AS resource_semaphore_id, CAST(1000000 + r_regionkey AS BIGINT) AS target_memory_kb,
               CAST(CASE WHEN r_regionkey <> 1 THEN 2000000 + r_regionkey END AS BIGINT) AS max_target_memory_kb,
               CAST(900000 AS BIGINT) AS total_memory_kb, CAST(800000 + r_regionkey * 1023 AS BIGINT) AS available_memory_kb,
               CAST(700000 AS BIGINT) AS granted_memory_kb, CAST(600000 AS BIGINT) AS used_memory_kb,
               r_regionkey + 1 AS grantee_count, r_regionkey + 2 AS waiter_count,
               CASE WHEN r_regionkey <> 1 THEN r_regionkey END AS timeout_error_count, 0 AS forced_grant_count
        FROM {region}""",
    "memory_clerks": """
        SELECT 'MEMORYCLERK_' || p_type || '_' || CAST(p_size AS STRING) AS type, p_size * CAST(1000 AS BIGINT) AS pages_kb FROM {part}""",
    "performance_counters": """
        SELECT CASE WHEN s_nationkey = 3 THEN 'SQLServer:Buffer Manager' ELSE 'SQLServer:Memory Manager' END AS object_name,
               CASE s_suppkey % 7 WHEN 0 THEN 'Memory Grants Pending' WHEN 1 THEN 'Memory Grants Outstanding'
                    WHEN 2 THEN 'Target Server Memory (KB)' WHEN 3 THEN 'Total Server Memory (KB)'
                    WHEN 4 THEN 'Stolen Server Memory (KB)' WHEN 5 THEN 'Free Memory (KB)' ELSE 'Lock Memory (KB)' END AS counter_name,
               CAST(floor(s_acctbal) AS BIGINT) AS cntr_value
        FROM {supplier}""",
    "sql_text": """
        SELECT 'sql-' || CAST(doc_id AS STRING) AS sql_handle, text, CAST(doc_id % 25 AS INT) AS dbid,
               CAST(doc_id AS INT) AS objectid FROM {documents}""",
    "batch_plan": "SELECT 'plan-' || CAST(page_id AS STRING) AS plan_handle, html AS query_plan FROM {pages}",
    "query_plan": """
        SELECT 'plan-' || CAST(page_id AS STRING) AS plan_handle, CAST((page_id % 50) * 2 AS INT) AS statement_start_offset,
               CAST(CASE WHEN page_id % 3 = 0 THEN -1 ELSE (page_id % 50) * 2 + 60 END AS INT) AS statement_end_offset,
               html AS query_plan FROM {pages}""",
    "query_stats": """
        SELECT 'sql-' || CAST(l_partkey AS STRING) AS sql_handle, 'plan-' || CAST(l_partkey AS STRING) AS plan_handle,
               CAST((l_partkey % 50) * 2 AS INT) AS statement_start_offset,
               CAST(CASE WHEN l_partkey % 3 = 0 THEN -1 ELSE (l_partkey % 50) * 2 + 60 END AS INT) AS statement_end_offset,
               count(*) AS execution_count, min(l_shipdate) AS creation_time, max(l_shipdate) AS last_execution_time,
               CAST(sum(CAST(l_quantity AS BIGINT) * 1234567) AS BIGINT) AS total_elapsed_time,
               CAST(max(CAST(l_quantity AS BIGINT) * 1234567) AS BIGINT) AS max_elapsed_time,
               CAST(min(CAST(l_quantity AS BIGINT) * 1234567) AS BIGINT) AS last_elapsed_time,
               CAST(sum(CAST(l_quantity AS BIGINT) * 7654) AS BIGINT) AS total_worker_time,
               CAST(max(CAST(l_quantity AS BIGINT) * 7654) AS BIGINT) AS max_worker_time,
               CAST(min(CAST(l_quantity AS BIGINT) * 7654) AS BIGINT) AS last_worker_time,
               CAST(sum(l_suppkey) AS BIGINT) AS total_logical_reads, max(l_suppkey) AS max_logical_reads,
               min(l_suppkey) AS last_logical_reads, CAST(sum(l_linenumber) AS BIGINT) AS total_physical_reads,
               CAST(max(l_linenumber) AS BIGINT) AS max_physical_reads, CAST(min(l_linenumber) AS BIGINT) AS last_physical_reads,
               CAST(sum(l_orderkey) AS BIGINT) AS total_logical_writes, max(l_orderkey) AS last_logical_writes
        FROM {lineitem} GROUP BY l_partkey""",
    "plan_costs": "SELECT 'plan-' || CAST(p_partkey AS STRING) AS plan_handle, CAST(p_size AS BIGINT) AS compile_cost FROM {part}",
    "sql_modules": "SELECT CAST(doc_id AS INT) AS object_id, text AS definition FROM {documents}",
    "database_replica_states": f"""
        SELECT o_custkey + 10 AS replica_id, md5('gdb' || CAST(o_custkey % 50 AS STRING)) AS group_database_id,
               CAST(o_custkey % 30 AS INT) AS database_id, CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS is_local,
               CASE WHEN o_orderpriority = '5-LOW' THEN 'SYNCHRONIZING' ELSE 'SYNCHRONIZED' END AS synchronization_state_desc,
               o_orderkey * 1000 AS last_hardened_lsn, o_orderkey * 1000 + 7 AS end_of_log_lsn, o_orderkey * 999 AS last_redone_lsn,
               CAST({clock("o_orderkey")} AS {{ts}}) AS last_hardened_time, CAST({clock("(o_orderkey + 1)")} AS {{ts}}) AS last_redone_time,
               o_orderkey % 100 AS log_send_queue_size, o_orderkey % 77 AS redo_queue_size
        FROM {{orders}}""",
    "availability_replicas": """
        SELECT c_custkey AS replica_id, c_nationkey + 1 AS group_id, c_name AS replica_server_name,
               CASE WHEN c_acctbal > 0 THEN 'SYNCHRONOUS_COMMIT' ELSE 'ASYNCHRONOUS_COMMIT' END AS availability_mode_desc
        FROM {customer}""",
    "availability_groups": "SELECT n_nationkey AS group_id, n_name AS name FROM {nation}",
    "replica_role_states": """
        SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey ELSE c_nationkey + 1 END AS group_id, c_custkey AS replica_id,
               CASE WHEN c_custkey % 3 = 0 THEN 'PRIMARY' ELSE 'SECONDARY' END AS role_desc
        FROM {customer}""",
    "messages": """
        SELECT CAST(p_partkey AS INT) AS message_id, 1033 AS language_id,
               'Message of ' || p_name || ' ' || p_type || ' ' || p_brand || ' with a text that is longer than the report shows it' AS text FROM {part}
        UNION ALL
        SELECT CAST(p_partkey AS INT) AS message_id, 1031 AS language_id, 'Meldung ' || p_name AS text FROM {part}""",
    "xe_sessions": """
        SELECT 'addr-' || CAST(s_suppkey AS STRING) AS address,
               CASE s_nationkey % 3 WHEN 0 THEN 'AlwaysOn_Health' WHEN 1 THEN 'css_wait_info_' || CAST(s_suppkey AS STRING)
                    ELSE 'system_health' END AS name
        FROM {supplier}""",
    "xe_targets": """
        SELECT 'addr-' || CAST(s_suppkey AS STRING) AS event_session_address,
               CASE WHEN s_acctbal < 0 THEN 'ring_buffer' ELSE 'event_file' END AS target_name,
               CASE WHEN s_acctbal > 9000 THEN '<EventFileTarget/>' ELSE
               '<EventFileTarget truncated="0"><Buffers logged="9"/><File name="D:' || chr(92) || 'Log' || chr(92) || s_name ||
               chr(92) || 'AlwaysOn_health_0_' || CAST(s_suppkey AS STRING) || '.xel"/></EventFileTarget>' END AS target_data
        FROM {supplier}""",
    "xe_session_events": """
        SELECT 'addr-' || CAST(s_suppkey AS STRING) AS event_session_address,
               CASE s_suppkey % 5 WHEN 0 THEN 'error_reported' WHEN 1 THEN 'lock_redo_blocked' WHEN 2 THEN 'never_seen_event'
                    WHEN 3 THEN 'availability_replica_state' ELSE 'unlisted_event' END AS event_name
        FROM {supplier}""",
    "logreader_agents": "SELECT CASE WHEN n_nationkey = 4 THEN 'RETIRED' ELSE n_name END AS publisher_db FROM {nation}",
    "subscriptions": """
        SELECT 'NATION_' || CAST(c_nationkey AS STRING) AS publisher_db, CAST(c_custkey % 120 AS BIGINT) AS publication_id,
               c_nationkey + 2 AS subscriber_id, lower(c_mktsegment) AS subscriber_db FROM {customer}""",
    "publications": """
        SELECT s_suppkey AS publication_id, s_nationkey AS publisher_id, 'pub_' || CAST(s_nationkey AS STRING) AS publication,
               CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END AS immediate_sync, CASE WHEN s_nationkey % 2 = 0 THEN 1 ELSE 0 END AS allow_anonymous
        FROM {supplier}""",
    "replservers": "SELECT n_nationkey AS srvid, 'SERVER_' || n_name AS srvname FROM {nation}",
    "articles": "SELECT CAST(p_size AS BIGINT) AS publication_id, CASE WHEN p_type <> 'ECONOMY' THEN p_name END AS article FROM {part}",
    "snapshot_agents": """
        SELECT s_name || '-snapshot' AS name, 'pub_' || CAST(s_nationkey AS STRING) AS publication,
               'NATION_' || CAST(s_nationkey AS STRING) AS publisher_db FROM {supplier}""",
}

_TABLE = re.compile(r"\{(?!ts\})(\w+)\}")


def oracle(name: str) -> str:
    """DuckDB subquery of a state table."""
    return "(" + _TABLE.sub(r"\1", STATE_SQL[name]).replace("{ts}", "TIMESTAMP") + ")"


class DerivedState(Mapping[str, DataFrame]):
    """The state tables as DataFrames over the given parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir

    def __getitem__(self, name: str) -> DataFrame:
        sql = STATE_SQL[name].replace("{ts}", "TIMESTAMP_NTZ")
        inputs = {t: table(self._spark, self._dir, t) for t in set(_TABLE.findall(sql))}
        return self._spark.sql(sql, **inputs)

    def __iter__(self) -> Iterator[str]:
        return iter(STATE_SQL)

    def __len__(self) -> int:
        return len(STATE_SQL)
