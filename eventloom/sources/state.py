"""Server state snapshots: one parquet folder per table."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

# The state tables the reports read.
STATE_TABLES = (
    "exec_requests",
    "exec_connections",
    "exec_sessions",
    "databases",
    "objects",
    "memory_grants",
    "resource_semaphores",
    "memory_clerks",
    "performance_counters",
    "sql_text",
    "query_plan",
    "batch_plan",
    "query_stats",
    "plan_costs",
    "sql_modules",
    "database_replica_states",
    "availability_replicas",
    "availability_groups",
    "replica_role_states",
    "messages",
    "xe_sessions",
    "xe_targets",
    "xe_session_events",
    "logreader_agents",
    "subscriptions",
    "publications",
    "replservers",
    "articles",
    "snapshot_agents",
)


class Snapshot(Mapping[str, DataFrame]):
    """Tables under `path`, opened when first asked for and pruned by the reports."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in STATE_TABLES:
            raise KeyError(name)
        return self._spark.read.parquet(f"{self._path}/{name}")

    def __iter__(self) -> Iterator[str]:
        return iter(STATE_TABLES)

    def __len__(self) -> int:
        return len(STATE_TABLES)
