"""Registered queries against their oracles, on the smallest tables.

A selection per family runs by default; EVENTLOOM_ALL=1 runs every query.
"""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare, connect

SELECTION = [
    "ao_lock_redo_blocked",
    "ao_error_reported_full_width",
    "error_event_stats",
    "non_failover_ddl",
    "event_summary_of_declared_events",
    "wait_stats_by_count",
    "routed_rows",
    "quarantined_events",
    "system_errors",
    "sh_sp_svr_diag_resource_listing",
    "sh_sp_svr_diag_query_listing",
    "sh_connect_rb_listing",
    "sd_system",
    "sd_iosubsystem",
    "sd_agstate",
    "misc_events",
    "max_pending_io",
    "ring_error_reported",
    "ring_error_reported_first_per_record",
    "ring_resource_monitor",
    "ring_security_stream",
    "memory_grant_requests",
    "running_requests_by_cpu",
    "running_requests_elapsed",
    "procedure_stats",
    "ag_sync_status_full",
    "replication_topology",
    "capture_files",
    "captured_waits_stream",
    "events_from_xml",
    "stored_parsed_layer",
    "replicated_copy",
]
OWN = [n for n in entry.queries() if n not in entry.LLM_QUERIES]
NAMES = sorted(OWN) if os.environ.get("EVENTLOOM_ALL") else SELECTION


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, sf_dir, name):
    with connect(sf_dir) as con:
        assert compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["ErrorNum", "ErrorCount", "FirstDate", "LastDate", "Abbreviated Message"]
    assert df.count() > 0
