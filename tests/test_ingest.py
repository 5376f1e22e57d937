"""One parse for many tables, late parse, intervals of two streams, the ledger, buckets and switched versions."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from eventloom.operators import publish
from eventloom.operators.envelope import parse
from eventloom.operators.shred import shred
from eventloom.sources import versions
from eventloom.sources.events import read_events
from eventloom.sources.tables import loaded_tables, reload_tables
from eventloom.streaming import ingest
from eventloom.streaming.capture import capture_waits, capture_while_seen, glimpsed
from eventloom.streaming.ledger import load_dumps, loaded_events, new_texts
from eventloom.streaming.replicate import BucketedCopy
from eventloom.tables import cluster_diagnostics as sd
from eventloom.tables import health_log
from tests.helpers import action, component, data, event, raw, ring
from tests.test_flow import wait


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def files_of(folder):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/**/*.parquet", recursive=True)}


# ---- late parse


def odd_wait(session, body):
    return event("wait_info", data("opcode", "1") + body + action("event_sequence", "1") + (action("session_id", session) if session else ""))


ODD = [
    odd_wait(None, '<action package="p" name=\'session_id\'>\n <type name="x"/> <value> 1 </value></action>'),
    odd_wait(None, '<action name="session_id"><value>&#49;</value></action>'),
    odd_wait(None, '<action name="session_id"><value><![CDATA[1]]></value></action>'),
    odd_wait(2, "<!-- <action name=\"session_id\"><value>1</value></action> -->"),
    odd_wait(None, '<data name="note"><value>session_id</value></data><action name="session_id"><value>1</value></action>'),
    odd_wait(1, '<data name="session_id"><value>2</value></data>'),
    odd_wait(None, ""),
    odd_wait("1" * 12, ""),
    '<event name="wait_info"><action name="session_id"><value>1</value></action>',
]


def test_late_parse_keeps_every_captured_wait(spark):
    events = raw(spark, *ODD, *[wait(i % 5, opcode=i % 3) for i in range(60)], name="wait_info")
    sessions = spark.createDataFrame([(1,), (3,), (None,)], "session_id int")
    got = capture_waits(events, sessions)
    rows = lambda df: sorted((r.EventData, r.Session_ID) for r in df.collect())
    late = rows(got)
    # what a full parse would capture: the parsed layer skips the glimpse
    assert late == rows(capture_waits(parse(events), sessions)) and len(late) == 5 + 8
    assert sum(e in {x for x, _ in late} for e in ODD) == 5


def test_sessions_are_met_below_the_parse(spark):
    events = raw(spark, *[wait(i) for i in range(10)], name="wait_info")
    plan = plan_of(capture_waits(events, spark.createDataFrame([(1,)], "session_id int")))
    lines = plan.splitlines()
    parse = next(i for i, x in enumerate(lines) if "from_xml" in x)
    joins = [i for i, x in enumerate(lines) if "Join LeftSemi" in x]
    assert any(i < parse for i in joins) and any(i > parse for i in joins)
    glimpse = events.select(glimpsed("action", "session_id").alias("s"), glimpsed("data", "opcode").alias("o")).collect()
    assert [(r.s, r.o) for r in glimpse] == [(i, 1) for i in range(10)]


# ---- intervals of two streams


def minute(m, s=0):
    return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=m, seconds=s)


def waits_at(*at):
    return [wait(session, ts=f"{minute(m, s).isoformat()}Z") for session, m, s in at]


def test_capture_while_seen(spark, tmp_path):
    """Sessions that come and go, each captured in its own intervals; the state lets go of what is past."""
    seen_schema = "session_id int, seen_at timestamp_ntz"
    rounds = [
        ([(1, 0)], [(1, 0, 30), (2, 0, 30), (1, 1, 30)]),
        ([(2, 10), (1, 10)], [(1, 9, 59), (2, 10, 0), (2, 10, 59), (1, 11, 0), (1, 10, 59)]),
        ([(1, 20), (1, 20)], [(2, 20, 1), (1, 20, 1)]),
        ([(3, 30)], [(3, 30, 0), (3, 29, 59)]),
    ]
    want = [(1, minute(0, 30)), (2, minute(10)), (2, minute(10, 59)), (1, minute(10, 59)), (1, minute(20, 1)), (3, minute(30))]
    everything = [[], []]
    state = []
    for seen, waits in rounds:
        everything[0] += seen
        everything[1] += waits
        spark.createDataFrame([(s, minute(m)) for s, m in seen], seen_schema).write.mode("append").parquet(f"{tmp_path}/seen")
        raw(spark, *waits_at(*waits), name="wait_info").drop("file_name").write.mode("append").parquet(f"{tmp_path}/waits")
        stream = capture_while_seen(read_events(spark, f"{tmp_path}/waits", stream=True), spark.readStream.schema(seen_schema).parquet(f"{tmp_path}/seen"), lateness=dt.timedelta(seconds=5))
        query = ingest.append(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
        query.awaitTermination()
        state.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    got = [(r.Session_ID, r.TimeStamp) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got) == sorted(want)
    assert state[-1] <= 6  # of 17 rows that came in
    batch = capture_while_seen(raw(spark, *waits_at(*everything[1]), name="wait_info"), spark.createDataFrame([(s, minute(m)) for s, m in everything[0]], seen_schema))
    assert sorted((r.Session_ID, r.TimeStamp) for r in batch.collect()) == sorted(want)


# ---- all tables of a log from one stream


def health_events(n):
    error = event("error_reported", data("error_number", str(n)))
    lease = event("availability_group_lease_expired", data("availability_group_name", f"g{n}"))
    return [("error_reported", error), ("availability_group_lease_expired", lease), ("error_reported", "<event broken")]


def test_one_stream_feeds_all_tables(spark, tmp_path):
    path, specs = f"{tmp_path}/tables", health_log.TABLES
    counts = lambda: {s.table: ingest.ingested(spark, path, s).count() for s in specs}
    for n in range(3):
        raw(spark, *health_events(n)).drop("file_name").coalesce(1).write.mode("append").parquet(f"{tmp_path}/files")
        stream = read_events(spark, f"{tmp_path}/files", stream=True, files_per_batch=1)
        ingest.ingest_tables(stream, specs, path, f"{tmp_path}/cp").awaitTermination()
    want = {s.table: 3 if s.event in ("error_reported", "availability_group_lease_expired") else 0 for s in specs}
    assert counts() == want
    assert sorted(r.error_number for r in ingest.ingested(spark, path, health_log.ERROR_REPORTED).collect()) == [0, 1, 2]
    # a batch whose end was not recorded comes again
    commits = sorted(f for f in os.listdir(f"{tmp_path}/cp/commits") if f.isdigit())
    for f in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{tmp_path}/cp/commits/{f}"):
            shutil.move(f"{tmp_path}/cp/commits/{f}", f"{tmp_path}/moved{f}")
    ingest.ingest_tables(read_events(spark, f"{tmp_path}/files", stream=True, files_per_batch=1), specs, path, f"{tmp_path}/cp").awaitTermination()
    assert counts() == want
    # a batch that breaks off behind its first table is not seen, and is whole when it comes again
    batch = raw(spark, *health_events(7))
    broken = [specs[0], None]
    with pytest.raises(AttributeError):
        ingest.write_batch(batch, 99, broken, path)
    with pytest.raises(ZeroDivisionError):
        ingest.write_batch(batch, 99, [*specs, Failing()], path)
    assert counts() == want
    ingest.write_batch(batch, 99, specs, path)
    assert counts()["error_reported"] == 4


class Failing:
    """A specification that fails when it is reached."""

    payload: dict = {}

    @property
    def table(self):
        return 1 // 0

    ring_buffer = event = where = None
    columns: dict = {}


def test_one_stream_parses_each_record_once(spark, tmp_path):
    """What is shredded is the stored parsed layer."""
    ingest.write_batch(raw(spark, *health_events(1)), 0, [health_log.ERROR_REPORTED], str(tmp_path))
    parsed = spark.read.parquet(f"{tmp_path}/parsed/batch=0")
    assert "from_xml" not in plan_of(shred(parsed, health_log.ERROR_REPORTED)) and parsed.count() == 3


# ---- the ledger


def security(i, day=None, pad=""):
    return event("security_error_ring_buffer_recorded", pad + data("id", str(i)), f"2024-01-{day or i:02}T00:00:00Z")


def dumps_of(spark, *lists):
    return raw(spark, *[component(name="events", payload=ring(*events)) for events in lists], name=sd.COMPONENT_EVENT)


def ids(spark, path):
    return sorted(int(r.ID) for r in loaded_events(spark, path, sd.RING_SECURITY).collect())


def test_ledger_parses_and_writes_only_what_is_new(spark, tmp_path):
    path, spec = str(tmp_path / "ring"), sd.RING_SECURITY
    first = dumps_of(spark, [security(5), security(6)], [security(5), security(6), security(7)])
    assert load_dumps(first, spec, path, "a").count() == 3
    before = files_of(f"{path}/events")
    assert load_dumps(first, spec, path, "b").count() == 0  # the same dumps: nothing to parse, nothing written
    assert files_of(f"{path}/events") == before
    late = dumps_of(spark, [security(1), security(6), security(7), security(8, day=7)])
    assert {r.day for r in load_dumps(late, spec, path, "c").collect()} == {"2024-01-01", "2024-01-07"}
    after = files_of(f"{path}/events")
    assert {f: t for f, t in after.items() if f in before} == before
    assert {f.split("day=")[1][:10] for f in after if f not in before} == {"2024-01-01", "2024-01-07"}
    assert ids(spark, path) == [1, 5, 6, 7, 8]
    # another spelling of an event already there is parsed, and is not there twice
    assert load_dumps(dumps_of(spark, [security(5, pad=" ")]), spec, path, "d").count() == 1
    assert ids(spark, path) == [1, 5, 6, 7, 8]


def test_ledger_load_can_be_repeated(spark, tmp_path):
    """A load that broke off before its ledger was written brings the same again under its name."""
    path, spec = str(tmp_path / "ring"), sd.RING_SECURITY
    some = dumps_of(spark, [security(2), security(3)])
    load_dumps(some, spec, path, "a")
    shutil.move(f"{path}/ledger", f"{tmp_path}/lost")
    assert load_dumps(some, spec, path, "a").count() == 2
    assert ids(spark, path) == [2, 3]
    irregular = "<!-- x -->" + security(9)
    assert {r.day for r in load_dumps(dumps_of(spark, [irregular, security(10)]), spec, path, "e").collect()} == {"none"}
    assert ids(spark, path) == [2, 3, 9, 10]


def test_ledger_names_the_days_it_looks_into(spark, tmp_path):
    path, spec = str(tmp_path / "ring"), sd.RING_SECURITY
    load_dumps(dumps_of(spark, [security(i) for i in range(1, 9)]), spec, path, "a")
    plan = new_texts(dumps_of(spark, [security(4), security(9)]), spec, path, "b")._jdf.queryExecution().executedPlan().toString()
    assert "day IN (2024-01-0" in plan or "day#" in plan and "PartitionFilters" in plan and "2024-01-09" in plan


# ---- buckets


def test_compaction_writes_touched_buckets_alone(spark, tmp_path):
    schema = "id int, name string"
    changes = lambda *rows: spark.createDataFrame(list(rows), f"{schema}, operation string, sequence int")
    copy = BucketedCopy(spark, str(tmp_path / "copy"), ["id"], buckets=16)
    snapshot = spark.createDataFrame([(i, f"n{i}") for i in range(400)] + [(None, "none")], schema)
    copy.create(snapshot, changes())
    visible = lambda: {r.id: r.name for r in publish.visible(copy.read()).collect()}
    assert visible() == {**{i: f"n{i}" for i in range(400)}, None: "none"}
    current = lambda: set(copy.read().inputFiles())
    before = current()
    touched = copy.compact(changes((3, "x", "update", 5), (7, None, "delete", 6), (None, "y", "update", 2), (900, "new", "insert", 1)))
    assert 2 <= len(touched) <= 4
    bucket = lambda f: int(f.split("_bucket=")[1].split("/")[0])
    assert {f for f in before if bucket(f) not in touched} == {f for f in current() if bucket(f) not in touched}
    assert not {f for f in before if bucket(f) in touched} & current()
    assert copy.compact(changes((3, "stale", "update", 4), (7, "late", "insert", 5))) <= touched
    assert copy.compact(changes()) == set()
    assert visible() == {**{i: f"n{i}" for i in range(400) if i != 7}, 3: "x", None: "y", 900: "new"}


# ---- versions


def test_failing_reload_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.newest(spark, path) == {}
    versions.replace_table(spark.range(3), path, check=lambda t: t.count() == 3)
    with pytest.raises(versions.Rejected):
        versions.replace_table(spark.range(1), path, check=lambda t: t.count() > 1)
    assert versions.current_table(spark, path).count() == 3
    with pytest.raises(Exception, match="(?i)divi|zero"):
        versions.replace_table(spark.range(100, 103).select(F.expr("CASE WHEN id = 102 THEN raise_error('division by zero') ELSE id END AS id")), path)
    reader = versions.current_table(spark, path)
    assert reader.count() == 3
    grown = versions.replace_table(reader.union(reader), path)  # out of itself
    assert grown.count() == 6 and versions.current_table(spark, path).count() == 6 and reader.count() == 3


def test_family_is_switched_together(spark, tmp_path):
    path, specs = str(tmp_path / "health"), [health_log.ERROR_REPORTED, health_log.LEASE_EXPIRED]
    counts = lambda: [t.count() for t in loaded_tables(spark, path, specs).values()]
    reload_tables(raw(spark, *health_events(1)), specs, path)
    assert counts() == [1, 1]
    with pytest.raises(versions.Rejected, match=health_log.LEASE_EXPIRED.table):
        reload_tables(raw(spark, health_events(1)[0]), specs, path, check=lambda name, t: t.count() > 0)
    assert counts() == [1, 1]
    reload_tables(raw(spark, *health_events(1), *health_events(2)), specs, path, check=lambda name, t: t.count() > 0)
    assert counts() == [2, 2]
