"""Inputs that the derived logs do not hold: odd quotes, foreign roots, brackets in attributes, late and NULL-keyed changes."""

from pyspark.sql import functions as F

from eventloom.functions.text import statement_slice
from eventloom.operators import publish
from eventloom.operators.envelope import quarantine
from eventloom.operators.shred import shred, sorted_out, unrouted
from eventloom.sources.events import read_events
from eventloom.streaming.replicate import compact, current_copy, untaken
from eventloom.tables import cluster_diagnostics as sd
from eventloom.tables import health_log
from tests.helpers import component, data, event, raw, ring

SECURITY = "security_error_ring_buffer_recorded"
FEED = "id int, name string, operation string, sequence int"


def test_statement_slice_counts_two_byte_units(spark):
    text = "ab😀cd😀e"
    rows = [(text, s, e) for s in range(0, 20, 2) for e in (-1, 2, 4, 6, 8, 12, 16, 40)]
    for r in spark.createDataFrame(rows, "t string, s int, e int").withColumn("got", statement_slice(F.col("t"), F.col("s"), F.col("e"))).collect():
        units = r.t.encode("utf-16-be")
        count = max(int(((len(units) if r.e == -1 else r.e) - r.s) / 2) + 1, 0)
        assert r.got == units[r.s : r.s + 2 * count].decode("utf-16-be", "ignore"), r


def test_names_in_either_quotes_and_foreign_roots(spark, tmp_path):
    body = data("error_number", "7")
    lines = [
        f"<event name='error_reported' timestamp='2024-01-01T00:00:00Z'>{body}</event>",
        f'<event note="a>b" name="error_reported" timestamp="2024-01-01T00:00:00Z">{body}</event>',
        f'<event timestamp="2024-01-01T00:00:00Z">{body}</event>',
        '<event name="unheard_of"/>',
    ]
    (tmp_path / "a.txt").write_text("\n".join(lines))
    read = read_events(spark, str(tmp_path), "text")
    assert [r.object_name for r in read.orderBy("event_data").collect()].count("error_reported") == 2
    assert read.where("file_offset IS NOT NULL").count() == 0
    assert shred(read, health_log.ERROR_REPORTED).count() == 2
    assert {r.object_name for r in unrouted(read, health_log.TABLES).collect()} == {None, "unheard_of"}
    foreign = raw(spark, "<other a='1'/>", "<other><event/></other>", "<?xml version='1.0'?><!-- x --> <event name='error_reported'/>", name="error_reported")
    assert quarantine(foreign).count() == 2 and shred(foreign, health_log.ERROR_REPORTED).count() == 1
    fates = {r.fate: r["count"] for r in sorted_out(read.unionByName(foreign), health_log.TABLES).groupBy("fate").count().collect()}
    assert fates == {"typed": 3, "unrouted": 2, "quarantine": 2}


def test_ring_cut_is_exact(spark):
    day = iter(range(1, 10))
    plain = lambda attrs: f"<event {attrs} timestamp=\"2024-01-0{next(day)}T00:00:00Z\">{data('id', '1')}</event>"
    events = [
        plain(f'desc="a>b" name="{SECURITY}"'),
        plain(f"name='{SECURITY}' note='/>'"),
        plain('name="security_error_ring_buffer_recorde&#100;"'),
        f'<event name="{SECURITY}" timestamp="2024-01-0{next(day)}T00:00:00Z"/>',
        plain('name="another"'),
    ]
    for dump in ([e] for e in events[:4]):
        rows = shred(raw(spark, component(name="events", payload=ring(*dump)), name=sd.COMPONENT_EVENT), sd.RING_SECURITY)
        assert rows.count() == 1, dump
    whole = raw(spark, component(name="events", payload=ring(*events, attrs=' note="x>y"')), name=sd.COMPONENT_EVENT)
    assert shred(whole, sd.RING_SECURITY).count() == 4


def test_a_stale_change_never_wins(spark, tmp_path):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, name string")
    new = spark.createDataFrame([(1, "new", "update", 10), (2, None, "delete", 10), (None, "m", "update", 4)], FEED)
    old = spark.createDataFrame([(1, "old", "update", 5), (2, "back", "insert", 5), (None, "stale", "update", 3), (7, "x", "insert", 1)], FEED)
    folded = compact(source, new, ["id"], str(tmp_path / "c"))
    expected = {(1, "new"), (None, "m"), (7, "x")}
    assert {tuple(r) for r in current_copy(folded, old, ["id"]).collect()} == expected
    again = compact(folded, old.union(new), ["id"], str(tmp_path / "d"))
    assert {tuple(r) for r in publish.visible(again).collect()} == expected
    assert untaken(old.union(new), again, ["id"]).count() == 0
    later = spark.createDataFrame([(2, "again", "insert", 11)], FEED)
    assert {tuple(r) for r in current_copy(again, later, ["id"]).collect()} == expected | {(2, "again")}


def test_null_keys_do_not_multiply(spark):
    source = spark.createDataFrame([(1, "a")], "id int, name string")
    feed = spark.createDataFrame([(None, "n", "insert", 1)], FEED)
    once = publish.merge_changes(source, feed, ["id"])
    assert publish.visible(publish.merge_changes(once, feed, ["id"])).count() == 2
