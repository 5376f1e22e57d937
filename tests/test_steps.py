"""Findings of the third review on time: texts are built by code the JVM compiles, fates by a narrow parse, dumps are cut at tags."""

import re

from pyspark.sql import functions as F

from catalogue import logs
from eventloom.operators import ring_buffer
from eventloom.operators.shred import sorted_out
from eventloom.operators.specs import TableSpec, value
from eventloom.tables import cluster_diagnostics as sd
from eventloom.tables import components, health_log
from tests.helpers import component, data, event, raw, ring

#: The JVM leaves longer methods to its interpreter.
HUGE = 8_000


def tables(spark, folder):
    """Small tables with every order priority and status, NULLs and text to be escaped."""
    orders = spark.range(1, 200).selectExpr(
        "id AS o_orderkey", "IF(id % 11 = 0, NULL, id * 7) AS o_custkey", "IF(id % 13 = 0, NULL, substr('OFP', id % 3 + 1, 1)) AS o_orderstatus",
        "id * 1.5D AS o_totalprice", "timestamp'1995-01-01 00:00:00' + make_dt_interval(id) AS o_orderdate",
        "get(array('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW', NULL), CAST(id % 6 AS INT)) AS o_orderpriority",
    )
    customer = spark.range(1, 60).selectExpr("id AS c_custkey", "concat('Customer <', id, '>') AS c_name", "IF(id % 5 = 0, NULL, CAST(id % 25 AS INT)) AS c_nationkey", "id - 20.5D AS c_acctbal", "IF(id % 7 = 0, NULL, 'A & B') AS c_mktsegment")
    events = spark.range(1, 60).selectExpr("id AS event_id", "timestamp'2024-01-01 00:00:00' + make_dt_interval(id) AS ts", "id % 9 AS user_id", "'view' AS event_type", "id * 2.5D AS value", "concat('{\"k\": ', id, '}') AS props")
    part = spark.range(1, 60).selectExpr("id AS p_partkey", "'p' AS p_name", "'Brand' AS p_brand", "'T' AS p_type", "IF(id % 5 = 0, NULL, CAST(id % 50 AS INT)) AS p_size")
    for name, df in {"orders": orders, "customer": customer, "events": events, "part": part}.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_texts_are_built_in_steps_the_jvm_compiles(spark, tmp_path):
    """The code of a whole text was one method too long to be compiled. The text stays the same."""
    folder = tables(spark, tmp_path / "t")
    for source in (logs.SD_COMPONENT, logs.SH_COMPONENT, *logs.SD_DUMPS, logs.SH_CONNECT, logs.DDL_EVENT):
        made = logs.raw_events(spark, folder, source)
        whole = logs.table(spark, folder, source.table).select(F.expr(source.xml()).alias("event_data"))
        texts = whole.collect()
        assert len({r.event_data for r in texts}) > 20
        assert sorted(map(str, (r.event_data for r in made.collect()))) == sorted(map(str, (r.event_data for r in texts))), source.event
        code = made._jdf.queryExecution().debug().codegenToSeq()
        sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.length())]
        assert sizes and max(sizes) < HUGE, (source.event, source.table, sizes)


def test_fates_need_a_narrow_parse(spark):
    """every element and payload of a record was parsed to tell its table."""
    broken = [event("error_reported", data("a", "1"))[:-3], "<event><data><value>1</value></event>", None, "<event name='a' name='b'/>", "<event>&none;</event>"]
    records = [event("error_reported", data("error_number", "1", "t")), "<event name='error_reported'>text<data/><data name='x'><value><y/></value></data></event>", *broken]
    found = sorted_out(raw(spark, *records, name="error_reported"), health_log.TABLES)
    assert {r.fate: r["count"] for r in found.groupBy("fate").count().collect()} == {"typed": 2, "quarantine": len(broken)}
    assert "transform(" not in found._jdf.queryExecution().optimizedPlan().toString()
    dumps = raw(spark, component(name="events", payload=ring(event("x", ""))), component(), component(name="events"), name=sd.COMPONENT_EVENT)
    found = sorted_out(dumps, sd.TABLES)
    assert sorted(r.fate for r in found.collect()) == ["ring buffer", "typed", "unrouted"]
    assert "spinlockBackoffs" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_a_choice_by_columns_a_spec_does_not_list(spark):
    spec = TableSpec("t", {"v": value(1)}, event="e", where=lambda: F.col("system._latchWarnings") == "2", payload=components.SYSTEM_PAYLOAD)
    records = raw(spark, event("e", data("d", '<system latchWarnings="2"/>')), event("e", data("d", '<system latchWarnings="3"/>')))
    assert sorted(r.fate for r in sorted_out(records, [spec]).collect()) == ["typed", "unrouted"]


def test_dumps_are_cut_at_tags(spark):
    """the end of an event was looked for at every letter. The same events are found, in a long dump too."""
    assert ".*?" not in ring_buffer._EVENT + ring_buffer._BUFFER
    one = event("a", data("x", "1 /event> </events > < /event>"))
    texts = [one, f"{one}{one}", "<event/>x<event name='/>'>y</event\n>", "<event>no end", f"<event><eventful></eventful>\n</event >{one}", "<event></event", "", ring(one) + ring("<event/>", attrs=""), one * 20_000]
    lazy = (r"(?s)<event\b%s(?:/>|>.*?</event\s*>)" % ring_buffer._INSIDE, r"(?s)<RingBufferTarget\b%s>.*?</RingBufferTarget\s*>" % ring_buffer._INSIDE)
    made = spark.createDataFrame([(t,) for t in texts], "t string").select(*[F.regexp_extract_all("t", F.lit(p), F.lit(0)) for p in (ring_buffer._EVENT, lazy[0], ring_buffer._BUFFER, lazy[1])]).collect()
    assert all(r[0] == r[1] and r[2] == r[3] for r in made) and len(made[-1][0]) == 20_000
    assert [len(re.findall("<event", "".join(r[0]))) for r in made][:2] == [1, 2]
