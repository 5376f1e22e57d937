"""Splittable reading of XML documents: records, offsets and damage, with blocks far smaller than a file."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.envelope import quarantine
from eventloom.operators.shred import shred
from eventloom.sources import events as source
from eventloom.sources.events import read_event_documents
from eventloom.tables.health_log import ERROR_REPORTED
from tests.helpers import data, event, ring


@pytest.fixture
def small_blocks(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "4k", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def error(n, text="é"):
    return event("error_reported", data("error_number", str(n)) + "\n" + data("message", text))


def dump(n, inner):
    """A record that holds `inner` whole events, and more text behind its dump."""
    return event("component_health_result", data("n", str(n)) + data("d", ring(*[error(1000 * n + i) for i in range(inner)])) + data("after", "x"))


def rows_of(spark, folder, **options):
    return {(r.file_name.rsplit("/", 1)[-1], r.file_offset): (r.object_name, r.event_data) for r in read_event_documents(spark, str(folder), **options).collect()}


def expected(name, text, records):
    """Offsets as the reader gives them: behind the end tag before."""
    out, at = {}, 0
    for r in records:
        start = text.index(r, at)
        before = text.rfind("</event>", 0, start)
        out[(name, len(text[: before + 8 if before >= 0 else 0].encode()))] = (r.split('"')[1], r)
        at = start + len(r)
    return out


def test_documents_in_small_blocks(spark, tmp_path, small_blocks, monkeypatch):
    monkeypatch.setattr(source, "SPAN", 10_000)
    rng = random.Random(3)
    want = {}
    for k in range(3):
        records = [dump(i, rng.choice([1, 2, 3, 90])) if rng.random() < 0.2 else error(i, "<![CDATA[<x>]]>" if i % 7 == 0 else "ñ" * rng.randint(0, 400)) for i in range(150)]
        text = '<?xml version="1.0"?>\n<events>\n' + "".join(r + rng.choice(["", "\n", "  \r\n "]) for r in records) + "</events>\n"
        (tmp_path / f"log_{k}.xml").write_text(text, encoding="utf-8", newline="")
        want |= expected(f"log_{k}.xml", text, records)
    table = read_event_documents(spark, str(tmp_path))
    assert table.columns == source.RAW_COLUMNS
    assert rows_of(spark, tmp_path) == want
    blocks = spark.read.option("lineSep", "</event>").text(str(tmp_path)).select(F.spark_partition_id()).distinct().count()
    assert blocks > 30  # a file is many tasks'
    assert {f for f, _ in rows_of(spark, tmp_path, pattern="log_1*")} == {"log_1.xml"}
    assert shred(table, ERROR_REPORTED).count() == sum(name == "error_reported" for name, _ in want.values())


def test_offsets_do_not_depend_on_blocks(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<events>" + "".join(error(i) + (dump(i, 30) if i % 5 == 0 else "") for i in range(100)) + "</events>")
    whole = rows_of(spark, tmp_path)
    seen = []
    for size in ("1k", "3k", "64k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            seen.append(rows_of(spark, tmp_path))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen == [whole] * 3 and len(whole) == 120


def test_files_cut_short_and_odd_ones(spark, tmp_path):
    cut = error(3)[: error(3).index("</data>") + len("</data>")]  # well-formed but for its end tag
    (tmp_path / "cut.xml").write_text("<events>" + error(1) + error(2) + cut)
    (tmp_path / "empty.xml").write_text("")
    (tmp_path / "none.xml").write_text("<events/>\n")
    (tmp_path / "bare.xml").write_text(error(4))
    table = read_event_documents(spark, str(tmp_path))
    assert sorted(r.error_number for r in shred(table, ERROR_REPORTED).collect()) == [1, 2, 4]
    assert [r.event_data for r in quarantine(table).collect()] == [cut]


def test_no_window_over_a_whole_file(spark, tmp_path):
    """The only windows over a file's name alone run over one row a block or span."""
    (tmp_path / "a.xml").write_text("<events>" + error(1) + "</events>")
    plan = read_event_documents(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    wide = [line for line in plan.splitlines() if "Window [" in line and "], [" in line and "piece" in line]
    assert all("span" in line or "block" in line for line in wide)
