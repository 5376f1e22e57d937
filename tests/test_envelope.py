import datetime as dt

from eventloom.operators import envelope
from eventloom.operators.shred import bad_literals, shred
from eventloom.operators.specs import TableSpec, action, column, fragment, stamp, text, type_name, value
from tests.helpers import action as act
from tests.helpers import data, event, raw

SPEC = TableSpec(
    table="t",
    columns={
        "name": column("object_name", 2),
        "at": stamp(),
        "n": value("n", "int"),
        "s": value("s", width=3),
        "s_text": text("s", 2),
        "v2": value(2),
        "t1": text(1),
        "a2": action(2),
        "who": action("who", "int"),
        "kind": type_name(1),
        "dflt": value("d", default="none"),
    },
)


def shredded(spark, *events, cut=True):
    return shred(raw(spark, *events, name="evt"), SPEC, cut).collect()


def test_named_positional_and_widths(spark):
    body = (
        data("n", "7", extra='<type name="int32" package="p"/>')
        + data("s", "abcdef", "TEXT")
        + data("d", "here")
        + act("seq", "1")
        + act("who", "55")
    )
    (row,) = shredded(spark, event("evt", body))
    assert row.asDict() == {
        "name": "ev",
        "at": dt.datetime(2015, 2, 10, 22, 4, 26, 300000),
        "n": 7,
        "s": "abc",
        "s_text": "TE",
        "v2": "abcdef",
        "t1": "TEXT",
        "a2": "55",
        "who": 55,
        "kind": "int32",
        "dflt": "here",
    }
    (full,) = shredded(spark, event("evt", body), cut=False)
    assert (full.name, full.s, full.s_text) == ("evt", "abcdef", "TEXT")


def test_missing_nodes_are_null_and_empty_ones_are_not(spark):
    missing, empty = shredded(spark, event("evt", ""), event("evt", '<data name="n"><value/></data>' + data("s", "")))
    assert (missing.n, missing.s, missing.v2, missing.who, missing.dflt) == (None, None, None, None, "none")
    assert (empty.n, empty.s, empty.v2) == (0, "", "")


def test_text_without_value_does_not_shift_positions(spark):
    (row,) = shredded(spark, event("evt", data("a", "1") + data("b", None, "only text") + data("c", "3")))
    assert row.v2 == "3" and row.t1 == "only text"


def test_a_data_element_with_two_values_takes_two_positions(spark):
    (row,) = shredded(spark, event("evt", '<data name="s"><value>x</value><value>y</value></data>' + data("n", "9")))
    assert (row.s, row.v2, row.n) == ("x", "y", 9)


def test_first_of_a_repeated_name_wins(spark):
    (row,) = shredded(spark, event("evt", '<data name="n"><text>t</text></data>' + data("n", "1") + data("n", "2")))
    assert row.n == 1


def test_escapes_cdata_and_spaces(spark):
    (row,) = shredded(
        spark, event("evt", data("s", "&lt;&amp;&#65;") + data("q", "<![CDATA[ <b> ]]>") + data("n", " 5 ")), cut=False
    )
    assert (row.s, row.v2, row.n) == ("<&A", " <b> ", 5)


def test_malformed_records_go_to_quarantine_only(spark):
    good = event("evt", data("n", "1"))
    events = raw(spark, good, good[:-4], "junk", None, "", name="evt")
    assert [r.n for r in shred(events, SPEC).collect()] == [1]
    assert sorted(r.file_offset for r in envelope.quarantine(events).collect()) == [1, 2, 3, 4]
    assert envelope.quarantine(events).columns == events.columns


def test_bad_literals_are_counted(spark):
    events = raw(spark, event("evt", data("n", "x")), event("evt", data("n", "99999999999")), event("evt", data("n", "1")))
    assert {r.column_name: r.bad for r in bad_literals(events, SPEC).collect()} == {"n": 2, "who": 0}
    assert [r.n for r in shred(events, SPEC).collect()] == [None, None, 1]


def test_fragment_keeps_the_original_markup(spark):
    spec = TableSpec(table="f", columns={"f": fragment("topWaits")})
    inner = '<topWaits x="&lt;1"><wait waitType="A"/></topWaits>'
    rows = shred(
        raw(
            spark,
            event("e", data("d", f"<q>{inner}</q>")),
            event("e", data("d", "<q><topWaits/></q>")),
            event("e", data("d", f"<q>{inner}{inner}</q>")),
            event("e", data("d", "1")),
        ),
        spec,
    ).collect()
    assert [r.f for r in rows] == [inner, "<topWaits/>", inner + inner, ""]


def test_only_what_a_table_reads_is_parsed(spark):
    spec = TableSpec(table="t", columns={"n": value("n")})
    plan = shred(raw(spark, event("e", "")), spec)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml") == 1
    assert "StructField(action" not in plan and "StructField(text" not in plan
