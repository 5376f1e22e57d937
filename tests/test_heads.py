"""the component a record is about is read from its head; long dumps are not searched for its name."""

import random

import pytest

from eventloom.operators.envelope import parse
from eventloom.operators.shred import shred
from eventloom.tables import cluster_diagnostics as sd
from eventloom.tables import components
from tests.helpers import component, data, event, raw, ring

IO = '<ioSubsystem ioLatchTimeouts="1" intervalLongIos="2" totalLongIos="3"/>'
AG = '<availabilityGroup resourceID="r" leaseValid="TRUE"/>'
SPECS = {"io": sd.IO_SUBSYSTEM, "ag": sd.GROUP_STATE}


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_plain_head_decides(spark):
    """A dump that speaks of the component, or holds references and CDATA, was taken for a possible match."""
    inner = event("error_reported", data("message", "io_subsystem &#65; ") + data("kind", "alwaysOn:AvailabilityGroup") + data("text", "<![CDATA[x]]>"))
    records = [component(name="events", payload=ring(inner * 50)), component(name="system", payload=inner), component(name="io_subsystem2", payload=inner)]
    wanted = component(name="IO_Subsystem  ", payload=IO)
    group = component(ctype="alwaysOn:availabilitygroup", name="AG", payload=AG)
    events = raw(spark, *records, wanted, group, None, name=sd.COMPONENT_EVENT)
    assert [r.event_data for r in events.where(sd.IO_SUBSYSTEM.may_match()).collect()] == [wanted]
    assert [r.event_data for r in events.where(sd.GROUP_STATE.may_match()).collect()] == [group]
    assert shred(events, sd.IO_SUBSYSTEM).count() == 1 and shred(events, sd.GROUP_STATE).count() == 1


NAMES = ["io_subsystem", "IO_SUBSYSTEM ", "Io_Subsystem\t", " io_subsystem", "system", "", "alwaysOn:AvailabilityGroup", "ALWAYSON:availabilitygroup  ", "io_ſubſystem", "a &lt; b", "&#105;o_subsystem", "io&#95;subsystem", "<![CDATA[io_subsystem]]>", "io_<!-- x -->subsystem", "io_sub<![CDATA[system]]>", "alwaysOn:AvailabilityGroup", "x > y", "Ä"]
ELEMENTS = [
    '<data name="d"><value>{}</value></data>',
    "<data><value>{}</value></data>",
    '<data name="d"><type name="t" package="p"/><value>{}</value><text>t</text></data>',
    '<data name="d">\n  <type name="t"></type>\n  <value>{}</value>\n  <text/>\n</data>\n',
    '<data name="d"><type name="t"><value>system</value></type><value>{}</value></data>',
    '<data name="d"><text>t</text><value>{}</value></data>',
    '<data name="d"><value>{}</value><value>io_subsystem</value></data>',
    '<data name="d"/><data name="e"><value>{}</value></data>',
    '<data name="d"/><value>system</value><data><value>{}</value></data>',
    '<data name="a/b>c"><value>{}</value></data>',
    "<data name='d' ><value>{}</value ></data >",
    '<Data name="d"><Value>{}</Value></Data>',
    '<x:data xmlns:x="u" name="d"><x:value>{}</x:value></x:data>',
    '<data-x name="d"><value>system</value></data-x><data><value>{}</value></data>',
    '<data name="d"><value a="b">{}</value></data>',
    '<data name="d"><value/></data><data><value>{}</value></data>',
    '<data name="d"><text>t</text></data><data><value>{}</value></data>',
    '<action name="a"><value>system</value></action><data><value>{}</value></data>',
    '<!-- <data><value>system</value></data> --><data><value>{}</value></data>',
    "<other><data><value>system</value></data></other><data><value>{}</value></data>",
    '<data name="d"><value><value>system</value>{}</value></data>',
    "text<data><value>{}</value>",
]
HEADS = ['<event name="e" timestamp="2015-02-10T22:04:26.300Z">', "<event>\n", '<?xml version="1.0"?><event name="e">', "<event name='a>b'>", "<!-- c --><event a='/'>", ' <event name="e">', "﻿<event>", "<event xmlns='u'>", "<Event>"]


@pytest.mark.parametrize("of", SPECS)
def test_no_record_is_lost_by_its_head(spark, of):
    """Odd records give the rows that a parse of all of them gives."""
    draw = random.Random(20)
    records = [h + "".join(e.format(n) for e in [ELEMENTS[0]] * 3 + [x] * 3) + "</event>" for h in HEADS[:2] for x in ELEMENTS for n in NAMES]
    for _ in range(4_000):
        odd = draw.random() < 0.5
        head = draw.choice(HEADS) if odd else HEADS[0]
        body = [draw.choice(ELEMENTS if draw.random() < 0.3 else ELEMENTS[:4]).format(draw.choice(NAMES if draw.random() < 0.6 else NAMES[:2] + NAMES[6:8])) for _ in range(draw.randint(3, 8))]
        records.append(head + "".join(body) + data("d", draw.choice([IO, AG, ""])) + "</event>")
    events = raw(spark, *records, name=sd.COMPONENT_EVENT).repartition(4)
    spec = SPECS[of]
    found = rows(shred(events, spec))
    assert len(found) > 300
    assert found == rows(shred(parse(events, payload=components.EVERY_PAYLOAD), spec))
