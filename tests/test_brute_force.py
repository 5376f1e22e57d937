"""Random documents against a plain Python reading of the same text."""

import random
import xml.etree.ElementTree as ET
from xml.sax.saxutils import escape

import pytest

from eventloom.operators.envelope import parse
from eventloom.operators.shred import shred
from eventloom.tables import cluster_diagnostics as sd
from tests.helpers import component, event, raw

NAMES = ["a", "b", "c"]
TEXTS = ["", "1", "x & y", "<tag>", "two\nlines", " padded ", "é ü", "]] >", "'quoted' \"text\""]


def random_data(rng, tag="data"):
    out = [f'<{tag} name="{rng.choice(NAMES)}">']
    if rng.random() < 0.3:
        out.append(f'<type name="{rng.choice(NAMES)}" package="p"/>')
    for _ in range(rng.choice([0, 1, 1, 1, 2])):
        out.append(f"<value>{escape(rng.choice(TEXTS))}</value>" if rng.random() < 0.8 else "<value/>")
    if tag == "data" and rng.random() < 0.4:
        out.append(f"<text>{escape(rng.choice(TEXTS))}</text>")
    return "".join(out) + f"</{tag}>"


def random_event(rng, name="e", ts=None):
    body = [random_data(rng) for _ in range(rng.randrange(6))] + [random_data(rng, "action") for _ in range(rng.randrange(3))]
    return event(name, "".join(body), ts or f"2024-01-0{rng.randrange(1, 9)}T00:00:00Z")


def children(root, element, child):
    found = [(e.get("name"), c.text or "") for e in root.findall(element) for c in e.findall(child)]
    return [n for n, _ in found], [t for _, t in found]


@pytest.mark.parametrize("payload", [None, {"system": "STRUCT<_x STRING>"}])
def test_parsed_arrays(spark, payload):
    rng = random.Random(7)
    docs = [random_event(rng) for _ in range(400)]
    rows = parse(raw(spark, *docs), payload=payload).orderBy("file_offset").collect()
    for doc, row in zip(docs, rows, strict=True):
        root = ET.fromstring(doc)
        for element, child, names, items in [
            ("data", "value", row.value_names, row["values"]),
            ("data", "text", row.text_names, row.texts),
            ("action", "value", row.action_names, row.actions),
        ]:
            assert (names or [], items or []) == children(root, element, child), doc
        types = [t.get("name") for t in root.findall("data/type")]
        assert (row.type_names or []) == types and not row.malformed


def ring_payload(rng):
    events = [random_event(rng, rng.choice(["error_reported", "other", "error_reported_x"])) for _ in range(rng.randrange(5))]
    extra = rng.choice(["", "", "", "<!-- <event name=\"error_reported\"> -->", "<?pi x?>"])
    events.insert(rng.randrange(len(events) + 1), extra)
    buffer = f'<RingBufferTarget truncated="0">{"".join(events)}</RingBufferTarget>'
    return "<events>" + buffer * rng.choice([1, 1, 2]) + rng.choice(["", "<RingBufferTarget/>"]) + "</events>"


def nth(items, n):
    return items[n - 1] if len(items) >= n else None


def ring_row(events):
    values = [c.text or "" for e in events for c in e.findall("data/value")]
    texts = [c.text or "" for e in events for c in e.findall("data/text")]
    picked = [nth(values, i) for i in range(1, 6)] + [nth(texts, 5), nth(values, 6), nth(texts, 6), nth(values, 7), nth(values, 8)]
    return (events[0].get("timestamp")[:10], *picked)


@pytest.mark.parametrize("mode", ["all", "first"])
def test_ring_buffers(spark, mode):
    rng = random.Random(11)
    docs = [component(name="events", payload=ring_payload(rng)) for _ in range(300)]
    docs += docs[:100]  # repeated dumps
    expected = set()
    for doc in docs:
        found = [e for e in ET.fromstring(doc).findall(".//RingBufferTarget/event") if e.get("name") == "error_reported"]
        groups = [[e] for e in found] if mode == "all" else [found] if found else []
        expected |= {ring_row(g) for g in groups}
    rows = shred(raw(spark, *docs, name=sd.COMPONENT_EVENT), sd.RING_ERROR_REPORTED, mode=mode).collect()
    got = [(str(r[0])[:10], *r[1:]) for r in rows]
    assert len(got) == len(set(got)) and set(got) == expected and len(expected) > 100
