"""Small builders for hand-written events."""

RAW = "object_name string, event_data string, file_name string, file_offset bigint"


def raw(spark, *events, name="e"):
    """Raw records; an event is its text or a pair (object_name, text)."""
    rows = []
    for i, e in enumerate(events):
        obj, text = e if isinstance(e, tuple) else (name, e)
        rows.append((obj, text, "f.xel", i))
    return spark.createDataFrame(rows, RAW)


def event(name, body, ts="2015-02-10T22:04:26.300Z"):
    return f'<event name="{name}" package="p" timestamp="{ts}">{body}</event>'


def data(name, value=None, text=None, extra=""):
    v = "" if value is None else f"<value>{value}</value>"
    t = "" if text is None else f"<text>{text}</text>"
    return f'<data name="{name}">{extra}{v}{t}</data>'


def action(name, value):
    return f'<action name="{name}"><value>{value}</value></action>'


def component(ctype="instance", name="system", payload="", state="clean", created="2015-02-10 22:04:26.300"):
    """A cluster-diagnostics record."""
    values = ["1", "3", created, ctype, name, state]
    body = "".join(data(f"d{i}", v) for i, v in enumerate(values))
    return event("component_health_result", body + data("d7", payload) + data("d8", "INST") + data("d9", "NODE"))


def ring(*events, attrs=' truncated="0"'):
    return f"<events><session><RingBufferTarget{attrs}>{''.join(events)}</RingBufferTarget></session></events>"
