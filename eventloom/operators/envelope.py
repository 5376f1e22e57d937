"""The event envelope: one XML parse per record, then plain arrays.

`parse` turns the text column `event_data` into

    event_name, event_time
    value_names / values      every data/value, in document order, with its data name
    text_names / texts        every data/text
    action_names / actions    every action/value
    type_names                every data/type/@name
    <payload columns>         the first nested component of each requested kind
    malformed                 the record is not well-formed XML, or its root is no event

A name lookup is `array_position` + `get`, a positional read is `get`; both are native and cost
no further parse. The arrays come out of an `inline`, which keeps predicates on them from being
pushed below the parse (that would parse every record twice); predicates on `object_name` still
reach the file scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.typed import to_time

OPTIONS = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}

VALUES, TEXTS, ACTIONS, TYPES = "values", "texts", "actions", "types"
EVERY_PART = frozenset({VALUES, TEXTS, ACTIONS, TYPES})

#: One attribute of a tag, in either kind of quotes; a value may hold a closing bracket.
ATTRIBUTE = r"""[^\s=<>"'/]+\s*=\s*(?:"[^"]*"|'[^']*')"""
#: The root element, behind declarations and comments.
_ROOT = r"(?s)^\uFEFF?\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*|<!DOCTYPE[^>]*>\s*)*<event[\s/>]"


def _value_type(payload: dict[str, str] | None) -> str:
    """A `value` element: its own text plus the nested components asked for."""
    if not payload:
        return "STRING"
    nested = "".join(f", {name} {ddl}" for name, ddl in payload.items())
    return f"STRUCT<_VALUE STRING{nested}>"


def event_type(parts: frozenset[str] = EVERY_PART, payload: dict[str, str] | None = None) -> str:
    """DDL of one event element, holding only the parts a reader needs."""
    data = ["_name STRING"]
    if TYPES in parts:
        data.append("type STRUCT<_name STRING>")
    if VALUES in parts or payload:
        data.append(f"value ARRAY<{_value_type(payload)}>")
    if TEXTS in parts:
        data.append("text ARRAY<STRING>")
    fields = ["_name STRING", "_timestamp STRING"]
    if len(data) > 1:
        fields.append(f"data ARRAY<STRUCT<{', '.join(data)}>>")
    if ACTIONS in parts:
        fields.append("action ARRAY<STRUCT<_name STRING, value ARRAY<STRING>>>")
    return ", ".join(fields)


def _pairs(elements: Column, child: str) -> Column:
    """(element name, child) for every child of every element, in document order."""

    def of_one(e: Column) -> Column:
        return F.transform(
            F.coalesce(e[child], F.array()), lambda c: F.struct(e["_name"].alias("name"), c.alias("child"))
        )

    return F.flatten(F.transform(elements, of_one))


def arrays(elements: Column, actions: Column | None, parts: frozenset[str], payload: dict[str, str] | None) -> list[Column]:
    """The parsed-layer arrays of one event, from its `data` and `action` element arrays."""
    out: list[Column] = []
    if VALUES in parts or payload:
        pairs = _pairs(elements, "value")
        out.append(pairs["name"].alias("value_names"))
        if payload:
            texts = F.transform(pairs["child"]["_VALUE"], lambda v: F.coalesce(v, F.lit("")))
            out.append(texts.alias("values"))
            for name in payload:
                present = F.filter(pairs["child"][name], lambda c: c.isNotNull())
                out.append(F.get(present, F.lit(0)).alias(name))
        else:
            out.append(pairs["child"].alias("values"))
    if TEXTS in parts:
        pairs = _pairs(elements, "text")
        out += [pairs["name"].alias("text_names"), pairs["child"].alias("texts")]
    if TYPES in parts:
        named = F.filter(elements["type"]["_name"], lambda n: n.isNotNull())
        out.append(named.alias("type_names"))
    if ACTIONS in parts and actions is not None:
        pairs = _pairs(actions, "value")
        out += [pairs["name"].alias("action_names"), pairs["child"].alias("actions")]
    return out


def parse(
    raw: DataFrame,
    parts: frozenset[str] = EVERY_PART,
    payload: dict[str, str] | None = None,
) -> DataFrame:
    """Add the parsed layer to raw events, keeping all raw columns.

    `parts` and `payload` limit what is materialised; malformed records stay, flagged.
    """
    schema = event_type(parts, payload) + ", _corrupt_record STRING"
    event = raw.withColumn("event", F.from_xml(F.col("event_data"), schema, OPTIONS))
    parsed = F.struct(
        F.col("event._name").alias("event_name"),
        F.col("event._timestamp").alias("stamp"),
        *arrays(F.col("event.data"), F.col("event.action") if ACTIONS in parts else None, parts, payload),
        (F.col("event").isNull() | F.col("event._corrupt_record").isNotNull() | ~F.col("event_data").rlike(_ROOT)).alias("malformed"),
    )
    kept = [F.col(c) for c in raw.columns]
    opened = event.select(*kept, F.inline(F.array(parsed)))
    # The time is cast after the `inline`, where its text is a plain column used several times.
    return opened.withColumn("stamp", to_time(F.col("stamp"))).withColumnRenamed("stamp", "event_time")


def from_elements(events: DataFrame, parts: frozenset[str] = EVERY_PART) -> DataFrame:
    """The parsed layer of event elements a file reader has already turned into columns."""
    parsed = F.struct(
        F.col("_name").alias("object_name"),
        F.col("_name").alias("event_name"),
        to_time(F.col("_timestamp")).alias("event_time"),
        *arrays(F.col("data"), F.col("action") if ACTIONS in parts else None, parts, None),
        F.col("_corrupt_record").isNotNull().alias("malformed"),
    )
    return events.select("file_name", F.inline(F.array(parsed)))


def well_formed(parsed: DataFrame) -> DataFrame:
    return parsed.where(~F.col("malformed"))


def quarantine(raw: DataFrame) -> DataFrame:
    """The raw records no typed table can take: text that is absent, not well-formed, or no event."""
    return parse(raw, parts=frozenset()).where("malformed").select(*raw.columns)
