"""Events nested in ring-buffer dumps.

A diagnostic record may hold one or more `RingBufferTarget` elements at any depth, each with many
events, and successive records repeat most of them. Modes:

    all    (default) one row per nested event, positions counted inside that event
    first  one row per record: the time of its first matching event, positions counted over
           all matching events of the record

The result is distinct, so the repeats are removed as early as they can be told apart: the text
of the matching events is cut out of each record, made distinct (a partial hash aggregate in the
map tasks, before anything is shuffled) and only then parsed. A dump repeated across a third of
all records is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.typed import to_time
from eventloom.operators import envelope
from eventloom.operators.specs import TableSpec

TARGET = "RingBufferTarget"
# The inside of a tag: quoted values may hold brackets and slashes.
_INSIDE = r"""(?:[^>"'/]|"[^"]*"|'[^']*'|/(?!>))*+"""


def _up_to_end(tag: str) -> str:
    """Everything up to the first end tag, and that: the search stops at tags, not at every letter."""
    return rf"[^<]*+(?:<(?!/{tag}\s*>)[^<]*+)*+</{tag}\s*>"


_BUFFER = rf"<{TARGET}\b{_INSIDE}>{_up_to_end(TARGET)}"
# Comments, CDATA and processing instructions can hide or fake a tag.
_HIDDEN = r"<[!?]"
_TWO_EVENTS = r"(?s).<event\b"


_ANY_START = r"<event\b"
# A name written with character references is left to the parser.
_REFERENCE = r"""<event\b[^<]*\bname\s*=\s*(?:"[^"]*&|'[^']*&)"""


# Whole event elements, and whether one has a name.
_EVENT = rf"<event\b{_INSIDE}(?:/>|>{_up_to_end('event')})"


def _named(name: str) -> str:
    return rf"^<event\b(?:\s+{envelope.ATTRIBUTE})*?\s+name\s*=\s*[\"\']{name}[\"\']"


def _wrapped(text: Column) -> Column:
    return F.concat(F.lit(f"<{TARGET}>"), text, F.lit(f"</{TARGET}>"))


def holds(event_name: str) -> Column:
    """True for a record whose ring buffers may have an event of that name.

    A substring test: it misses none, character references included, and what it lets through by
    mistake yields no row.
    """
    xml = F.col("event_data")
    return F.contains(xml, F.lit(f"<{TARGET}")) & (F.contains(xml, F.lit(event_name)) | F.contains(xml, F.lit("&#")))


def matching_text(raw: DataFrame, event_name: str, mode: str) -> DataFrame:
    """`buffers`: XML text holding the matching events, per event (all) or per record (first).

    The events of a dump are found in one pass over its text and then chosen by name. Records whose tags
    cannot be told by pattern, or where the pattern does not find as many events as there are starts of
    one, contribute the whole of their buffers.
    """
    buffers = F.array_join(F.regexp_extract_all("event_data", F.lit(_BUFFER), F.lit(0)), "")
    cut = (
        raw.where(holds(event_name))
        .select(F.inline(F.array(F.struct(buffers.alias("dump")))))
        .select("dump", F.regexp_extract_all("dump", F.lit(_EVENT), F.lit(0)).alias("every"))
        .select("dump", F.inline(F.array(F.struct(F.size("every").alias("found"), F.filter("every", lambda e: e.rlike(_named(event_name))).alias("pieces")))))
    )
    uncut = F.col("found") != F.regexp_count("dump", F.lit(_ANY_START))
    irregular = F.col("dump").rlike(_HIDDEN) | F.col("dump").rlike(_REFERENCE) | uncut | F.exists("pieces", lambda p: p.rlike(_TWO_EVENTS))
    if mode == "all":
        units = F.when(irregular, F.array("dump")).otherwise(F.transform("pieces", _wrapped))
        return cut.select(F.explode(units).alias("buffers"))
    whole = F.when(irregular, F.col("dump")).otherwise(_wrapped(F.array_join("pieces", "")))
    return cut.where(irregular | (F.size("pieces") > 0)).select(whole.alias("buffers"))


def ring_events(raw: DataFrame, spec: TableSpec, mode: str = "all", unique_text: bool = True) -> DataFrame:
    """Parsed-layer rows of the nested events `spec` asks for.

    `unique_text` parses each text once; it has to be off for a stream without bounded state.
    """
    if mode not in ("all", "first"):
        raise ValueError(f"mode must be 'all' or 'first', not {mode!r}")
    texts = matching_text(raw, spec.ring_buffer, mode)
    return parsed_texts(texts.distinct() if unique_text else texts, spec, mode)


def parsed_texts(texts: DataFrame, spec: TableSpec, mode: str = "all") -> DataFrame:
    """The same rows from texts already cut out by `matching_text`."""
    schema = f"{TARGET} ARRAY<STRUCT<event ARRAY<STRUCT<{envelope.event_type(spec.parts)}>>>>"
    root = F.concat(F.lit("<buffers>"), F.col("buffers"), F.lit("</buffers>"))
    dumps = texts.select(F.from_xml(root, schema, envelope.OPTIONS).alias("root"))
    lists = F.transform(F.col(f"root.{TARGET}"), lambda b: F.coalesce(b["event"], F.array()))
    records = dumps.select(
        F.inline(
            F.array(F.struct(F.filter(F.flatten(lists), lambda e: e["_name"] == spec.ring_buffer).alias("matching")))
        )
    )
    actions_read = envelope.ACTIONS in spec.parts
    if mode == "all":
        one = records.select(F.explode("matching").alias("event"))
        data = F.col("event.data")
        actions = F.col("event.action") if actions_read else None
        when, name = F.col("event._timestamp"), F.col("event._name")
    else:
        one = records.where(F.size("matching") > 0)
        data = F.flatten(F.transform("matching", lambda e: F.coalesce(e["data"], F.array())))
        actions = F.flatten(F.transform("matching", lambda e: F.coalesce(e["action"], F.array()))) if actions_read else None
        when, name = F.get("matching", F.lit(0))["_timestamp"], F.get("matching", F.lit(0))["_name"]
    parsed = F.struct(
        name.alias("event_name"), when.alias("stamp"), *envelope.arrays(data, actions, spec.parts, None)
    )
    opened = one.select(F.inline(F.array(parsed)))
    return opened.withColumn("stamp", to_time(F.col("stamp"))).withColumnRenamed("stamp", "event_time")
