"""How a typed table is described: where each column of it comes from.

    value("error_number", INT)     first data/value under that data name
    value(3, INT)                  third data/value of the event (counted from 1)
    text(...), action(...)         the same on data/text and action/value
    type_name(18)                  18th data/type/@name
    attribute("system", "x", INT)  attribute of a nested component
    nested("resource", path, ...)  a path inside a nested component
    fragment("topWaits")           a nested element kept as XML text
    stamp(), column("object_name") the event time; a column of the raw layer
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.typed import DATETIME, STRING, typed
from eventloom.operators import envelope

_ARRAYS = {
    envelope.VALUES: ("value_names", "values"),
    envelope.TEXTS: ("text_names", "texts"),
    envelope.ACTIONS: ("action_names", "actions"),
    envelope.TYPES: (None, "type_names"),
}

# Plain markup: no CDATA, comment or nested element in a value, nothing but a type and a text beside it. No closing
# bracket or slash in an attribute either, so that a tag ends where it seems to.
_OPEN_EVENT = r"^<event(?:\s[^<>/]*+)?>\s*+"
_OPEN_DATA = r"<data(?:\s[^<>/]*+)?>\s*+(?:<type(?:\s[^<>/]*+)?(?:/>|>\s*+</type>)\s*+)?"
_PLAIN_DATA = rf"{_OPEN_DATA}<value>[^<]*+</value>\s*+(?:<text>[^<]*+</text>\s*+)?</data>\s*+"


def reads_otherwise(position: int, spelled: str) -> str:
    """A pattern of records that begin with plain data elements, whose value at `position` is not `spelled`.

    That value is of ASCII letters without references, so letters compare as `same` compares them. The
    pattern looks at the record up to that value only, however long the record is.
    """
    another = rf"(?!(?i:{re.escape(spelled.rstrip(' '))})\x20*+</value>)[\x20-%'-;=-~]*+"
    return rf"{_OPEN_EVENT}(?:{_PLAIN_DATA}){{{position - 1}}}{_OPEN_DATA}<value>{another}</value>"


@dataclass(frozen=True)
class Source:
    """Where one output column comes from."""

    part: str  # an envelope part, or: payload | fragment | time | raw
    key: str | int
    kind: str = STRING
    width: int | None = None
    default: str | None = None
    fallback: "Source | None" = None

    def untyped(self) -> Column:
        if self.part in _ARRAYS:
            names, items = _ARRAYS[self.part]
            if isinstance(self.key, int):
                return F.get(F.col(items), F.lit(self.key - 1))
            return F.get(F.col(items), (F.array_position(F.col(names), self.key) - 1).cast("int"))
        if self.part == "fragment":
            whole_element = rf"(?s)<{self.key}\b[^>]*/>|<{self.key}\b.*?</{self.key}\s*>"
            return F.array_join(F.regexp_extract_all("event_data", F.lit(whole_element), F.lit(0)), "")
        if self.part == "payload":
            return F.expr(str(self.key))
        return F.col(str(self.key))

    def column(self, cut: bool) -> Column:
        """The typed column; `cut` applies the widths."""
        width = self.width if cut else None
        if self.part in ("time", "raw"):
            out = F.col(str(self.key))
            return F.left(out, F.lit(width)) if width else out
        out = typed(self.untyped(), self.kind, width)
        if self.fallback is not None:
            out = F.coalesce(out, self.fallback.column(cut))
        return F.coalesce(out, F.lit(self.default)) if self.default is not None else out


def value(key: str | int, kind: str = STRING, width: int | None = None, default: str | None = None) -> Source:
    return Source(envelope.VALUES, key, kind, width, default)


def text(key: str | int, width: int | None = None) -> Source:
    return Source(envelope.TEXTS, key, STRING, width)


def action(key: str | int, kind: str = STRING) -> Source:
    return Source(envelope.ACTIONS, key, kind)


def type_name(position: int, width: int | None = None) -> Source:
    return Source(envelope.TYPES, position, STRING, width)


def attribute(component: str, name: str, kind: str = STRING, width: int | None = None) -> Source:
    return Source("payload", f"{component}._{name}", kind, width)


def nested(path: str, kind: str = STRING) -> Source:
    """`path` is a column path into a payload column."""
    return Source("payload", path, kind)


def fragment(element: str) -> Source:
    return Source("fragment", element)


def stamp() -> Source:
    return Source("time", "event_time", DATETIME)


def column(name: str, width: int | None = None) -> Source:
    return Source("raw", name, STRING, width)


def run(start: int, names: str, kind: str = STRING, width: int | None = None) -> dict[str, Source]:
    """Consecutive values, from position `start`, named in order."""
    return {n: value(start + i, kind, width) for i, n in enumerate(names.split())}


@dataclass(frozen=True)
class TableSpec:
    """One typed table: which records go in and what its columns are."""

    table: str
    columns: dict[str, Source]
    event: str | None = None  # object_name routed here; None takes every record
    where: Callable[[], Column] | None = field(default=None, compare=False)  # on parsed-layer columns
    reads: frozenset[str] = frozenset()  # envelope parts `where` needs
    spells: str | None = None  # the value or text `where` compares with: see `may_match`
    spells_at: int | None = None  # the position of that value, if `where` takes it by position
    payload: dict[str, str] = field(default_factory=dict)
    ring_buffer: str | None = None  # the nested event shredded instead of the record itself

    @cached_property
    def parts(self) -> frozenset[str]:
        used: set[str] = set(self.reads)
        for source in self.columns.values():
            for s in (source, source.fallback):
                if s is not None and s.part in envelope.EVERY_PART:
                    used.add(s.part)
        return frozenset(used)

    def may_match(self) -> Column | None:
        """A test on the raw text that no matching record fails, so that others are not parsed.

        A value equal to `spells` stands right behind the '>' of its tag, unless the record writes
        text as CDATA or with character references. A record that begins plainly shows the value at
        `spells_at` in its head; the rest of it, which may be a long dump, is not searched then.
        """
        if self.spells is None:
            return None
        xml = F.col("event_data")
        spelled = F.contains(F.lower(xml), F.lit(f">{self.spells.lower()}"))
        anywhere = spelled | F.contains(xml, F.lit("<![CDATA[")) | F.contains(xml, F.lit("&#"))
        if self.spells_at is None:
            return anywhere
        return ~F.rlike(xml, F.lit(reads_otherwise(self.spells_at, self.spells))) & anywhere

    def keeping_raw(self) -> "TableSpec":
        """The same table with the raw event text as its last column."""
        return replace(self, columns={**self.columns, "EventData": column("event_data")})
