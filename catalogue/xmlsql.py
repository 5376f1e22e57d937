"""Event XML as SQL text.

An event source lists the elements of an event with one SQL expression per value. From that list
come the XML (evaluated by Spark, one record per input row) and the plain columns the oracle
reads (evaluated by DuckDB, no XML involved). Expressions use only what both dialects share.
"""

from __future__ import annotations

from dataclasses import dataclass, field


def esc(expr: str) -> str:
    """Escape character data."""
    return f"replace(replace(replace(CAST({expr} AS STRING), '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def attr(name: str, expr: str) -> str:
    """` name="value"`, or nothing when the value is NULL."""
    quoted = f"replace({esc(expr)}, '\"', '&quot;')"
    return f"coalesce(' {name}=\"' || {quoted} || '\"', '')"


def element(tag: str, attributes: dict[str, str] | None = None, inner: str | None = None) -> str:
    """SQL text that yields an element; `inner` is SQL text that yields markup."""
    attrs = "".join(f" || {attr(n, e)}" for n, e in (attributes or {}).items())
    if inner is None:
        return f"('<{tag}'{attrs} || '/>')"
    return f"('<{tag}'{attrs} || '>' || {inner} || '</{tag}>')"


@dataclass(frozen=True)
class E:
    """One data (or action) element: absent, empty or filled, depending on the row."""

    name: str
    value: str | None = None  # SQL; NULL leaves the value element out
    text: str | None = None  # SQL; NULL leaves the text element out
    type_name: str | None = None
    markup: str | None = None  # SQL yielding nested markup instead of a value
    when: str | None = None  # SQL condition for the element to exist at all
    pieces: tuple[str, ...] = ()  # SQL texts that follow each other in `markup`

    def xml(self, tag: str, in_pieces: bool = False) -> list[str]:
        parts = [f"'<{tag} name=\"{self.name}\">'"]
        if self.type_name:
            parts.append(f"'<type name=\"{self.type_name}\" package=\"p\"/>'")
        if self.pieces and in_pieces:
            parts += ["'<value>'", *self.pieces, "'</value>'"]
        elif self.markup:
            parts.append(f"'<value>' || {self.markup} || '</value>'")
        elif self.value is not None:
            parts.append(f"coalesce('<value>' || {esc(self.value)} || '</value>', '')")
        if self.text is not None:
            parts.append(f"coalesce('<text>' || {esc(self.text)} || '</text>', '')")
        parts.append(f"'</{tag}>'")
        if self.when:
            return [f"CASE WHEN {self.when} THEN concat({', '.join(parts)}) ELSE '' END"]
        return parts

    def columns(self, prefix: str = "") -> dict[str, str]:
        def cond(expr: str) -> str:
            return f"CASE WHEN {self.when} THEN {expr} END" if self.when else expr

        out = {}
        if self.value is not None:
            out[f"{prefix}v_{self.name}"] = cond(f"CAST({self.value} AS STRING)")
        if self.text is not None:
            out[f"{prefix}t_{self.name}"] = cond(f"CAST({self.text} AS STRING)")
        return out


def event_parts(name: str, ts: str, data: list[E], actions: list[E] = (), in_pieces: bool = False) -> list[str]:
    """SQL texts that follow each other in one event element; `ts` is SQL text yielding ISO text without zone."""
    parts = [f"'<event name=\"{name}\" package=\"p\" timestamp=\"'", ts, "'Z\">'"]
    for e in data:
        parts += e.xml("data", in_pieces)
    for e in actions:
        parts += e.xml("action", in_pieces)
    return [*parts, "'</event>'"]


def joined(parts: list[str]) -> str:
    return f"concat({', '.join(parts)})"


def in_steps(parts: list[str], longest: int) -> list[str]:
    """SQL texts that follow each other, joined up to texts of at most `longest` letters (or one part) each."""
    steps: list[list[str]] = [[]]
    for part in parts:
        if steps[-1] and sum(map(len, steps[-1])) + len(part) > longest:
            steps.append([])
        steps[-1].append(part)
    return [joined(step) for step in steps]


@dataclass(frozen=True, eq=False)
class EventSource:
    """The events one input table turns into: one record per row."""

    event: str
    table: str
    ts: str
    data: list[E]
    actions: list[E] = field(default_factory=list)
    extra: dict[str, str] = field(default_factory=dict)  # further oracle columns
    key: str = "0"  # SQL for file_offset

    def xml(self) -> str:
        return joined(event_parts(self.event, self.ts, self.data, self.actions))

    def pieces(self) -> list[str]:
        """The same text as many short ones, for `in_steps`."""
        return event_parts(self.event, self.ts, self.data, self.actions, in_pieces=True)

    def oracle(self, with_xml: bool = False) -> str:
        """A DuckDB subquery with the plain columns of every record (and its raw text)."""
        cols = {"object_name": f"'{self.event}'", "ts": f"CAST({self.ts} AS TIMESTAMP)"}
        if with_xml:
            cols["event_data"] = self.xml()
        for e in self.data:
            cols.update(e.columns())
        for e in self.actions:
            cols.update(e.columns("a_"))
        cols.update(self.extra)
        listed = ", ".join(f"{expr} AS {name}" for name, expr in cols.items())
        return f"(SELECT {listed} FROM {self.table})"
