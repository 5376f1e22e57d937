"""Raw events to typed tables, by specification."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.typed import STRING, failed
from eventloom.operators import envelope
from eventloom.operators.ring_buffer import ring_events
from eventloom.operators.specs import TableSpec


def route(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """The raw records of one event type; a plain column predicate, so it prunes files."""
    return raw.where(F.col("object_name") == spec.event) if spec.event else raw


def _is_parsed(df: DataFrame) -> bool:
    return "malformed" in df.columns


def routed(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Well-formed records that belong to `spec`, parsed with only what it reads.

    `events` is the raw layer or an already parsed (possibly stored) layer.
    """
    mine = route(events, spec)
    if _is_parsed(events):
        parsed = mine
    else:
        likely = spec.may_match()
        parsed = envelope.parse(mine if likely is None else mine.where(likely), spec.parts, spec.payload)
    parsed = envelope.well_formed(parsed)
    return parsed.where(spec.where()) if spec.where is not None else parsed


def shred(events: DataFrame, spec: TableSpec, cut: bool = False, mode: str = "all") -> DataFrame:
    """The typed table of `spec`.

    `cut` trims strings to the declared widths. Ring-buffer tables hold distinct events; `mode`
    is described in `ring_buffer`.
    """
    if spec.ring_buffer:
        rows = ring_events(route(events, spec), spec, mode)
    else:
        rows = routed(events, spec)
    table = rows.select(*[source.column(cut).alias(name) for name, source in spec.columns.items()])
    return table.distinct() if spec.ring_buffer else table


def sorted_out(raw: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    """The raw records with `fate`: where each one ends up, decided with one parse of what the tables choose by.

        quarantine   not well-formed, or its root is no event
        typed        taken by at least one table of `specs`
        ring buffer  a dump whose nested events are taken, not the record itself
        unrouted     well-formed, and no table's: an unlisted or NULL event type, an unknown shape
    """
    specs = list(specs)
    plain = [s for s in specs if not s.ring_buffer]

    def takes(spec: TableSpec) -> Column:
        right = F.col("object_name").eqNullSafe(spec.event) if spec.event else F.lit(True)
        return right & F.coalesce(spec.where(), F.lit(False)) if spec.where is not None else right

    dumps = [F.col("object_name").eqNullSafe(s.event) for s in specs if s.ring_buffer]
    ring = reduce(or_, dumps, F.lit(False)) & F.contains("event_data", F.lit("<RingBufferTarget"))
    typed = reduce(or_, map(takes, plain), F.lit(False))
    fate = F.when(F.col("malformed"), "quarantine").when(typed, "typed").when(ring, "ring buffer").otherwise("unrouted")
    try:
        parsed = envelope.parse(raw, frozenset().union(*[s.reads for s in plain]))
        return parsed.select(*raw.columns, fate.alias("fate"))
    except AnalysisException:  # a `where` reads columns that its spec does not list
        parts = frozenset().union(*[s.parts for s in plain])
        parsed = envelope.parse(raw, parts, {k: v for s in plain for k, v in s.payload.items()})
        return parsed.select(*raw.columns, fate.alias("fate"))


def unrouted(raw: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    """The well-formed raw records that no table of `specs` takes."""
    return sorted_out(raw, specs).where("fate = 'unrouted'").drop("fate")


def settle(table: DataFrame) -> DataFrame:
    """Put an exchange behind a lazily shredded table.

    A global sort reads its input twice (it samples the key range first). With the exchange both
    passes read shuffled rows and the XML is parsed once; AQE sizes its partitions. Stored tables
    do not need it.
    """
    return table.hint("rebalance")


def shred_all(events: DataFrame, specs: Iterable[TableSpec], cut: bool = False) -> dict[str, DataFrame]:
    """Every table of a family, lazily."""
    return {spec.table: shred(events, spec, cut) for spec in specs}


def bad_literals(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Per typed column, how many records hold a text that is not a literal of its type."""
    rows = routed(events, spec)
    checks = {
        name: F.count_if(failed(source.untyped(), source.kind))
        for name, source in spec.columns.items()
        if source.kind != STRING and source.part not in ("time", "raw")
    }
    if not checks:
        return rows.sparkSession.createDataFrame([], "column_name string, bad bigint")
    totals = rows.agg(*[count.alias(f"c{i}") for i, count in enumerate(checks.values())])
    pairs = [F.struct(F.lit(n).alias("column_name"), F.col(f"c{i}").alias("bad")) for i, n in enumerate(checks)]
    return totals.select(F.inline(F.array(*pairs)))


def present_events(raw: DataFrame, specs: Iterable[TableSpec]) -> set[str]:
    """Which routed event types occur at all: one aggregation for a whole report run.

    The answer is bounded by the number of specifications.
    """
    known = sorted({s.event for s in specs if s.event})
    rows = raw.where(F.col("object_name").isin(known)).select("object_name").distinct().collect()
    return {r.object_name for r in rows}
