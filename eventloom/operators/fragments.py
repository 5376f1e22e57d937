"""Lists inside component records, one row an entry, with types.

The component tables keep such a list as markup, or its first entry. Here the list is read by the
record's one parse, as an array of structs, and opened.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.typed import typed
from eventloom.operators.shred import routed
from eventloom.operators.specs import TableSpec, column, stamp


@dataclass(frozen=True)
class ListSpec:
    """A list of entries in the records of a component table."""

    table: str
    of: TableSpec
    payload: dict[str, str]
    #: Each list of a record: its marks, columns that tell it from the others, and the SQL of its array of entries.
    lists: list[tuple[dict[str, str], str]]
    #: Attributes of an entry and their types.
    attributes: dict[str, str]

    def records(self) -> TableSpec:
        head = {"object_name": column("object_name"), "TimeStampUTC": stamp()}
        return replace(self.of, table=self.table, columns=head, payload=self.payload)


def entries(events: DataFrame, spec: ListSpec) -> DataFrame:
    """A row an entry: object_name, TimeStampUTC, the list's marks, position (from 1), and the attributes.

    `events` is the raw layer or a parsed one that holds the payload (`components.EVERY_PAYLOAD`).
    Absent attributes are NULL; records without the list, or with an empty one, have no rows.
    """
    records = spec.records()
    listed = []
    for marks, array in spec.lists:
        named = [F.lit(v).alias(n) for n, v in marks.items()]
        own = F.transform(F.expr(array), lambda e, i: F.struct(*named, (i + 1).alias("position"), *[e[f"_{a}"].alias(a) for a in spec.attributes]))  # noqa: B023
        listed.append(F.coalesce(own, F.array()))
    head = [source.column(False).alias(n) for n, source in records.columns.items()]
    rows = routed(events, records).select(*head, F.inline(F.concat(*listed)))
    kept = [F.col(c) for c in (*records.columns, *spec.lists[0][0], "position")]
    return rows.select(*kept, *[typed(F.col(a), kind).alias(a) for a, kind in spec.attributes.items()])
