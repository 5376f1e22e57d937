"""Bounded wait capture: the waits of given sessions in a given time.

The same functions take a batch or a streaming DataFrame.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.lookup import join_on
from eventloom.operators.shred import shred
from eventloom.operators.specs import TableSpec, value
from eventloom.tables.wait_capture import WAIT_INFO

CAPTURED_EVENT = "wait_info"
WAIT_END = 1  # opcode of a finished wait
DEFAULT_DURATION = timedelta(seconds=60)

_WITH_OPCODE = TableSpec(
    table="captured_waits",
    event=CAPTURED_EVENT,
    columns={**WAIT_INFO.columns, "opcode": value("opcode", "int")},
)


# A number in the plain form that captures write: the element with that name, an empty type element, its value.
_PLAIN = r"""<{tag}\b[^<>]*\bname\s*=\s*["']{name}["'][^<>]*>\s*(?:<type\b[^<>]*/>\s*)?<value\b[^<>]*>\s*(-?\d{{1,9}})\s*</value\s*>"""


def glimpsed(tag: str, name: str) -> Column:
    """A number of a record as its text shows it, before any parse; NULL where only the parser can tell.

    The text decides where it names the element once, in the plain form, and holds nothing that can
    hide or fake a tag: no comment, CDATA or declaration, no character reference.
    """
    xml = F.col("event_data")
    plain = (F.regexp_count(xml, F.lit(rf"\b{name}\b")) == 1) & ~F.contains(xml, F.lit("<!")) & ~F.contains(xml, F.lit("&#"))
    return F.when(plain, F.nullif(F.regexp_extract(xml, _PLAIN.format(tag=tag, name=name), 1), F.lit("")).cast("int"))


def finished(events: DataFrame) -> DataFrame:
    """Records but for those whose text shows another opcode than a finished wait's; parsed events as they are."""
    if "malformed" in events.columns:
        return events
    opcode = glimpsed("data", "opcode")
    return events.where(opcode.isNull() | (opcode == WAIT_END))


def of_sessions(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Records that may be of one of `sessions`, told from their text: those of another session are never parsed.

    NULL stands for a session that only the parser can tell, and is on both sides.
    """
    if "malformed" in events.columns:
        return events
    ids = sessions.select(F.col("session_id").cast("int").alias("__id"))
    ids = ids.unionByName(sessions.sparkSession.range(1).select(F.lit(None).cast("int").alias("__id")))
    glimpse = events.withColumn("__session", glimpsed("action", "session_id"))
    return glimpse.join(ids, F.col("__session").eqNullSafe(F.col("__id")), "left_semi").drop("__session")


def capture_waits(
    events: DataFrame,
    sessions: DataFrame,
    start: datetime | None = None,
    duration: timedelta = DEFAULT_DURATION,
) -> DataFrame:
    """Finished waits of the sessions in `sessions`, from `start` for `duration`.

    The session set is a semi-join: it filters, never multiplies, and Spark broadcasts it when
    it is measured small. It is met twice, with the number that a record's text shows, which leaves
    out most records before the parse, and with the parsed one, which decides. Without `start` the
    time is not bounded (a stream is bounded by its trigger instead). `start` is UTC without a zone.
    """
    waits = shred(of_sessions(finished(events), sessions), _WITH_OPCODE).where(F.col("opcode") == WAIT_END).drop("opcode")
    if start is not None:
        # Literals from text: a Python datetime would pass through the local time zone.
        begin = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
        end = F.lit((start + duration).isoformat(sep=" ")).cast("timestamp_ntz")
        waits = waits.where((F.col("TimeStamp") >= begin) & (F.col("TimeStamp") < end))
    return join_on(waits, sessions.select("session_id"), {"Session_ID": "session_id"}, "left_semi")


def capture_while_seen(events: DataFrame, snapshots: DataFrame, duration: timedelta = DEFAULT_DURATION, lateness: timedelta = timedelta(minutes=5)) -> DataFrame:
    """Finished waits of each session for `duration` from every time it was seen, both sides streams (or both not).

    snapshots: session_id and seen_at (timestamp_ntz, UTC), a row for each time a request was found at
    work. A wait is taken once if its session was seen at most `duration` before it; sessions come and go,
    each with its own intervals. Both streams are expected in order of time but for `lateness`: what is
    later may be missed, and what neither side can meet any more leaves the state, so the state holds
    `duration` and `lateness` of both streams, however long they run.
    """
    seconds = lambda d: f"{int(d.total_seconds() * 1000)} milliseconds"
    waits = shred(finished(events), _WITH_OPCODE).where(F.col("opcode") == WAIT_END).drop("opcode")
    # a watermark counts in instants; the zone is the session's on both sides and cancels out
    waits = waits.withColumn("__at", F.col("TimeStamp").cast("timestamp")).withWatermark("__at", seconds(lateness))
    seen = snapshots.select(F.col("session_id").alias("__id"), F.col("seen_at").cast("timestamp").alias("__seen")).withWatermark("__seen", seconds(lateness))
    near = (F.col("__at") >= F.col("__seen")) & (F.col("__at") < F.col("__seen") + F.expr(f"interval {seconds(duration)}"))
    return waits.join(seen, (F.col("Session_ID") == F.col("__id")) & near, "left_semi").drop("__at")
