"""Wait captures (`*waitinfo*.xel` exports). Element and column names."""

from __future__ import annotations

from eventloom.functions.typed import BIGINT, INT
from eventloom.operators.specs import TableSpec, action, column, stamp, text, value

FILE_PATTERN = "*waitinfo*.xel"

WAIT_INFO = TableSpec(
    table="wait_info",
    event=None,  # a capture holds nothing else, so every record is taken
    columns={
        "object_name": column("object_name"),
        "TimeStamp": stamp(),
        "WaitType": text("wait_type"),
        "Duration": value("duration", BIGINT),
        "Signal_Duration": value("signal_duration", BIGINT),
        "Session_ID": action("session_id", INT),
        "Scheduler_ID": action("scheduler_id", INT),
        "EventSequenceNum": action("event_sequence", INT),
        "EventData": column("event_data"),
    },
)

TABLES = [WAIT_INFO]
