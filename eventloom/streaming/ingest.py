"""Continuous ingestion: follow capture files, shred, append.

`append_table` feeds one table. `ingest_tables` feeds all tables of a log from one stream and one parse
of each record. Ring-buffer events repeat; they are made distinct when read (`distinct_rows`), or kept
distinct as they are loaded (`streaming.ledger`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventloom.operators import envelope
from eventloom.operators.ring_buffer import ring_events
from eventloom.operators.shred import route, shred
from eventloom.operators.specs import TableSpec
from eventloom.sources.tables import save


def append_table(events: DataFrame, spec: TableSpec, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Shred a stream of raw events into an append-only table.

    Files and rows are recorded exactly once through the checkpoint, which has to lie in shared
    storage to survive the loss of the driver.
    """
    return append(shred(events, spec), path, checkpoint, trigger)


def append(rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


def write_batch(batch: DataFrame, batch_id: int, specs: Sequence[TableSpec], path: str) -> None:
    """One micro-batch of raw events into every table of `specs`: parsed once, stored parsed, shredded from there.

    A batch has folders of its own under each table, and a mark under `batches` once all are written.
    A batch that comes again replaces its own folders, so it adds nothing; one that broke off has no
    mark, and readers do not see it.
    """
    payload = {name: ddl for s in specs for name, ddl in s.payload.items()}
    parsed = save(envelope.parse(batch, payload=payload), f"{path}/parsed/batch={batch_id}", ["object_name"])
    for spec in specs:
        save(shred(parsed, spec), f"{path}/{spec.table}/batch={batch_id}")
    save(batch.sparkSession.range(1).select(F.lit(batch_id).cast("long").alias("id")), f"{path}/batches/{batch_id}")


def ingest_tables(events: DataFrame, specs: Sequence[TableSpec], path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Shred a stream of raw events into all tables of a log, each record parsed once. Read them with `ingested`."""
    specs, path = list(specs), path.rstrip("/")
    writer = events.writeStream.foreachBatch(lambda batch, n: write_batch(batch, n, specs, path))
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def ingested(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """A table as far as whole batches have brought it; the other batches' folders are not read.

    Ring-buffer tables repeat what several batches have brought: see `distinct_rows`.
    """
    done = spark.read.option("recursiveFileLookup", True).schema("id long").parquet(f"{path.rstrip('/')}/batches")
    rows = spark.read.parquet(f"{path.rstrip('/')}/{spec.table}")
    return rows.join(done, rows["batch"] == done["id"], "left_semi").drop("batch")


def ring_rows(events: DataFrame, spec: TableSpec) -> DataFrame:
    """Ring-buffer events of a stream, as often as their buffers repeat them; keeps no state.

    Buffers hold old events by nature, so no watermark can tell a late event from a repeat. Append
    these rows, and remove the repeats where they are read (`distinct_rows`) or from time to time
    (`compact_rows`).
    """
    rows = ring_events(route(events, spec), spec, unique_text=False)
    return rows.select(*[s.column(False).alias(n) for n, s in spec.columns.items()])


def distinct_rows(appended: DataFrame) -> DataFrame:
    """Each event once, however many batches brought it, in whatever order."""
    return appended.distinct()


def compact_rows(appended: DataFrame, path: str) -> DataFrame:
    """Write the distinct rows as a table of its own. `path` must not be the one being read."""
    distinct_rows(appended).write.mode("overwrite").parquet(path)
    return appended.sparkSession.read.schema(appended.schema).parquet(path)
