"""Table sinks and the folder that intermediate results go to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import envelope
from eventloom.operators.shred import shred
from eventloom.operators.specs import TableSpec
from eventloom.sources import versions


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder under the cluster's checkpoint directory.

    Executors and a restarted driver must both reach it. Where `spark.checkpoint.dir` is unset the
    warehouse folder, which they share as well, takes its place. Whoever owns the setting empties
    the folder; results that read from it are lazy, so nothing here does.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    on_cluster = not spark.conf.get("spark.master", "local").startswith("local")
    if on_cluster and not spark.conf.get("spark.checkpoint.dir", None) and base.startswith("file:"):
        raise ValueError("spark.checkpoint.dir is unset and the warehouse is a folder of this machine: name a shared folder")
    return f"{base.rstrip('/')}/eventloom-{uuid.uuid4().hex}"


#: Events of a file of the raw layer. A task takes as many files as fit its bytes, each counted as
#: `spark.sql.files.openCostInBytes` more: 32 of them with Spark's defaults, however well they are compressed.
EVENTS_A_FILE = 20_000


def save(df: DataFrame, path: str, partition_by: Iterable[str] = (), rows_a_file: int = 0) -> DataFrame:
    """Create the table, or replace its content, and read it back. rows_a_file: a longer file is cut there."""
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).option("compression", "zstd")
    keys = list(partition_by)
    (writer.partitionBy(*keys) if keys else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_as_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The same for a catalogue table, in the catalogue's own folder or under `path`."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return df.sparkSession.table(name)


def save_raw(raw: DataFrame, path: str, events_a_file: int = EVENTS_A_FILE, spread: bool = True) -> DataFrame:
    """The raw layer partitioned by event type, so that a route reads only its own files.

    The rows are rebalanced by type: AQE merges small types and splits a dominant one by bytes, so
    files have a useful size and the number of writing tasks grows with the data. That shuffles every
    text. Where tasks hold useful numbers of events of few types already, `spread` is left off: each
    task writes its own events, and no text is shuffled. Reading the layer
    means parsing it, which costs by the event, while a scan is split by bytes, and events shrink ten
    to twenty times in a file. So files are cut by their events, and the events that a task parses
    have a bound.
    """
    return save(raw.hint("rebalance", "object_name") if spread else raw, path, ["object_name"], events_a_file)


def save_parsed(raw: DataFrame, path: str, payload: dict[str, str] | None = None, parts: frozenset[str] = envelope.EVERY_PART) -> DataFrame:
    """The parsed layer as columnar files: each record is parsed once for all its tables.

    Every task writes what it parses, a file for each event type it meets: a parsed record is several
    times its text and is not shuffled. `parts` and `payload` limit what is parsed, as in `envelope.parse`.
    """
    return save(envelope.parse(raw, parts, payload), path, ["object_name"])


def taken(events: DataFrame, specs: Iterable[TableSpec]) -> DataFrame:
    """The raw records whose event type a table of `specs` takes; a plain column predicate, as in `route`."""
    names = {s.event for s in specs}
    return events if None in names else events.where(F.col("object_name").isin(sorted(names)))


def save_tables(events: DataFrame, specs: Iterable[TableSpec], path: str, cut: bool = False) -> dict[str, DataFrame]:
    """Write every typed table of a family under `path`.

    Several tables share one parse: raw events are stored as a parsed layer first, in the folder
    `parsed`, and the tables are shredded from its columns. It holds the events of the types that the
    tables take, and the parts of them that the tables read.
    """
    folder, specs = path.rstrip("/"), list(specs)
    if len(specs) > 1 and "malformed" not in events.columns:
        payload = {name: ddl for s in specs for name, ddl in s.payload.items()}
        parts = frozenset().union(*[s.parts for s in specs if not s.ring_buffer])
        events = save_parsed(taken(events, specs), f"{folder}/parsed", payload, parts)
    return {s.table: save(shred(events, s, cut), f"{folder}/{s.table}") for s in specs}


def reload_tables(events: DataFrame, specs: Iterable[TableSpec], path: str, cut: bool = False, check: Callable[[str, DataFrame], bool] | None = None) -> dict[str, DataFrame]:
    """Load every typed table of a family anew, and switch to the new ones together once all are written.

    check(table name, staged table): where it fails for any of them, or a load breaks off, readers keep
    the family as it was. Read it with `loaded_tables`.
    """
    spark, specs = events.sparkSession, list(specs)
    folder = versions.stage(spark, path)
    made = save_tables(events, specs, folder, cut)
    bad = [name for name, df in made.items() if check is not None and not check(name, df)]
    if bad:
        raise versions.Rejected(f"tables staged for {path} did not pass their check: {', '.join(bad)}")
    versions.switch(spark, path, {versions.WHOLE: folder}, folder)
    return made


def loaded_tables(spark: SparkSession, path: str, specs: Iterable[TableSpec]) -> dict[str, DataFrame]:
    """The current tables of a family that `reload_tables` has loaded."""
    folder = versions.newest(spark, path)[versions.WHOLE]
    return {s.table: spark.read.parquet(f"{folder}/{s.table}") for s in specs}


def register(tables: dict[str, DataFrame]) -> None:
    """Give result tables names for SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
