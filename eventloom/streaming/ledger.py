"""Ring-buffer events loaded once, however often their dumps come back.

    <path>/ledger/day=.../load=...   hash of every event text loaded
    <path>/events/day=.../load=...   the typed rows, each with the hash of its values

A load cuts the texts of matching events out of its dumps and looks them up in the ledger, on the days
they are of alone. Only texts not seen before are parsed, and only the days they are of get new files:
nothing that lies there is written again. Events may come as late as they like.

A load has a name. Its files are replaced when it is repeated under that name, so a load that broke off
can be run again: what it has written is not in the ledger's other loads, and is loaded anew.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.ring_buffer import matching_text, parsed_texts
from eventloom.operators.shred import route, shred
from eventloom.operators.specs import TableSpec
from eventloom.sources.tables import save, shared_folder

# The event's own day, as its start tag writes it; texts of several events have none.
_DAY = r"""<event\b[^<>]*\btimestamp\s*=\s*["'](\d{4}-\d\d-\d\d)T"""
NO_DAY = "none"
#: Days that a lookup names; a load of more looks into all of them.
MOST_DAYS = 10_000


_LEDGER = "text_hash string, day string, load string"


def _read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _stored_schema(spark: SparkSession, spec: TableSpec) -> T.StructType:
    none = spark.createDataFrame([], "object_name string, event_data string, file_name string, file_offset bigint")
    return shred(none, spec).schema.add("row_hash", "string").add("day", "string").add("load", "string")


def _unseen(rows: DataFrame, known: DataFrame | None, load: str, key: str) -> DataFrame:
    """Rows (day, key, ...) that `known` does not hold, but for what this same load has brought before."""
    if known is None:
        return rows
    days = [r.day for r in rows.select("day").distinct().limit(MOST_DAYS + 1).collect()]
    near = known.where(F.col("load") != load)
    near = near.where(F.col("day").isin(days)) if len(days) <= MOST_DAYS else near
    return rows.join(near.select("day", key), ["day", key], "left_anti")


def _append(rows: DataFrame, path: str, load: str) -> None:
    dealt = rows.withColumn("load", F.lit(load)).hint("rebalance", "day")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "load").parquet(path)


def new_texts(dumps: DataFrame, spec: TableSpec, path: str, load: str) -> DataFrame:
    """(day, text_hash, buffers) of the events in `dumps` that no other load has brought, each once; nothing is parsed."""
    texts = matching_text(route(dumps, spec), spec.ring_buffer, "all")
    one = F.regexp_count("buffers", F.lit(r"<event\b")) == 1
    day = F.when(one, F.nullif(F.regexp_extract("buffers", _DAY, 1), F.lit("")))
    cut = texts.select(F.coalesce(day, F.lit(NO_DAY)).alias("day"), F.sha2("buffers", 256).alias("text_hash"), "buffers")
    once = cut.groupBy("day", "text_hash").agg(F.any_value("buffers").alias("buffers"))
    once = save(once, f"{shared_folder(dumps.sparkSession)}/texts")
    return _unseen(once, _read(dumps.sparkSession, f"{path}/ledger", _LEDGER), load, "text_hash")


def load_dumps(dumps: DataFrame, spec: TableSpec, path: str, load: str) -> DataFrame:
    """Load the ring-buffer events of raw records into the table under `path`; returns the texts that were new.

    `load` names this load, for instance after the batch or the files it takes. The ledger is written
    last: a load is done when it has its texts there.
    """
    spark, path = dumps.sparkSession, path.rstrip("/")
    new = save(new_texts(dumps, spec, path, load), f"{shared_folder(spark)}/new")
    rows = parsed_texts(new, spec)
    rows = rows.select(*[s.column(False).alias(n) for n, s in spec.columns.items()], F.coalesce(F.date_format("event_time", "yyyy-MM-dd"), F.lit(NO_DAY)).alias("day"))
    # Texts that differ can say the same: rows are told apart by their values as well.
    rows = rows.withColumn("row_hash", F.sha2(F.to_json(F.struct(*spec.columns), {"ignoreNullFields": "false"}), 256)).dropDuplicates(["day", "row_hash"])
    rows = save(rows, f"{shared_folder(spark)}/rows")
    _append(_unseen(rows, _read(spark, f"{path}/events", _stored_schema(spark, spec)), load, "row_hash"), f"{path}/events", load)
    _append(new.select("day", "text_hash"), f"{path}/ledger", load)
    return new


def loaded_events(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """The table: each event once."""
    return spark.read.schema(_stored_schema(spark, spec)).parquet(f"{path.rstrip('/')}/events").select(*spec.columns)
