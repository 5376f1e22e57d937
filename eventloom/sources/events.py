"""Raw event readers.

The raw layer is

    object_name STRING, event_data STRING, file_name STRING, file_offset BIGINT

A record is identified by (file_name, file_offset), in files of one element per line by its text; no
dense row number is made up, since that would need a global sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.operators import envelope

RAW_COLUMNS = ["object_name", "event_data", "file_name", "file_offset"]
RAW_SCHEMA = "object_name STRING, event_data STRING, file_offset BIGINT"
FORMATS = ("parquet", "orc", "json", "csv", "text")

#: Bytes of a file whose pieces of records are put in order together.
SPAN = 64 << 20

_FIRST_NAME = rf"<event\b(?:\s+{envelope.ATTRIBUTE})*?\s+name\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"


def _reader(spark: SparkSession, stream: bool, pattern: str | None):
    reader = spark.readStream if stream else spark.read
    return reader.option("pathGlobFilter", pattern) if pattern else reader


def _first_name(text: str) -> Column:
    return F.nullif(F.concat(*[F.regexp_extract(text, _FIRST_NAME, i) for i in (1, 2)]), F.lit(""))


def _with_file_name(df: DataFrame) -> DataFrame:
    return df.select("object_name", "event_data", F.col("_metadata.file_path").alias("file_name"), "file_offset")


def read_events(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    pattern: str | None = None,
    stream: bool = False,
    files_per_batch: int | None = None,
    only: Column | None = None,
) -> DataFrame:
    """Exported event records under `path`, optionally only files matching `pattern`.

    parquet, orc, json and csv files hold the columns object_name, event_data and file_offset;
    text files hold one event element per line and have no offsets: they are NULL, and a record is
    told apart by its text (`read_event_documents` gives them offsets). A csv file is read by one
    task, since event text may hold line breaks; the other formats are split. `stream` follows the folder instead,
    with at most `files_per_batch` files in a micro-batch. `only` is a predicate on `_metadata`, by
    which the scan leaves files out before it opens them.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    reader = _reader(spark, stream, pattern)
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    chosen = F.lit(True) if only is None else only
    if fmt == "text":
        lines = reader.text(path).where(chosen).where(F.trim("value") != "")
        named = lines.select(
            _first_name("value").alias("object_name"),
            F.col("value").alias("event_data"),
            F.col("_metadata.file_path").alias("file_name"),
            F.lit(None).cast("bigint").alias("file_offset"),
        )
        return named
    reader = reader.schema(RAW_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return _with_file_name(reader.format(fmt).load(path).where(chosen))


def read_event_xml(
    spark: SparkSession,
    path: str,
    pattern: str | None = None,
    parts: frozenset[str] = envelope.EVERY_PART,
    one_per_line: bool = False,
    stream: bool = False,
) -> DataFrame:
    """XML documents of <event> elements under one root, straight into the parsed layer.

    With `one_per_line` each line is an event element without a root, and large files are split
    between tasks; a document is read by one task. The file reader parses while it splits, so no
    event text is kept: tables that need a fragment or the raw event come from `read_events`.
    """
    schema = envelope.event_type(parts) + ", _corrupt_record STRING"
    reader = _reader(spark, stream, pattern).format("xml").schema(schema).options(**envelope.OPTIONS)
    events = reader.option("rowTag", "event").option("multiLine", not one_per_line).load(path)
    return envelope.from_elements(events.withColumn("file_name", F.col("_metadata.file_path")), parts)


def only_files(raw: DataFrame, file_name: Column | str) -> DataFrame:
    """Records of one capture file (the whole path or its last part)."""
    name = F.lit(file_name) if isinstance(file_name, str) else file_name
    return raw.where((F.col("file_name") == name) | F.endswith("file_name", F.concat(F.lit("/"), name)))


END = "</event>"
# Dumps hold whole events of their own: an end tag inside one does not end the record.
_DUMP_START, _DUMP_END = r"""<RingBufferTarget\b(?:[^>"'/]|"[^"]*"|'[^']*'|/(?!>))*+>""", r"</RingBufferTarget\s*>"
_EVENT_START = r"(?s)^.*?(?=<event[\s/>])"


def read_event_documents(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """The raw layer of XML documents with any number of <event> elements, on one line or many.

    Large files are split: a task reads its block up to the end tags of events in it, and no document
    is one task's. file_offset is the byte at which the record's first line part begins, so it is
    unique in its file and the same in every run. A record is the text from an event's start tag to
    its own end tag; what stands between records (a root element, declarations, blanks) is dropped.
    What a file holds behind its last end tag becomes a record without one if it has a start tag:
    a file cut short is quarantined, not completed. In compressed files, whose length says nothing
    about their text, such a rest is completed.

    Files are read twice. First each block is summed up: its bytes, and by how many dumps it goes
    deeper. The sums of the blocks before, one row a block, tell where a block begins and inside how
    many dumps. Then the text is dealt out by block, where the pieces of a record are joined up; only
    records that lie in several blocks are dealt once more.
    """
    pieces = _reader(spark, False, pattern).option("lineSep", END).text(path).select(
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("nth"),
        F.col("value"),
    )
    size = F.octet_length("value").cast("bigint") + len(END)
    deeper = F.regexp_count("value", F.lit(_DUMP_START)) - F.regexp_count("value", F.lit(_DUMP_END))
    sized = pieces.withColumns({"size": size, "deeper": deeper})
    before = Window.partitionBy("file_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sized.groupBy("file_name", "block").agg(F.sum("size").alias("size"), F.sum("deeper").alias("deeper"))
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("size", "deeper")]
    blocks = blocks.select("file_name", "block", *sums, F.sum("size").over(Window.partitionBy("file_name")).alias("total"))
    inside = Window.partitionBy("file_name", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = sized.withColumns({"upto": F.sum("size").over(inside), "depth": F.sum("deeper").over(inside)})
    before_it = F.col("deeper_before") + F.col("depth") - F.col("deeper") > 0  # its record began in a piece before
    # The last piece of a file that does not end in an end tag; text before it may be as long as a compressed file.
    rest = (F.col("size_before") + F.col("upto") == F.col("total")) & (F.col("total") == F.col("file_size") + len(END))
    located = placed.join(blocks, ["file_name", "block"]).select(
        "file_name",
        "block",
        "nth",
        (F.col("size_before") + F.col("upto") - F.col("size")).alias("at"),
        before_it.alias("begun"),
        (F.col("deeper_before") + F.col("depth") > 0).alias("goes_on"),
        F.when(rest, F.col("value")).otherwise(F.concat("value", F.lit(END))).alias("piece"),
    )
    whole = located.where(~F.col("begun") & ~F.col("goes_on")).select("file_name", "at", "piece")
    parts = _of_blocks(located.where(F.col("begun") | F.col("goes_on")))
    inner = parts.where(~F.col("begun") & ~F.col("goes_on")).select("file_name", "at", "piece")
    records = whole.unionByName(inner).unionByName(_joined_up(parts.where(F.col("begun") | F.col("goes_on"))))
    texts = records.select("file_name", F.col("at").alias("file_offset"), F.regexp_replace("piece", _EVENT_START, "").alias("event_data"))
    return texts.where(F.col("event_data").rlike(r"^<event[\s/>]")).select(_first_name("event_data").alias("object_name"), "event_data", "file_name", "file_offset")


def _of_blocks(pieces: DataFrame) -> DataFrame:
    """The same (file_name, at, begun, goes_on, piece), the pieces of a record in one block joined up.

    The rows are dealt out by block as they come.
    """
    inside = Window.partitionBy("file_name", "block").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.last(F.when(~F.col("begun"), F.col("at")), ignorenulls=True).over(inside)
    parts = F.array_sort(F.collect_list(F.struct("at", "piece", "goes_on")))
    joined = pieces.withColumn("own", own).groupBy("file_name", "block", "own").agg(parts.alias("parts"))
    return joined.select(
        "file_name",
        F.get("parts", F.lit(0))["at"].alias("at"),
        F.col("own").isNull().alias("begun"),
        F.element_at("parts", -1)["goes_on"].alias("goes_on"),
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("piece"),
    )


def _joined_up(pieces: DataFrame) -> DataFrame:
    """Records of several pieces (file_name, at, begun, goes_on, piece): the first one has not begun before, and all but the last go on.

    Pieces of a record follow each other in the file; records are told apart by their first pieces,
    a row each, so that no window runs over a whole file.
    """
    starts = Window.partitionBy("file_name", F.floor(F.col("at") / SPAN)).orderBy("at")
    known = pieces.withColumn("span", F.floor(F.col("at") / SPAN)).withColumn("own", F.when(~F.col("begun"), F.col("at")))
    near = known.withColumn("start", F.last("own", ignorenulls=True).over(starts.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    spans = known.groupBy("file_name", "span").agg(F.max("own").alias("last"))
    order = Window.partitionBy("file_name").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("file_name", "span", F.last("last", ignorenulls=True).over(order).alias("carried"))
    named = near.join(carried, ["file_name", "span"]).select("file_name", F.coalesce("start", "carried").alias("start"), "at", "piece")
    parts = F.array_sort(F.collect_list(F.struct("at", "piece")))
    return named.groupBy("file_name", "start").agg(F.array_join(F.transform(parts, lambda p: p["piece"]), "").alias("piece")).withColumnRenamed("start", "at")
