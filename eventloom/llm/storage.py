"""Where intermediate tables live, and how a row is known again.

Lineage is cut by Parquet tables in the folder that `spark.checkpoint.dir` names, which every
executor and the driver see. Where the setting is unset, the warehouse folder, shared by its own
contract, takes them. Each run has a folder of its own; whoever owns the setting empties it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder name under the shared one."""
    top = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    if not spark.conf.get("spark.checkpoint.dir", None) and top.startswith("file:") and not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError("spark.checkpoint.dir is unset and the warehouse is a folder of this machine: name a shared folder")
    return f"{top.rstrip('/')}/llm-{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """`df` written as Parquet to the shared folder and read back: it survives lost executors."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_key(doc_id: str, text: str) -> Column:
    """96 bits that name a row by its id and whole text, null or not; repeated rows share it."""
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.hash(text, doc_id).alias("b"))


def bucket_of(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text modulo `modulus`; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(-1)).cast("int")


def whole_row(df: DataFrame) -> Column:
    """Every column of `df` in one struct, where no name can clash with a working column."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns])


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, so that columns with other meanings cannot clash with working columns."""
    return df.select(*[df[n] for n in names])
