"""A corpus pipeline over documents: each stage works on all its predecessor kept.

    toxicity          rejected documents go
    near copies       of documents whose SimHash fingerprints are linked, one stays
    decontamination   benchmark passages are cut out; documents that are mostly benchmark go
    secrets           live-looking secrets are replaced in the texts
    pieces            the ids of every text and what they decode to

All stages but the last return every column of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import decontaminate, pieces, secrets, simhash, toxicity
from eventloom.llm.queries import TOXIC, learnable, piece_model, table
from eventloom.llm.storage import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the rejection threshold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learnable(3, 1))
    return toxicity.score(docs, model, docs.columns).where(F.col("score") < TOXIC).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of three-word shingles, three bits apart or fewer."""
    return simhash.one_of_each(docs)


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark passages."""
    return _sized(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with a mark in place of each live-looking secret."""
    return _sized(secrets.redact(docs))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the ids of the text, their number, and whether they decode to the text."""
    coded = pieces.round_trips(docs, piece_model())
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), "returned")


STAGES = [
    ("toxicity", drop_toxic),
    ("near copies", drop_copies),
    ("decontamination", cut_benchmark),
    ("secrets", hide_secrets),
    ("pieces", to_pieces),
]

#: The stages learn, hash and segment: none of it can be said in SQL; they are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each one's result written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_folder(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
