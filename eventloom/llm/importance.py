"""Target-distribution importance resampling with hashed n-grams, counted by Arrow kernels.

A batch's texts are lower-cased, split and flattened by Arrow, and the words dictionary-encoded. Runs
of n words are numbers: the number of the run of n - 1 words and the dictionary index of the word
behind it, read from the index array shifted by n - 1, make a pair; the crc32 of a pair is carried on
from that of its first part, once for each distinct pair. The crc32 modulo the number of buckets is a
feature's bucket.

Two passes over the texts: one counts buckets in the corpus and in the target, each task handing on
one sum a bucket; the other takes each feature's gain, the scaled log ratio of both distributions, and
sums gains by text. A Gumbel variate of the id's hash on top makes the highest scores a sample without
replacement in proportion to the ratio.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.storage import row_key, stored

BUCKETS, SCALE = 10_000, 1000
#: Bytes of texts that are taken apart together; one longer text is taken alone.
TOGETHER = 8 << 20
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """The texts in runs of TOGETHER bytes or one text, with the place of each run."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(texts):
        before = sizes[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(sizes, before + TOGETHER, "right")))
        yield lo, texts.slice(lo, hi - lo)
        lo = hi


def features(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to `longest`: the bucket of every run of n words, and the end of each text's runs.

    A null or empty text has none.
    """
    split = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), _SEPARATORS)
    words, parent = pc.list_flatten(split), pc.list_parent_indices(split)
    full = pc.not_equal(words, "")
    words, parent = words.filter(full), parent.filter(full).to_numpy()
    coded = words.dictionary_encode()
    index = coded.indices.to_numpy()
    names = coded.dictionary.cast(pa.binary()).to_pylist()
    crc = np.fromiter(map(zlib.crc32, names), np.int64, len(names))
    at, run = np.arange(len(index)), index
    for n in range(1, longest + 1):
        if n > 1:
            whole = at + n - 1 < len(index)
            at, run = at[whole], run[whole]
            inside = parent[at] == parent[at + n - 1]
            at, run = at[inside], run[inside]
            pairs, run = np.unique(run.astype(np.int64) * len(names) + index[at + n - 1], return_inverse=True)
            first, last = pairs // max(len(names), 1), pairs % max(len(names), 1)
            crc = np.fromiter((zlib.crc32(b" " + names[w], c) for w, c in zip(last.tolist(), crc[first].tolist())), np.int64, len(pairs))
        yield (crc % buckets)[run], np.searchsorted(parent[at], np.arange(len(texts)), "right")


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, some in _slices(batch.column(0)):
                for found, _ in features(some, longest, buckets):
                    sums += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(sums[held])], names=["bucket", "n"])

    parts = docs.select(docs[text].alias("text")).mapInArrow(run, "bucket long, n long")
    sums = parts.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # a row a bucket at most
    out = np.zeros(buckets, np.int64)
    out[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * log ratio) of each bucket, both distributions smoothed by one."""
    n, s, t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(scale * math.log((b + 1) * (s + n) / ((a + 1) * (t + n)))) for a, b in zip(corpus.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, target: DataFrame, keep: list[Column], text: str = "text", target_text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """row (a struct of `keep`), n_words, n_features, weight for every row of `docs`.

    Texts that are null or have no word weigh 0. An empty target or corpus counts nothing: every
    bucket then has the other's smoothed ratio. What a task holds is a small multiple of TOGETHER
    bytes or of its longest text; the gains that every task gets are one number a bucket.
    """
    gains = bucket_gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets))
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    source = docs.select(F.struct(*keep).alias("row"), docs[text].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            for lo, some in _slices(batch.column(1)):
                n_words, n_features, weight = None, np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
                for found, ends in features(some, longest, buckets):
                    starts = np.append(0, ends[:-1])
                    total = np.append(0, np.cumsum(gain[found]))
                    weight += total[ends] - total[starts]
                    n_features += ends - starts
                    n_words = ends - starts if n_words is None else n_words
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, len(some)), *map(pa.array, (n_words, n_features, weight))], names=["row", "n_words", "n_features", "weight"])

    zero = [F.lit(0).cast("long").alias(c) for c in ("n_words", "n_features", "weight")]
    return source.mapInArrow(run, source.select("row", *zero).schema)


def gumbel(doc_id: str, seed: int, scale: int = SCALE) -> Column:
    """floor(scale * a Gumbel variate) of the sha256 of seed and id; a null id hashes as an empty text."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-scale * F.log(-F.log((h + 0.5) / 4294967296.0)))


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """`rows` and place long, 1, 2, 3... in the whole order, without bringing them to one task.

    Range partitions are sorted apart and written; their sizes, a row a partition, say where each begins.
    """
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stored(ranged.withColumn("id", F.monotonically_increasing_id()), "ranked")
    part, at = F.shiftright("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = kept.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return kept.withColumn("part", part).join(starts, "part").withColumn("place", F.col("before") + at + 1).drop("id", "part", "before")


def ranked(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", longest: int = 1, buckets: int = BUCKETS, least_words: int = 20, percent: int = 10, seed: int = 2024) -> DataFrame:
    """doc_id, key, n_words, n_features, weight, score and rank, one row per row of `docs`.

    Of the N rows with `least_words` words or more the floor(percent * N / 100) with the highest
    scores are drawn and ranked 1, 2, 3...; equal scores go to the smaller id, null ids last. Rows
    that are not drawn have a null rank. Repeated rows are drawn apart. No rows give none.
    """
    named = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    rows = weigh(named, target, [F.col("doc_id"), row_key("doc_id", "text").alias("key")], longest=longest, buckets=buckets)
    scored = rows.select("row.doc_id", "row.key", "n_words", "n_features", "weight").withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    scored = stored(scored, "scores")
    large = F.col("n_words") >= least_words
    drawn = scored.where(large).count() * percent // 100
    out = numbered(scored, [large.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("key").asc()])
    return out.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The drawn rows of `docs`, every column; equal rows stay or go together. Only their keys are moved to find them."""
    drawn = ranked(docs, target, doc_id, text, **options).where("rank IS NOT NULL").select("key").distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), row_key(doc_id, text).alias("key"))
    return rows.join(drawn, "key", "left_semi").select("row.*")
