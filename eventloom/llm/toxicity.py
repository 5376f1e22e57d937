"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; documents drawn without their labels are the unlabelled
set. A linear classifier over words is trained with numpy on the risk estimator

    prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive))

of logistic losses: the second part is the risk on negatives, estimated without any, and kept from
going below zero, which is what over-fitting looks like there. The prior is the share of toxic rows
among the labelled ones that may be learned from, unless given.

Features are a document's distinct words and the distinct beginnings of its words. Only those that
stand out among the positives are used, so a long text does not gather noise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.samples import first_by_hash, with_texts, within
from eventloom.llm.storage import stored
from eventloom.llm.words import words_of

#: Bounds of the training sample, in documents.
POSITIVES, UNLABELLED = 4_000, 12_000
#: And in features of all its documents, 8 bytes each, which go to the driver.
HASHES = 8_000_000
#: A feature's least positives and its least deviation, in standard errors, from the unlabelled rate.
LEAST_POSITIVES, LEAST_DEVIATION, MOST_FEATURES = 3, 5.0, 5_000


def marks(text: bytes | None) -> set[bytes]:
    """The distinct words, and with a mark the first four and five bytes of longer ones."""
    words = set(words_of(text))
    longer = [w for w in words if len(w) > 4]
    return words.union([b"4\0" + w[:4] for w in longer], [b"5\0" + w[:5] for w in longer])


def word_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, kind, text) to (doc_id, kind, hashes of its features)."""
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        found = [np.fromiter((digest(w) for w in marks(t.as_py())), dtype=np.uint64).view(np.int64) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "kind", "words"])


def places(features: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Where a row's features stand among the sorted `features`; others are left out."""
    at = np.searchsorted(features, row)
    return at[features[np.minimum(at, len(features) - 1)] == row] if len(features) else at[:0]


class Sparse:
    """0/1 rows over few features."""

    def __init__(self, rows: list[np.ndarray], features: np.ndarray):
        hits = [places(features, r) for r in rows]
        self.row = np.repeat(np.arange(len(rows)), [len(h) for h in hits])
        self.col = np.concatenate(hits).astype(np.int64) if hits else np.empty(0, np.int64)
        self.n, self.m = len(rows), len(features)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, g[self.row], self.m)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit_rows(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 400, rate: float = 0.1, decay: float = 1e-5) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature hashes, weights, bias) from distinct word hashes of the two sets."""
    if not positive or not unlabelled:
        return np.empty(0, np.int64), np.empty(0), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    words, count = np.unique(np.concatenate(positive), return_counts=True)
    words, count = words[count >= LEAST_POSITIVES], count[count >= LEAST_POSITIVES]
    other = np.zeros(len(words), np.int64)
    for row in unlabelled:  # a row at a time: the driver holds the sample once
        other[places(words, row)] += 1  # a row's features are distinct
    p, u = count / len(positive), (other + 1) / (len(unlabelled) + 2)
    deviation = (p - u) / np.sqrt(u * (1 - u) * (1 / len(positive) + 1 / len(unlabelled)))
    # of the unlabelled documents with the word, at most all are toxic: a word that means nothing has lift 1, one that decides 1 / prior
    lift = min(2, prior**-0.5)  # half way there, and 2 up to a prior of a quarter
    chosen = np.flatnonzero((deviation >= LEAST_DEVIATION) & (p / u >= lift))
    chosen = np.sort(chosen[np.argsort(-deviation[chosen], kind="stable")[:MOST_FEATURES]])
    features = words[chosen]
    xp, xu = Sparse(positive, features), Sparse(unlabelled, features)
    w = np.zeros(len(features) + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        gp, gu = xp.times(w[:-1]) + w[-1], xu.times(w[:-1]) + w[-1]
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        dp_plus, dp_minus, du = -sigmoid(-gp) / xp.n, sigmoid(gp) / xp.n, sigmoid(gu) / xu.n
        if negative >= 0:
            dp, du = prior * (dp_plus - dp_minus), du
        else:  # step back from a negative risk below zero
            dp, du = prior * dp_minus, -du
        grad = np.append(xp.back(dp) + xu.back(du), dp.sum() + du.sum())
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w[:-1] = np.maximum(w[:-1], 0)
    return features, w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, learnable, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", prior: float | None = None, positives: int = POSITIVES, unlabelled: int = UNLABELLED, hashes: int = HASHES) -> tuple[dict[int, float], float]:
    """(weights by word hash, bias), learned from rows for which `learnable(id column name)` holds.

    At most `positives` toxic and `unlabelled` further documents are read for training, both chosen
    by a hash of the id, and of these as many as have `hashes` features together. Labels other than 1 count only in the prior. Rows without an id are never
    learned from; an id labelled twice counts as toxic if any of its labels says so.
    """
    known = labels.where(F.col(label).isNotNull()).groupBy(labels["doc_id"].alias("doc_id")).agg(F.max(label).alias("toxic")).where(learnable("doc_id"))
    ids = docs.select(docs[doc_id].alias("doc_id")).where("doc_id IS NOT NULL").where(learnable("doc_id")).distinct()
    counted = known.join(ids, "doc_id", "left_semi")
    counted = stored(counted.select("doc_id", (F.col("toxic") == 1).alias("toxic")), "labels")
    toxic, rows = counted.agg(F.count_if("toxic"), F.count("*")).first()
    prior = prior if prior is not None else min(0.99, max(1e-4, (toxic or 0) / rows)) if rows else 1e-4
    chosen = first_by_hash(counted.where("toxic").select("doc_id"), positives).withColumn("kind", F.lit(1))
    chosen = chosen.unionByName(first_by_hash(ids, unlabelled, seed=8).withColumn("kind", F.lit(0)))
    texts = with_texts(docs, stored(chosen, "choice"), doc_id, text).select("doc_id", "kind", "text")
    kind = T.StructType([texts.schema["doc_id"], *T._parse_datatype_string("kind int, words array<long>").fields])
    hashed = within(stored(texts.mapInArrow(word_hashes, kind), "features"), F.size("words"), hashes).select("doc_id", "kind", "words").toArrow().sort_by([("doc_id", "ascending"), ("kind", "ascending")])
    kinds = hashed.column("kind").to_numpy()
    rows = [r.values.to_numpy() for r in hashed.column("words")]
    split = [[r for r, k in zip(rows, kinds) if k == want] for want in (1, 0)]
    features, w, bias = fit_rows(*split, prior=prior)
    return {int(f): float(x) for f, x in zip(features, w) if x}, bias


def score(docs: DataFrame, model: tuple[dict[int, float], float], keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` as a struct `row`, and score double. Null and empty texts have the bias alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # MOST_FEATURES weights at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        digest, known = xxhash.xxh64_intdigest, {}
        signed = {w & (2**64 - 1): x for w, x in weights.items()}
        for batch in batches:
            totals = []
            for t in batch.column(1):
                words = marks(t.as_py())
                for w in words.difference(known):
                    known[w] = signed.get(digest(w), 0.0)
                totals.append(bias + sum(sorted(map(known.__getitem__, words))) if words else bias)
                if len(known) > 200_000:
                    known.clear()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(np.array(totals, dtype=float)))], names=["row", "score"])

    source = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[text].cast("binary").alias("text"))
    return source.mapInArrow(run, source.select("row", F.lit(0.0).alias("score")).schema)
