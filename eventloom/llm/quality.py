"""Quality by ordinal cumulative-link regression on graded ratings.

One weight vector over hashed text features is shared by all grades; ordered thresholds cut its
score: P(grade <= k) = sigmoid(threshold[k] - score). Thresholds are kept in order as a first one and
positive steps. A document gets its expected grade and, for a selection, the probability of reaching
a grade.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.samples import first_of_each, with_texts, within
from eventloom.llm.storage import stored
from eventloom.llm.toxicity import sigmoid
from eventloom.llm.words import flat

BITS = 18
#: Bound of the training sample: documents of each grade.
OF_GRADE = 3_000
#: And features of all its documents, 16 bytes each, which go to the driver.
PAIRS = 4_000_000


def features(text: bytes | None, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """(indices, values): words by dampened frequency at unit length, and the text's shape in steps."""
    text = text or b""
    words = flat(text).split()
    counts = Counter(words)
    index = [known.get(w) if w in known else known.setdefault(w, zlib.crc32(w) >> (32 - BITS)) for w in counts]
    value = np.log1p(np.fromiter(counts.values(), float, len(counts)))
    value /= max(1e-9, float(np.sqrt((value**2).sum())))
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, bare = max(1, len(words)), sum(map(len, words))
    marks = len(text) - bare - text.count(b" ") - text.count(b"\n")
    shape = {
        "words": np.log2(n),
        "length": bare / n,
        "marks": 40 * marks / max(1, len(text)),
        "distinct": 12 * len(counts) / n,
        "most": 12 * max(counts.values(), default=0) / n,
        "lines": 8 * len(set(lines)) / max(1, len(lines)),
    }
    extra = [zlib.crc32(f"\0{k}{min(20, int(v))}".encode()) >> (32 - BITS) for k, v in shape.items()]
    return np.array(index + extra, dtype=np.int64), np.concatenate([value, np.ones(len(extra))])


def fit_rows(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, steps: int = 300, rate: float = 0.05, decay: float = 3e-4) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) for grades 0..K-1, each grade weighing the same as its share of the sample."""
    k = int(grades.max(initial=0)) + 1
    if not rows or k < 2:
        return np.zeros(1 << BITS), np.zeros(max(0, k - 1))
    row = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    col, val = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows])
    w = np.zeros(1 << BITS)
    cut = np.append(0.0, np.zeros(k - 2))  # first threshold, then logarithms of the steps
    mw, vw, mc, vc = np.zeros_like(w), np.zeros_like(w), np.zeros_like(cut), np.zeros_like(cut)
    for t in range(1, steps + 1):
        theta = np.concatenate([[-np.inf], cut[0] + np.append(0, np.cumsum(np.exp(cut[1:]))), [np.inf]])
        score = np.bincount(row, w[col] * val, len(rows))
        hi, lo = sigmoid(theta[grades + 1] - score), sigmoid(theta[grades] - score)
        p = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
        back = (dhi - dlo) / len(rows)  # of minus the logarithm of p, by score
        gw = np.bincount(col, back[row] * val, 1 << BITS) + decay * w
        gt = np.bincount(grades, -dhi, k)[: k - 1] / len(rows) + np.bincount(grades, dlo, k)[1:] / len(rows)
        gc = np.append(gt.sum(), np.exp(cut[1:]) * np.cumsum(gt[::-1])[::-1][1:])
        for x, g, m, v in ((w, gw, mw, vw), (cut, gc, mc, vc)):
            m += 0.1 * (g - m)
            v += 0.001 * (g**2 - v)
            x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w, cut[0] + np.append(0, np.cumsum(np.exp(cut[1:])))


def fit(docs: DataFrame, graded: DataFrame, doc_id: str = "doc_id", text: str = "text", of_grade: int = OF_GRADE, pairs: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) from `graded(doc_id, grade int from 0)`, at most `of_grade` documents a grade, and of these
    as many as have `pairs` features together.

    Null ids and null grades are not learned from; of two grades of an id the higher counts.
    """
    known = graded.where("doc_id IS NOT NULL AND grade >= 0").groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    ids = docs.select(docs[doc_id].alias("doc_id")).distinct()
    chosen = stored(first_of_each(known.join(ids, "doc_id", "left_semi"), "grade", of_grade), "choice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for batch in batches:
            found = [features(t.as_py(), known) for t in batch.column(2)]
            arrays = [batch.column(0), batch.column(1), pa.array([i for i, _ in found], pa.list_(pa.int64())), pa.array([v for _, v in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "grade", "index", "value"])

    texts = with_texts(docs, chosen, doc_id, text).select("doc_id", "grade", "text")
    kind = T.StructType([texts.schema["doc_id"], *T._parse_datatype_string("grade int, index array<long>, value array<double>").fields])
    table = within(stored(texts.mapInArrow(run, kind), "features"), F.size("index"), pairs).select("doc_id", "grade", "index", "value").toArrow().sort_by("doc_id")
    rows = [(i.values.to_numpy(), v.values.to_numpy()) for i, v in zip(table.column("index"), table.column("value"))]
    return fit_rows(rows, table.column("grade").to_numpy().astype(np.int64))


def grade(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], keep: list[str], text: str = "text", reach: int = 1) -> DataFrame:
    """The columns `keep` as a struct `row`, expected_grade double, tail double: the chance of grade `reach` or more.

    Null and empty texts are graded by their shape alone. Without thresholds every grade is 0.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2**BITS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (w, theta), known = shared.value, {}
        for batch in batches:
            score = []
            for t in batch.column(1):
                i, v = features(t.as_py(), known)
                score.append(float(np.sort(w[i] * v).sum()))
                if len(known) > 200_000:
                    known.clear()
            above = 1 - sigmoid(theta[None, :] - np.array(score)[:, None]) if len(theta) else np.zeros((len(score), 0))
            tail = above[:, reach - 1] if 1 <= reach <= len(theta) else np.full(len(score), float(reach < 1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(above.sum(axis=1)), pa.array(tail)], names=["row", "expected_grade", "tail"])

    source = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[text].cast("binary").alias("text"))
    shape = source.select("row", F.lit(0.0).alias("expected_grade"), F.lit(0.0).alias("tail")).schema
    return source.mapInArrow(run, shape)
