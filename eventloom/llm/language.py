"""Language by rank-order profiles.

A profile is the list of a language's most frequent n-grams of letters, n from 1 to 3, by rank. A
document's own most frequent n-grams are ranked likewise over its whole text, and the language with
the smallest out-of-place distance wins: the sum of rank differences, with the profile's size for an
n-gram the profile lacks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.samples import first_of_each, with_texts
from eventloom.llm.storage import stored

#: N-grams of a profile; documents of a language that profiles are learned from at most.
SIZE, OF_LANGUAGE = 400, 2_000
#: Languages whose profiles are broadcast together; more are compared in turn.
TOGETHER = 2_500


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as numbers in ascending order, counts); words have a blank at either end."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    letter = _letters()[codes]
    if not letter.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.concatenate([[32], np.where(letter, codes, 32), [32]])
    codes = codes[np.append(True, (codes[1:] != 32) | (codes[:-1] != 32))]
    two = codes[:-1] << 21 | codes[1:]
    three = two[:-1] << 21 | codes[2:]
    return np.unique(np.concatenate([codes[codes != 32], two, three]), return_counts=True)


def ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent keys, ties to the smaller one."""
    return keys[np.argsort(-counts, kind="stable")[:size]]


def fit(docs: DataFrame, learnable, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", size: int = SIZE, of_language: int = OF_LANGUAGE) -> dict[str, list[int]]:
    """Profiles by language, from at most `of_language` documents of each for which `learnable(id column name)` holds.

    Rows with a null id, language or text are not learned from. Every gram of a chosen document counts.
    """
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[lang].alias("lang")).where("doc_id IS NOT NULL AND lang IS NOT NULL").where(learnable("doc_id"))
    chosen = stored(first_of_each(rows.distinct(), "lang", of_language), "choice")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {}
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                found.setdefault(name, []).append(grams(t.as_py()))
            for name, own in found.items():
                keys, at = np.unique(np.concatenate([k for k, _ in own]), return_inverse=True)
                total = np.bincount(at, np.concatenate([n for _, n in own]), len(keys)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(total)], names=["lang", "gram", "n"])

    counted = with_texts(docs, chosen, doc_id, text).select("lang", F.col("text").cast("string")).mapInArrow(run, "lang string, gram long, n long")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    listed = top.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "gram"))), lambda x: x["gram"]).alias("grams"))
    # a row a language, of `size` numbers: it grows with the languages, not with the documents
    return dict(sorted((r.lang, r.grams) for r in listed.toLocalIterator()))


class Profiles:
    def __init__(self, profiles: dict[str, list[int]], size: int):
        self.names, self.size = list(profiles), size
        self.keys = np.unique(np.concatenate([np.array(p, np.int64) for p in profiles.values()])) if profiles else np.empty(0, np.int64)
        self.rank = np.full((len(self.keys) + 1, len(profiles)), -1, np.int64)
        for j, p in enumerate(profiles.values()):
            self.rank[np.searchsorted(self.keys, np.array(p, np.int64)), j] = np.arange(len(p))

    def closeness(self, text: str | None) -> np.ndarray | None:
        """How near each language is, 0 for nothing in common; None without letters."""
        own = ranked(*grams(text), self.size)
        if not len(own):
            return None
        at = np.searchsorted(self.keys, own)
        at[self.keys[np.minimum(at, len(self.keys) - 1)] != own] = len(self.keys)
        rank = self.rank[at]
        away = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(own))[:, None])).sum(axis=0)
        return self.size * len(own) - away

    def nearest(self, text: str | None) -> tuple[str | None, int, int]:
        """(language, its closeness, the sum of all languages' closeness); ties to the first name."""
        near = self.closeness(text) if self.names else None
        if near is None:
            return None, 0, 0
        best = int(near.argmax())
        return self.names[best], int(near[best]), int(near.sum())


def identify(docs: DataFrame, profiles: dict[str, list[int]], keep: list[str], text: str = "text", size: int = SIZE, together: int = TOGETHER) -> DataFrame:
    """The columns `keep` as a struct `row`, lang_pred string, score double: the share of the closeness to all languages.

    Ties go to the first name; `und` with score 0 without letters or profiles. Up to `together`
    profiles are broadcast at once; a table of more languages is compared part by part, in one pass
    over the documents, and the best of all parts counts.
    """
    sc, names = docs.sparkSession.sparkContext, list(profiles)
    parts = [{n: profiles[n] for n in names[lo : lo + together]} for lo in range(0, len(names), together)] or [{}]

    def compared(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = Profiles(shared.value, size)
            for batch in batches:
                name, near, total = (batch.column(i).to_pylist() for i in (2, 3, 4))
                for i, t in enumerate(batch.column(1)):
                    own, n, s = known.nearest(t.as_py())
                    total[i] += s
                    if own is not None and (name[i] is None or n > near[i]):
                        name[i], near[i] = own, n
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(name, pa.string()), pa.array(near, pa.int64()), pa.array(total, pa.int64())], names=batch.schema.names)

        return run

    out = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[text].alias("text"), F.lit(None).cast("string").alias("name"), F.lit(0).cast("long").alias("near"), F.lit(0).cast("long").alias("total"))
    for part in parts:
        out = out.mapInArrow(compared(sc.broadcast(part)), out.schema)
    share = F.when(F.col("name").isNull(), 0.0).when(F.col("total") == 0, 1.0 / max(1, len(names))).otherwise(F.col("near") / F.col("total"))
    return out.select("row", F.coalesce("name", F.lit("und")).alias("lang_pred"), share.alias("score"))
