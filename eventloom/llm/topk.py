"""Exact top-k search by inner product with a three-phase uniform threshold.

A vector's score is the sum of its local scores on `lists` slices of its dimensions, and each slice
is a list of its own: stored apart, in blocks of rows. For each query

1. the k best local scores of every list are gathered and their rows scored in full; the k-th best
   of these totals is a safe cutoff, and 1/lists of it is broadcast as the uniform threshold;
2. every list gives the entries that reach the threshold: a row below it on all lists cannot reach
   the cutoff;
3. what an entry's row lacks of its score is looked up in the other lists, and the rows are ranked.

Queries are taken in passes of at most `PASS` rows, which bounds what a pass broadcasts; candidates
are met in blocks of at most `BLOCK` rows, which bounds what a task holds. A task keeps the best of all its
blocks, and a pass's result is written before the next one begins. Rows with equal vectors tie
everywhere, so only the 2k with the smallest ids, of one id the k first, enter the lists: no query can
return others. Arithmetic is exact: doubles hold the sums where they are below 2**53, 64-bit integers
below 2**63, Python's integers beyond; a score that a long cannot hold is an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.storage import stored

LISTS, BLOCK, PASS, TILE = 2, 4096, 16_384, 512
#: Below any score.
LOW = -(2**63)


def quantised(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", factor: int = 256) -> DataFrame:
    """(vec_id, v array<long>): floor(factor * component), components as doubles.

    Null ids take no part, nor do vectors that are null or hold null, NaN or infinite components. Rows
    with equal ids are rows of their own. Vectors of other lengths are padded with zeros. A finite
    component that a long cannot hold after scaling is an error.
    """
    whole = lambda x: F.when(F.abs(x) < 2.0**63, F.floor(x)).otherwise(F.raise_error(F.lit("a component is too large for a long")).cast("long"))
    x = rows.select(rows[vec_id].cast("long").alias("vec_id"), F.transform(rows[vector], lambda c: c.cast("double")).alias("d"))
    fine = F.forall("d", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)))  # NaN is above
    # a condition of its own for each row, so that no component of a row left out is looked at
    v = F.when(F.col("vec_id").isNotNull() & fine, F.transform("d", lambda c: whole(c * factor)))
    return x.select("vec_id", v.alias("v")).where("v IS NOT NULL")


def _packed(lists: int, width: int, block: int):
    """Rows to blocks: (block, list, ids, values), one row for each list."""
    cuts = [width * i // lists for i in range(lists + 1)]

    def pack(ids: list, rows: list, name: int) -> pa.RecordBatch:
        m = np.zeros((len(rows), width), "<i8")
        for i, r in enumerate(rows):
            m[i, : len(r)] = r
        packed = np.array(ids, "<i8").tobytes()
        values = [np.ascontiguousarray(m[:, cuts[j] : cuts[j + 1]]).tobytes() for j in range(lists)]
        return pa.RecordBatch.from_arrays([pa.array([name] * lists, pa.int64()), pa.array(range(lists), pa.int32()), pa.array([packed] * lists, pa.binary()), pa.array(values, pa.binary())], names=["block", "list", "ids", "values"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, n = [], [], TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids.append(i)
                rows.append(v.values.to_numpy())
                if len(ids) == block:
                    yield pack(ids, rows, n)
                    ids, rows, n = [], [], n + 1
        if ids:
            yield pack(ids, rows, n)

    return run


SHAPE = "block long, list int, ids binary, values binary"


class Queries:
    """A pass's queries: ids and their values on each list; at most PASS rows."""

    def __init__(self, rows: list, width: int, lists: int):
        self.ids = np.array([r[0] for r in rows], np.int64)
        m = np.zeros((len(rows), width), np.int64)
        for i, r in enumerate(rows):
            m[i, : len(r[1])] = r[1]
        cuts = [width * i // lists for i in range(lists + 1)]
        self.on = [np.ascontiguousarray(m[:, cuts[j] : cuts[j + 1]]) for j in range(lists)]

    def scores(self, which: int, lo: int, hi: int, ids: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Local scores, exact, of queries lo to hi against a block's rows; LOW for rows of the query's id."""
        own = self.ids[lo:hi, None] == ids[None, :]
        return _exact(self.on[which][lo:hi], values, lambda a, b: a @ b.T, own)

    def some_scores(self, which: int, query: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Local scores of a query and a row at a time."""
        return _exact(self.on[which][query], values, lambda a, b: (a * b).sum(axis=1))


def _largest(m: np.ndarray) -> int:
    return max(int(m.max(initial=0)), -int(m.min(initial=0)))


def _exact(a: np.ndarray, b: np.ndarray, product, none: np.ndarray | None = None) -> np.ndarray:
    """A product of integer matrices in the cheapest arithmetic that is exact, LOW where `none` holds.

    A product that a long cannot hold is an error, but for those left out.
    """
    bound = a.shape[1] * _largest(a) * _largest(b)
    if bound < 2**53:
        found = product(a.astype(float), b.astype(float)).astype(np.int64)
    elif bound < 2**63:
        found = product(a, b)
    else:
        found = product(a.astype(object), b.astype(object))
        held = found if none is None else found[~none]
        if held.size and not (held.min() > LOW and held.max() < 2**63):
            raise OverflowError("a score is too large for a long")
    if none is not None:
        found[none] = LOW
    return found.astype(np.int64)


def _block(batch: pa.RecordBatch, i: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    ids = np.frombuffer(batch.column("ids")[i].as_py(), "<i8")
    values = np.frombuffer(batch.column("values")[i].as_py(), "<i8").reshape(len(ids), -1)
    return batch.column("block")[i].as_py(), batch.column("list")[i].as_py(), ids, values


def _rows(names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to smaller ids."""
    if len(score) > k:
        least = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= least)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((ids[at], -score[at]))[:k]]


def _gather(shared, k: int):
    """Phase 1: each query's k best rows on a list in a task's blocks: (query, list, block, place, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        best: dict[int, np.ndarray] = {}  # by list: scores, blocks and places of k rows a query
        for batch in batches:
            for i in range(batch.num_rows):
                block, which, ids, values = _block(batch, i)
                if which not in best:
                    best[which] = np.full((3, len(queries.ids), k), LOW)
                for lo in range(0, len(queries.ids), TILE):
                    s = queries.scores(which, lo, lo + TILE, ids, values)
                    n = min(k, len(ids))
                    at = np.argpartition(s, len(ids) - n, axis=1)[:, len(ids) - n :]
                    new = np.stack([np.take_along_axis(s, at, axis=1), np.full(at.shape, block), at])
                    held = np.concatenate([best[which][:, lo : lo + TILE], new], axis=2)
                    most = np.argpartition(held[0], n, axis=1)[:, n:]
                    best[which][:, lo : lo + TILE] = np.take_along_axis(held, most[None], axis=2)
        for which, (s, block, at) in best.items():
            q, col = np.nonzero(s != LOW)
            yield _rows(["query", "list", "block", "place", "score"], [q, np.full(len(q), which, np.int32), block[q, col], at[q, col], s[q, col]])

    return run


def _totals(shared, wanted):
    """Local scores of named rows: (query, block, place, score) for each list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, (blocks, query, place) = shared.value, wanted.value
        for batch in batches:
            for i in range(batch.num_rows):
                block, which, _, values = _block(batch, i)
                lo, hi = np.searchsorted(blocks, block), np.searchsorted(blocks, block, "right")
                q, p = query[lo:hi], place[lo:hi]
                s = queries.some_scores(which, q, values[p])
                yield _rows(["query", "block", "place", "score"], [q, np.full(len(q), block), p, s])

    return run


def _entries(shared, cutoffs, lists: int):
    """Phase 2: entries that reach the threshold, one row for a block, a list and a tile of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, cutoff = shared.value, cutoffs.value
        for batch in batches:
            for i in range(batch.num_rows):
                block, which, ids, values = _block(batch, i)
                for lo in range(0, len(queries.ids), TILE):
                    own = queries.ids[lo : lo + TILE]
                    s = queries.scores(which, lo, lo + TILE, ids, values)
                    least = cutoff[lo : lo + TILE] // lists + (cutoff[lo : lo + TILE] % lists != 0)  # s * lists >= cutoff, within 64 bits
                    reached = (s >= least[:, None]) & (own[:, None] != ids[None, :])
                    q, p = np.nonzero(reached)
                    if len(q):
                        data = np.stack([q + lo, p, s[q, p]]).astype("<i8").tobytes()
                        yield _rows(["block", "tile", "seen", "data"], [np.array([block]), np.array([lo]), np.array([1 << which]), np.array([data], object)])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries of one block and tile from all lists, sorted together: sums and which lists they were seen on."""

    def done(parts: list) -> bytes:
        mask = np.concatenate([np.full(x.shape[1], seen) for seen, x in parts])
        q, p, s = np.concatenate([x for _, x in parts], axis=1)
        key, at = np.unique(q << 32 | p, return_inverse=True)
        total, seen = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        np.add.at(total, at, s)
        np.bitwise_or.at(seen, at, mask)
        return np.stack([key >> 32, key & 0xFFFFFFFF, total, seen]).astype("<i8").tobytes()

    at, parts = None, []
    for batch in batches:
        for block, tile, seen, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if at != (block, tile) and parts:
                yield _rows(["block", "tile", "data"], [np.array([at[0]]), np.array([at[1]]), np.array([done(parts)], object)])
                parts = []
            at = (block, tile)
            parts.append((seen, np.frombuffer(data, "<i8").reshape(3, -1)))
    if parts:
        yield _rows(["block", "tile", "data"], [np.array([at[0]]), np.array([at[1]]), np.array([done(parts)], object)])


def _resolve(shared, which: int):
    """Phase 3: add a list's local scores to the rows that lack them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                block, _, _, values = _block(batch, i)
                q, p, s, seen = np.frombuffer(batch.column("data")[i].as_py(), "<i8").reshape(4, -1).copy()
                lack = np.flatnonzero(seen & (1 << which) == 0)
                for lo in range(0, len(lack), 65_536):
                    some = lack[lo : lo + 65_536]
                    s[some] += queries.some_scores(which, q[some], values[p[some]])
                yield _rows(["block", "tile", "data"], [np.array([block]), np.array([batch.column("tile")[i].as_py()]), np.array([np.stack([q, p, s, seen]).tobytes()], object)])

    return run


def _ranked(shared, k: int):
    """The k best of each query in a block: (query_id, vec_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Queries = shared.value
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), "<i8")
                q, p, s, _ = np.frombuffer(batch.column("data")[i].as_py(), "<i8").reshape(4, -1)
                order = np.lexsort((ids[p], -s, q))
                q, p, s = q[order], p[order], s[order]
                first = np.flatnonzero(np.append(True, q[1:] != q[:-1]))
                rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
                top = rank < k
                yield _rows(["query_id", "vec_id", "score"], [queries.ids[q[top]], ids[p[top]], s[top]])

    return run


def _cutoffs(gathered: DataFrame, blocks: DataFrame, shared, n_queries: int, k: int) -> np.ndarray:
    """Each query's k-th best total among the rows that phase 1 gathered; the lowest number where there are fewer."""
    sc = blocks.sparkSession.sparkContext
    order = Window.partitionBy("query", "list").orderBy(F.desc("score"), "block", "place")
    near = gathered.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    near = near.select("query", "block", "place").distinct().toArrow()  # PASS * LISTS * k rows at most
    query, block, place = (near.column(c).to_numpy() for c in ("query", "block", "place"))
    at = np.argsort(block, kind="stable")
    wanted = sc.broadcast((block[at], query[at], place[at]))
    totals = blocks.mapInArrow(_totals(shared, wanted), "query long, block long, place long, score long")
    totals = totals.groupBy("query", "block", "place").agg(F.sum("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "block", "place")
    kth = totals.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("query", "score").toArrow()
    cutoff = np.full(n_queries, LOW)
    cutoff[kth.column("query").to_numpy()] = kth.column("score").to_numpy()
    return cutoff


def top_k(vectors: DataFrame, is_query, k: int = 5, lists: int = LISTS, block: int = BLOCK, per_pass: int = PASS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of `vectors(vec_id, v array<long>)` for each query.

    is_query: column expression that picks the queries; rows with the query's id are no candidates of it.
    Ties go to the smaller vec_id; fewer candidates give fewer rows. Rows that share an id are candidates
    of their own, and as queries are answered together.
    """
    spark = vectors.sparkSession
    vectors = stored(vectors.withColumn("row", F.monotonically_increasing_id()), "vectors")
    size = F.aggregate("v", F.lit(0.0), lambda a, c: F.greatest(a, F.abs(c.cast("double"))))
    n, width, largest = vectors.agg(F.count("*"), F.max(F.size("v")), F.max(size)).first()
    if (width or 0) * (largest or 0) ** 2 >= 2.0**62:
        lists = 1  # parts of a score could leave a long that the score does not leave
    of_id, equal = Window.partitionBy("v", "vec_id").orderBy("row"), Window.partitionBy("v").orderBy("vec_id", "row")
    useful = vectors.withColumn("n", F.row_number().over(of_id)).where(F.col("n") <= k).withColumn("n", F.row_number().over(equal)).where(F.col("n") <= 2 * k)
    # no more tasks than whole blocks
    useful = useful.select("vec_id", "v").coalesce(max(1, n // block))
    blocks = stored(useful.mapInArrow(_packed(lists, width or 0, block), SHAPE), "lists")
    asked = vectors.where(is_query)
    found, last = [], None
    while True:
        rest = asked if last is None else asked.where((F.col("vec_id") > last[0]) | ((F.col("vec_id") == last[0]) & (F.col("row") > last[1])))
        rows = [(r.vec_id, r.v, r.row) for r in rest.orderBy("vec_id", "row").limit(per_pass).collect()]
        if not rows:
            break
        last = (rows[-1][0], rows[-1][2])
        found.append(stored(_pass(blocks, Queries(rows, width, lists), k, lists), "found"))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = reduce(DataFrame.union, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _pass(blocks: DataFrame, queries: Queries, k: int, lists: int) -> DataFrame:
    """(query_id, vec_id, score): the k best rows of a pass's queries, out of the blocks' own k best."""
    sc = blocks.sparkSession.sparkContext
    shared = sc.broadcast(queries)
    gathered = blocks.mapInArrow(_gather(shared, k), "query long, list int, block long, place long, score long")
    cutoffs = sc.broadcast(_cutoffs(gathered, blocks, shared, len(queries.ids), k))
    entries = blocks.mapInArrow(_entries(shared, cutoffs, lists), "block long, tile long, seen long, data binary")
    pending = entries.repartition("block", "tile").sortWithinPartitions("block", "tile").mapInArrow(_merge, "block long, tile long, data binary")
    for which in range(lists):
        joined = pending.join(blocks.where(F.col("list") == which), "block")
        pending = joined.mapInArrow(_resolve(shared, which), "block long, tile long, data binary")
    named = pending.join(blocks.where(F.col("list") == 0).select("block", "ids"), "block")
    ranked = named.mapInArrow(_ranked(shared, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return ranked.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n")
