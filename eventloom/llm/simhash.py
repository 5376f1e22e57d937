"""SimHash near-duplicates by tiled exact comparison.

A fingerprint of 64 bits is made of all word shingles of a text. Distinct fingerprints are laid out
in tiles by the population counts of their four quarters: two fingerprints within `radius` bits have
population counts whose differences add up to `radius` at most, so all other pairs of tiles are
skipped. What is left is compared in full with numpy's exclusive-or and bit counts.

The tile directory has at most 17**4 rows, whatever the input. A large tile is cut into chunks, so
one task holds one chunk of home fingerprints and streams its guests. A task emits a spanning
forest of the links it finds, never all pairs of a group; components are joined up afterwards.
Work grows with the square of the number of distinct fingerprints, by a small factor: the method
is exact comparison.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.components import connected
from eventloom.llm.storage import row_key, stored, whole_row

SEED = 42
QUARTERS, WIDTH = 4, 16
#: Home fingerprints of a tile that one group of a task holds.
CHUNK = 4096
#: Nodes of a task's forest before it is written out.
FOREST = 200_000


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of lower-cased words at ASCII white space; no words give zero."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        grams = [b" ".join(words)]
    elif shingle == 3:
        grams = [b"%b %b %b" % g for g in zip(words, words[1:], words[2:])]
    else:
        grams = [b" ".join(g) for g in zip(*(words[i:] for i in range(shingle)))]
    digest = xxhash.xxh64_intdigest
    h = np.fromiter([digest(g, SEED) for g in grams], dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 8192):
        ones += np.unpackbits(h[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[Column], text: str = "text", shingle: int = 3) -> DataFrame:
    """The columns `keep` and fp long, for every row."""
    source = docs.select(F.struct(*keep).alias("row"), docs[text].cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["row", "fp"])

    out = source.mapInArrow(run, source.select("row", F.lit(0).cast("long").alias("fp")).schema)
    return out.select("row.*", "fp")


def _tile(fp: str = "fp"):
    """The quarters' population counts in base 32."""
    counts = [F.bit_count(F.shiftrightunsigned(fp, WIDTH * i).bitwiseAND(F.lit((1 << WIDTH) - 1))) for i in range(QUARTERS)]
    return sum((c * 32**i for i, c in enumerate(counts)), F.lit(0)).cast("int")


def _offsets(radius: int) -> list[int]:
    """Half of the steps between tiles whose counts differ by `radius` at most, and the step to itself."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, s)) <= radius]
    return sorted({sum(d * 32**i for i, d in enumerate(s)) for s in steps if s >= (0,) * QUARTERS})


def _forest_of(near: np.ndarray, own: np.ndarray, other: np.ndarray) -> list[tuple[int, int]]:
    """Edges that join up what the matrix `near` links: fewer than it has rows and columns."""
    none = len(own)
    of_own = np.arange(none)
    while True:
        of_other = np.where(near, of_own[:, None], none).min(axis=0)
        lower = np.minimum(of_own, np.where(near, of_other[None, :], none).min(axis=1))
        if (lower == of_own).all():
            break
        of_own = lower
    ends = [*zip(own.tolist(), own[of_own].tolist()), *zip(other.tolist(), own[of_other].tolist())]
    return [(x, y) for x, y in ends if x != y]


def _compared(radius: int):
    """Stream (tile, chunk, guest, fp), sorted: home rows of a chunk first, then its guests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, homes = None, [], None
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        def forest() -> pa.RecordBatch:
            pairs = [(x, find(x)) for x in root]
            pairs = [p for p in pairs if p[0] != p[1]]
            root.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            tile, chunk, guest, fp = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            where = tile.astype(np.int64) << 32 | chunk
            cuts = np.flatnonzero((where[1:] != where[:-1]) | (guest[1:] != guest[:-1])) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(fp)]):
                if lo == hi:
                    continue
                if at != where[lo]:
                    at, parts, homes = where[lo], [], None
                if not guest[lo]:
                    parts.append(fp[lo:hi].copy())
                    continue
                if homes is None:
                    homes = np.concatenate(parts) if parts else np.empty(0, np.int64)
                for i in range(0, len(homes), 64):
                    own = homes[i : i + 64]
                    for j in range(lo, hi, 2048):
                        other = fp[j : min(hi, j + 2048)]
                        near = np.bitwise_count(own[:, None].view(np.uint64) ^ other.view(np.uint64)) <= radius
                        if (hit := near.any(axis=0)).any():
                            for x, y in _forest_of(near[:, hit], own, other[hit]):
                                x, y = find(root.setdefault(x, x)), find(root.setdefault(y, y))
                                root[max(x, y)] = min(x, y)
                if len(root) > FOREST:
                    yield forest()
        if root:
            yield forest()

    return run


def links(distinct: DataFrame, radius: int = 3, chunk: int = CHUNK) -> DataFrame:
    """(a, b): a spanning forest, per task, of all pairs of `distinct(fp)` at 0 < distance <= radius."""
    tiled = distinct.select("fp", _tile().alias("tile"))
    rows = F.ceil(F.count("*") / chunk).cast("int")
    directory = tiled.groupBy("tile").agg(rows.alias("chunks"))  # 17**4 rows at most
    own = directory.select("tile", "chunks")
    home = tiled.join(own, "tile").select("tile", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("guest"), "fp")
    steps = F.array(*[F.lit(s) for s in _offsets(radius)])
    guests = tiled.select(F.explode(F.transform(steps, lambda s: F.col("tile") + s)).alias("tile"), "fp").join(directory, "tile")
    guests = guests.select("tile", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("guest"), "fp")
    both = home.union(guests).repartition("tile", "chunk").sortWithinPartitions("tile", "chunk", "guest")
    return both.mapInArrow(_compared(radius), "a long, b long")


def groups(prints: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, label, component_id) of `prints(doc_id, fp)`: label names the component, component_id is its smallest id."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    labels = connected(links(stored(nodes.select("fp"), "nodes"), radius))
    grouped = nodes.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    grouped = stored(grouped.select("fp", "first", F.coalesce("label", "fp").alias("label")), "labelled")
    firsts = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
    return stored(grouped.join(firsts, "label").select("fp", "label", "component_id"), "components")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per row of `docs`: doc_id, fp, component_id, the smallest id reachable over links of `radius` bits or fewer.

    Null and empty texts have fingerprint zero and are linked like any other. Equal texts share a
    fingerprint, so copies are never compared. A row with a null id belongs to its component, and
    gets null only where the whole component has no id. Other columns of `docs` are not looked at.
    """
    prints = stored(fingerprints(docs, [docs[doc_id].cast("long").alias("doc_id")], text, shingle), "fingerprints")
    return prints.join(groups(prints, radius), "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """The row of `docs` with the smallest id of every component, all columns; of equal rows one.

    Rows without an id stay only where their component has no other.
    """
    keep = [docs[doc_id].cast("long").alias("doc_id"), row_key(doc_id, text).alias("key")]
    prints = stored(fingerprints(docs, keep, text, shingle), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    kept = prints.join(groups(prints, radius), "fp").groupBy("label").agg(first).select("first.key")
    rows = docs.select(whole_row(docs).alias("row"), row_key(doc_id, text).alias("key")).join(kept, "key", "left_semi")
    return rows.dropDuplicates(["key"]).select("row.*")


def as_hex(fp: str = "fp"):
    """16 lower-case hexadecimal digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
