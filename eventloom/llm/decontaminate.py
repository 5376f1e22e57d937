"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton accepts every run of words of every item. Documents are streamed through it and the
length of the longest run that ends at each word is tracked; ten words, or a whole shorter item,
make a hit. Items are dealt out by hash in parts of about `PART_WORDS` words; a task builds each part's
automaton, and they are written to the shared folder. At most `GROUP` of them are broadcast at a time,
as the bytes they were written as, and a worker holds these. More parts take more passes over the
documents: what each pass hits is written by text, and the passes' hits are joined to the documents.
So no process ever holds more than a group, however many items there are.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.storage import stored, whole_row
from eventloom.llm.words import flat, kept, words_of

#: Words of the items of one automaton, give or take what a hash does and one long item; automata of a pass.
PART_WORDS, GROUP = 200_000, 4


class Automaton:
    """A generalised suffix automaton over word numbers, with the items that hold each window."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int):
        self.window = window
        self.number: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: list[set] = [set()]
        #: Lengths of whole items shorter than a window that end in a state.
        self.short: dict[int, dict[int, set]] = {}
        runs = [(i, [self.number.setdefault(w, len(self.number)) for w in words]) for i, words in items if words]
        for _, run in runs:
            last = 0
            for w in run:
                last = self._extend(last, w)
        for i, run in runs:  # which items pass through a state, as the longest run or by links
            state = 0
            for n, w in enumerate(run, 1):
                state = self.next[state][w]
                at = state
                while at > 0 and i not in self.items[at] and self.length[at] >= min(window, len(run)):
                    self.items[at].add(i)
                    at = self.link[at]
            if len(run) < window:
                self.short.setdefault(state, {}).setdefault(len(run), set()).add(i)
        self.least = min((min(window, len(run)) for _, run in runs), default=0)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if (q := nxt[last].get(w)) is not None:
            return q if length[q] == length[last] + 1 else self._split(last, w, q)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        self.items.append(set())
        p = last
        while p >= 0 and w not in nxt[p]:
            nxt[p][w] = new
            p = link[p]
        if p >= 0:
            q = nxt[p][w]
            link[new] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return new

    def _split(self, p: int, w: int, q: int) -> int:
        """A copy of q for runs of at most length[p] + 1 words."""
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        self.items.append(set())
        while p >= 0 and nxt[p].get(w) == q:
            nxt[p][w] = copy
            p = link[p]
        link[q] = copy
        return copy

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], set]:
        """Spans [first word, end) of hit words, apart from each other, and the items with occurring windows."""
        spans: list[list[int]] = []
        found: set = set()
        if not self.least or len(words) < self.least:
            return spans, found
        ids = list(map(self.number.get, words))
        n, at = len(ids), self.least - 1
        while at < n:  # a run of `least` known words covers every least-th place
            if ids[at] is None:
                at += self.least
                continue
            lo = at
            while lo > 0 and ids[lo - 1] is not None:
                lo -= 1
            hi = at + 1
            while hi < n and ids[hi] is not None:
                hi += 1
            if hi - lo >= self.least:
                self._run(ids, lo, hi, spans, found)
            at = hi + self.least
        return _merged(spans), found

    def _run(self, ids: list[int], lo: int, hi: int, spans: list[list[int]], found: set) -> None:
        nxt, link, length, window, short = self.next, self.link, self.length, self.window, self.short
        state = size = 0
        seen = None
        for i in range(lo, hi):
            w = ids[i]
            while state and w not in nxt[state]:
                state = link[state]
                size = length[state]
            if w in nxt[state]:
                state = nxt[state][w]
                size += 1
            else:
                size = 0
            take = 0
            if size >= window:
                take = size
                at = state
                while length[link[at]] >= window:
                    at = link[at]
                if at != seen:
                    found |= self.items[at]
                    seen = at
            if short and size:
                at = state
                while at > 0:
                    for m, whose in short.get(at, {}).items():
                        if m <= size:
                            found |= whose
                            take = max(take, m)
                    at = link[at]
            if take:
                if spans and spans[-1][1] >= i + 1 - take:
                    spans[-1][1] = i + 1
                    spans[-1][0] = min(spans[-1][0], i + 1 - take)
                else:
                    spans.append([i + 1 - take, i + 1])


def automata(items: DataFrame, item_id: str = "item_id", item_text: str = "text", window: int = 10, part_words: int = PART_WORDS) -> DataFrame:
    """(part, automaton binary): the items' automata, each built by a task; stored. None for no items.

    Null and empty texts are no items; a null id is an empty one. Equal rows are taken once.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("n", pa.array([len(words_of(t.as_py())) for t in batch.column(1)], pa.int64()))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def built() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([pickle.dumps(Automaton(held, window), 5)], pa.binary())], names=["part", "automaton"])

        for batch in batches:
            for part, item, text in zip(*(batch.column(c).to_pylist() for c in ("part", "item", "text"))):
                if held and part != at:
                    yield built()
                    held = []
                at = part
                held.append((item, words_of(text)))
        if held:
            yield built()

    rows = items.select(F.coalesce(items[item_id].cast("string"), F.lit("")).alias("item"), items[item_text].cast("binary").alias("text"))
    rows = stored(rows.distinct().mapInArrow(counted, "item string, text binary, n long").where("n > 0"), "items")
    parts = max(1, math.ceil((rows.agg(F.sum("n")).first()[0] or 0) / part_words))
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("item", "text"), F.lit(parts)))
    dealt = dealt.repartition(parts, "part").sortWithinPartitions("part", "item", "text")
    return stored(dealt.mapInArrow(build, "part long, automaton binary"), "automata")


class _Group:
    """Some automata as a worker gets them: unpacked once, and kept from task to task."""

    def __init__(self, rows: list):
        self.packed = [bytes(r.automaton) for r in rows]
        self.key = hashlib.sha256(b"".join(hashlib.sha256(p).digest() for p in self.packed)).hexdigest()

    def unpacked(self) -> list[Automaton]:
        return kept(f"automata {self.key}", lambda: list(map(pickle.loads, self.packed)))


def _groups(built: DataFrame, group: int) -> Iterator:
    """Broadcasts of the automata, `group` at a time."""
    parts = sorted(r.part for r in built.select("part").collect())  # a number a part
    for lo in range(0, len(parts), group):
        yield built.sparkSession.sparkContext.broadcast(_Group(built.where(F.col("part").isin(parts[lo : lo + group])).collect()))


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


_FOUND = "n_words long, spans array<struct<lo: long, hi: long>>, items array<string>"


def _scanned(shared):
    """(row, __text) to (row, __text, n_words, spans, items) by a group's automata; of no group, none is hit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.unpacked() if shared is not None else []
        for batch in batches:
            n_words, spans, items = [], [], []
            for t in batch.column(1):
                words = words_of(t.as_py())
                hits = [a.scan(words) for a in known]
                n_words.append(len(words))
                spans.append([{"lo": a, "hi": b} for a, b in (hits[0][0] if len(hits) == 1 else _merged([s for h, _ in hits for s in h]))])
                items.append(sorted(set().union(*(f for _, f in hits))))
            arrays = [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=["row", "__text", "n_words", "spans", "items"])

    return run


def _joined(rows: list[dict]) -> list[dict]:
    return [{"lo": a, "hi": b} for a, b in _merged([[s["lo"], s["hi"]] for s in rows])]


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, all passes' spans, all items) to (key, spans apart from each other, items)."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([_joined(s) for s in batch.column(1).to_pylist()], batch.schema.field(1).type), batch.column(2)], names=["key", "spans", "items"])


def find_items(docs: DataFrame, items: DataFrame, keep: list[str], text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, part_words: int = PART_WORDS, group: int = GROUP) -> DataFrame:
    """The columns `keep` as a struct `row`, n_words, spans array<struct<lo, hi>> of words, items array<string>, `__text` binary.

    Null and empty texts have no words and no hits, in documents and items alike. Equal items all
    count. With no items, or an empty table of documents, nothing is hit. Item ids are compared as
    text; a null id is taken as an empty one.
    """
    rows = docs.select(F.struct(*[docs[c] for c in keep]).alias("row"), docs[text].cast("binary").alias("__text"))
    return _found(rows, automata(items, item_id, item_text, window, part_words), group)


def _found(rows: DataFrame, built: DataFrame, group: int) -> DataFrame:
    """`rows(row, __text)` with n_words, spans and items."""
    shape = T.StructType([*rows.schema.fields, *T._parse_datatype_string(_FOUND).fields])
    if built.count() <= group:
        shared = next(_groups(built, group), None)
        return rows.mapInArrow(_scanned(shared), shape)
    # 96 bits of the text: texts that are equal are hit alike
    key = F.struct(F.xxhash64("__text").alias("a"), F.hash("__text").alias("b")).alias("key")
    passes = []
    for shared in _groups(built, group):
        hit = rows.mapInArrow(_scanned(shared), shape).where(F.size("items") > 0).select(key, "spans", "items")
        passes.append(stored(hit.dropDuplicates(["key"]), "hits"))
        shared.destroy()
    every = passes[0]
    for more in passes[1:]:
        every = every.unionByName(more)
    merged = every.groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    merged = merged.mapInArrow(_joined_up, merged.schema)
    plain = rows.mapInArrow(_scanned(None), shape).drop("spans", "items").withColumn("key", key)
    both = plain.join(merged, "key", "left")
    none = [F.coalesce(c, F.array().cast(shape[c].dataType)).alias(c) for c in ("spans", "items")]
    return both.select("row", "__text", "n_words", *none)


def summary(found: DataFrame) -> DataFrame:
    """row, n_words, n_hit, n_items, items_sha256, contaminated from `find_items`; text is left behind."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"])
    items = F.array_sort("items")
    return found.select(
        "row",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def cut_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans, and without what stands between them."""
    if not spans:
        return text
    import re

    places = [m.span() for m in re.finditer(rb"[^ ]+", flat(text))]
    out, at = [], 0
    for lo, hi in spans:
        out.append(text[at : places[lo][0]])
        at = places[hi - 1][1]
    return b"".join([*out, text[at:]])


def cut_all(text: bytes, spans: list[tuple[int, int]], automata: list[Automaton], longest: int = 0) -> bytes:
    """The text cut at the spans, and again at what the cuts have joined, until no longer span is hit."""
    while spans:
        text = cut_words(text, spans)
        words = words_of(text)
        hit = _merged([span for a in automata for span in a.scan(words)[0]])
        spans = [(lo, hi) for lo, hi in hit if hi - lo > longest]
    return text


def _cleaned(shared, longest: int, most: float):
    """(row, __text) to (row, cut) of the rows that stay: found and cut by one worker; null where nothing was cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value.unpacked() if shared is not None else []
        for batch in batches:
            stays, cuts = [], []
            for t in batch.column(1):
                body = t.as_py()
                words = words_of(body)
                hit = _merged([span for a in known for span in a.scan(words)[0]])
                stays.append(sum(hi - lo for lo, hi in hit) <= most * len(words))
                long = [(lo, hi) for lo, hi in hit if hi - lo > longest]
                cuts.append(cut_all(body, long, known, longest) if long and stays[-1] else None)
            kept_rows = pa.array(stays, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept_rows), pa.array(cuts, pa.binary()).filter(kept_rows)], names=["row", "cut"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, __text, spans) to (row, __text) without the words of the spans."""
    for batch in batches:
        spans = [[(s["lo"], s["hi"]) for s in own] for own in batch.column(2).to_pylist()]
        new = [cut_words(t.as_py(), own) for t, own in zip(batch.column(1), spans)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(new, pa.binary())], names=["row", "__text"])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", window: int = 10, longest: int = 0, most: float = 0.5, group: int = GROUP, **named) -> DataFrame:
    """`docs` with test items removed; same columns and types.

    Spans of more than `longest` hit words are cut out of the text, also those that cuts make out of
    what stood around them. A document whose hit words, before any cut, make up more than the share
    `most` of its words is dropped. Other rows are returned as they are. With more automata than a
    group, rows that were cut are searched again in passes, until none is hit.
    """
    built = automata(items, window=window, **named)
    rows = docs.select(whole_row(docs).alias("row"), docs[text].cast("binary").alias("__text"))
    shape = T.StructType([rows.schema["row"], T.StructField("cut", T.BinaryType())])
    if built.count() <= group:
        out = rows.mapInArrow(_cleaned(next(_groups(built, group), None), longest, most), shape)
    else:
        n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["hi"] - s["lo"])
        long = F.filter("spans", lambda s: s["hi"] - s["lo"] > longest).alias("spans")
        left = _found(rows, built, group).where(n_hit <= most * F.col("n_words")).select("row", "__text", long)
        left = stored(left, "found")
        todo = left.where(F.size("spans") > 0)
        done = [left.where(F.size("spans") == 0).select("row", F.lit(None).cast("binary").alias("cut"))]
        while not todo.isEmpty():
            cut = stored(todo.mapInArrow(_cut, rows.schema), "cut")
            again = stored(_found(cut, built, group).select("row", "__text", long), "found")
            done.append(again.where(F.size("spans") == 0).select("row", F.col("__text").alias("cut")))
            todo = again.where(F.size("spans") > 0)
        out = done[0]
        for more in done[1:]:
            out = out.unionByName(more)
    new = F.coalesce(F.col("cut").cast("string"), F.col(f"row.`{text}`"))
    return out.select(F.col("row").withField(f"`{text}`", new).alias("row")).select("row.*")


def digest(items: list[str]) -> str:
    """Reference for `items_sha256`."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
