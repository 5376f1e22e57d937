"""Secret scans by corpus-wide ownership, in DataFrame operations alone.

Candidates are found by pattern, as spans of code points. The values of all of them are hashed and
counted over the whole corpus by distinct repositories and owners, one distinct text once: what many
owners have is an example that was copied around, and so is what more than one owner has in many
repositories; what stays with its owner looks live. Patterns that are sure by themselves stay in any
case; the loose pattern for long mixed tokens counts only where it looks live.

A text's matches become rows, and their places running sums over them, so the work is in proportion to
the text however many matches it has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.storage import row_key, stored, whole_row

# Kinds in their order, the pattern, the group that holds the value, its least length.
KINDS = [
    ("assign", r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),  # a run of 24 or more is the whole run, as with a dropped shorter one
    ("mixed", r"[A-Za-z0-9+/_-]{32,}", 0, 32),
]
#: Kinds that are found by the pattern alone.
SURE = 3
#: A value is an example from so many distinct owners on, or from two owners on in so many repositories.
COPIED, SPREAD = 3, 20
#: Code points of the blocks that a text is cut from.
BLOCK = 4096


def _matches(text: Column, kind: int, pattern: str, group: int) -> Column:
    """array<struct<kind, nth, step, size, value>> of a pattern's matches: step is their size and that of the gap before."""
    parts = F.arrays_zip(*[a.alias(n) for n, a in (("own", F.regexp_extract_all(text, F.lit(pattern), F.lit(0))), ("value", F.regexp_extract_all(text, F.lit(pattern), F.lit(group))), ("gap", F.split(text, pattern, -1)))])

    def placed(m: Column, i: Column) -> Column:
        size = F.length(m["own"])
        return F.struct(F.lit(kind).alias("kind"), i.alias("nth"), (F.length(m["gap"]) + size).alias("step"), size.alias("size"), m["value"].alias("value"))

    found = F.transform(F.filter(parts, lambda m: m["own"].isNotNull()), placed)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast("array<struct<kind:int,nth:int,step:int,size:int,value:string>>"))


def matches(docs: DataFrame, doc_id: str, text: str, repository: str, owner: str) -> DataFrame:
    """A row for each match of each kind in the texts of `docs`, long enough or not; written to the shared folder.

    (key, repository, owner, content, kind, nth, step, size, value): key names the row, content its text.
    """
    own = F.coalesce(docs[text], F.lit(""))
    found = F.concat(*[_matches(own, i, p, g) for i, (_, p, g, _) in enumerate(KINDS)])
    content = F.struct(F.xxhash64(own).alias("a"), F.hash(own).alias("b"))
    rows = docs.select(row_key(doc_id, text).alias("key"), docs[repository].cast("string").alias("repository"), docs[owner].cast("string").alias("owner"), content.alias("content"), found.alias("m"))
    return stored(rows.select("key", "repository", "owner", "content", F.inline("m")), "matches")


def _counts(kind: str, value: str) -> Column:
    """Whether a match's value is long enough for its kind, and for loose kinds mixed enough."""
    least = F.get(F.array(*[F.lit(n) for *_, n in KINDS]), F.col(kind))
    mixed = F.col(value).rlike("[0-9]") & F.col(value).rlike("[A-Z]") & F.col(value).rlike("[a-z]")
    return (F.length(value) >= least) & ((F.col(kind) < SURE) | mixed)


def ownership(found: DataFrame) -> DataFrame:
    """(value_hash, n_repositories, n_owners) of `found(value_hash, content, repository, owner)`.

    A text that several rows share counts once, for the smallest of their repositories and owners.
    Sums with partial aggregates, so a value that a third of all rows have costs a task no more than
    its own rows. A null repository or owner counts as one.
    """
    once = found.groupBy("value_hash", "content").agg(F.min(F.struct("repository", "owner")).alias("of"))
    by_owner = once.select("value_hash", "of.repository", "of.owner").distinct().groupBy("value_hash", "owner").agg(F.count("*").alias("n"))
    return by_owner.groupBy("value_hash").agg(F.sum("n").alias("n_repositories"), F.count("*").alias("n_owners"))


def judged(found: DataFrame, copied: int = COPIED, spread: int = SPREAD) -> DataFrame:
    """(key, kind, lo, hi, live, n_repositories, n_owners) of `matches`, a row a span; loose spans only where live.

    Places are sums within a document: a task holds no more than one document's matches.
    """
    order = Window.partitionBy("key", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    once = found.groupBy("key", "kind", "nth").agg(*[F.max(c).alias(c) for c in ("step", "size", "value")])  # rows may repeat
    spans = once.withColumn("hi", F.sum("step").over(order).cast("int")).where(_counts("kind", "value"))
    hashed = F.sha2(F.col("value").cast("binary"), 256).alias("value_hash")
    owned = ownership(found.where(_counts("kind", "value")).select(hashed, "content", "repository", "owner"))
    live = ~((F.col("n_owners") >= copied) | ((F.col("n_owners") > 1) & (F.col("n_repositories") >= spread)))
    known = spans.select("key", "kind", (F.col("hi") - F.col("size")).alias("lo"), "hi", hashed).join(owned, "value_hash")
    known = known.select("key", "kind", "lo", "hi", live.alias("live"), "n_repositories", "n_owners")
    return known.where((F.col("kind") < SURE) | F.col("live"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(name) for name, *_ in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["lo"].cast("string"), s["hi"].cast("string"))), ",")


def find_secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source", copied: int = COPIED, spread: int = SPREAD) -> DataFrame:
    """One row per row of `docs`: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied, n_repositories, n_owners.

    A value with `copied` owners, or with two and `spread` repositories, is copied, else live. The last
    two columns are the largest counts of any of the document's values. Null and empty texts have no
    span; the sha256 is then that of the empty text. Repeated rows are repeated, and count once in the
    corpus.
    """
    spans = judged(matches(docs, doc_id, text, repository, owner), copied, spread)
    n = lambda c, name: F.count_if(c).alias(name)
    listed = F.array_sort(F.collect_list(F.struct("lo", "kind", "hi"))).alias("found")
    counts = [n(F.col("kind") == i, f"n_{KINDS[i][0]}") for i in range(SURE)] + [n(F.col("live"), "n_live"), n(~F.col("live"), "n_copied")]
    most = [F.max(c).alias(c) for c in ("n_repositories", "n_owners")]
    by_key = spans.groupBy("key").agg(listed, *counts, *most)
    every = docs.select(docs[doc_id].alias("doc_id"), row_key(doc_id, text).alias("key")).join(by_key, "key", "left")
    found = F.coalesce("found", F.array().cast("array<struct<lo:int,kind:int,hi:int>>"))
    base = F.sha2(_joined(F.filter(found, lambda s: s["kind"] < SURE)).cast("binary"), 256).alias("base_sha256")
    zero = lambda *names: [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in names]
    return every.select("doc_id", *zero("n_assign", "n_access", "n_hex"), base, _joined(found).alias("spans"), *zero("n_live", "n_copied", "n_repositories", "n_owners"))


def _cuts(live: DataFrame) -> DataFrame:
    """(key, cuts array<struct<lo, hi>>): the spans of `live(key, lo, hi)`, those that overlap as one."""
    order = Window.partitionBy("key").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begun = live.withColumn("new", F.when(F.col("lo") < before, 0).otherwise(1))
    numbered = begun.withColumn("cut", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    merged = numbered.groupBy("key", "cut").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return merged.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("cuts"))


def _without(text: Column, cuts: Column, mark: str) -> Column:
    """`text` with `mark` in place of each of `cuts`, apart and in order.

    What stands between is taken from blocks of the text: finding a place in the whole text costs as
    much as what lies before it.
    """

    def piece(blocks: Column, lo: Column, hi: Column) -> Column:
        first, last = F.floor(lo / BLOCK).cast("int"), F.floor((hi - 1) / BLOCK).cast("int")
        head = F.get(blocks, first).substr(lo % BLOCK + 1, F.least(hi - lo, F.lit(BLOCK)))
        rest = F.concat(F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.get(blocks, last).substr(F.lit(1), (hi - 1) % BLOCK + 1))
        return F.when(hi <= lo, F.lit("")).when(first == last, head).otherwise(F.concat(head, rest))

    def between(blocks: Column) -> Column:
        ends = F.concat(F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi"))), cuts)
        return F.array_join(F.transform(ends, lambda c, i: piece(blocks, c["hi"], F.coalesce(F.get(cuts, i)["lo"], F.length(text)))), mark)

    # a list of one, so that the blocks are made once
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.get(F.transform(F.array(blocks), between), F.lit(0))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repository: str = "doc_id", owner: str = "source", copied: int = COPIED, spread: int = SPREAD, mark: str = "[secret]") -> DataFrame:
    """`docs` with every live span of the texts replaced by `mark`; same columns, same rows.

    Copied examples stay. Overlapping spans are replaced together. Only rows with candidates are
    joined to their spans, so the other texts are not moved.
    """
    rows = docs.select(whole_row(docs).alias("row"), docs[text].alias("text"))
    any_kind = F.coalesce(reduce(lambda a, b: a | b, [F.col("text").rlike(pattern) for _, pattern, *_ in KINDS]), F.lit(False))
    marked = rows.where(any_kind)
    found = matches(marked.select("row.*"), doc_id, text, repository, owner)
    cuts = _cuts(judged(found, copied, spread).where("live").select("key", "lo", "hi"))
    both = marked.withColumn("key", row_key(f"row.`{doc_id}`", "text")).join(cuts, "key", "left")
    new = F.when(F.col("cuts").isNotNull(), _without(F.col("text"), F.col("cuts"), mark)).otherwise(F.col("text"))
    return rows.where(~any_kind).select("row").union(both.select(F.col("row").withField(f"`{text}`", new))).select("row.*")
