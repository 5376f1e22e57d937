"""Spelling variant grouping with pivotal grams.

A word's bigrams are ordered from rare to common over the vocabulary. Its prefix are the first three
in this order, with all that tie with the third: one edit touches two bigrams at most. Among any
three are two disjoint ones, and one edit touches only one of them: the pivots, the disjoint pair of
the smallest total frequency, found by dynamic programming. Of two words one edit apart, the one whose
prefix ends earlier has its surviving pivots in the other's prefix.

So pivots are joined with prefixes, and what meets is verified by edit distance. The edit is behind the
first pivot's bigram, or else before the second one's. In either case the place of the pivot in the
other word is known, and so is the half of the longer stretch beside it that the edit leaves alone: the
join asks for the pivot at its place with all text that is known to be shared, for the edit in either
half. It finds every pair, and meets few others.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.storage import stored

LETTERS = "A-Za-zÀ-ÿ"
#: Edits, and the bigrams of a prefix: one edit touches two.
EDITS, GRAM = 1, 2
PREFIX = GRAM * EDITS + 1
#: Of the hash of a run of code points. A collision is one more pair to compare.
BASE, PRIME, POWERS = 1_099_511_628_211, (1 << 61) - 1, [1]
#: Code points of a word that its keys carry.
INLINE = 64
#: Distinct words whose counts a task holds before it hands them on.
HELD = 200_000


def words_of(doc_id, text: str | None, least: int, modulus: int) -> Counter:
    """Words of a text, as UTF-8, and how often each occurs.

    Runs of letters with A-Z lower-cased. Where `modulus` divides the crc32 of `<doc_id>:<run>`, the
    run loses its code point at crc32 modulo its length. Words shorter than `least` are left out.
    """
    out: Counter = Counter()
    head = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
    for run, n in Counter(re.findall(f"[{LETTERS}]{{{least},}}", text or "")).items():
        word = run.encode().lower()  # of bytes, A-Z alone
        h = zlib.crc32(word, head)
        if modulus and h % modulus == 0:
            if len(run) == least:
                continue
            letters = word.decode()
            at = h % len(letters)
            word = (letters[:at] + letters[at + 1 :]).encode()
        out[word] += n
    return out


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 7, occurring: int = 2, modulus: int = 31) -> DataFrame:
    """(word, n): words of at least `least` code points that occur `occurring` times or more in all texts together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])

        for batch in batches:
            for name, own in zip(batch.column(0).to_pylist(), batch.column(1)):
                held.update(words_of(name, own.as_py(), least, modulus))
                if len(held) > HELD:
                    yield counted()
                    held = Counter()
        yield counted()

    parts = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurring)


def pivots(places: Sequence[int], weights: Sequence[int], wanted: int = EDITS + 1, apart: int = GRAM) -> tuple[int, ...]:
    """`wanted` of the ascending `places`, `apart` or more from each other, of the smallest total weight.

    best[t] of the first i places is the cheaper of leaving out place i and of taking it behind the
    best t - 1 places that end far enough before it.
    """
    none = (float("inf"), ())
    rows: list[list[tuple[float, tuple[int, ...]]]] = [[(0, ())] + [none] * wanted]
    far = 0
    for i, (place, weight) in enumerate(zip(places, weights)):
        while places[far] <= place - apart:
            far += 1
        row = list(rows[i])
        for t in range(1, wanted + 1):
            cost, before = rows[far][t - 1]
            row[t] = min(row[t], (cost + weight, (*before, place)))
        rows.append(row)
    return rows[-1][wanted][1]


def signature(word: str, order: dict[str, tuple[int, int]]) -> tuple[int, list[tuple[int, int]], list[tuple[int, int]]]:
    """Rank of the last prefix bigram, the prefix and the pivots as (rank, place).

    order: rank and frequency of each bigram. The word has PREFIX bigrams at least.
    """
    grams = [order[word[i : i + GRAM]] for i in range(len(word) - GRAM + 1)]
    last = sorted(rank for rank, _ in grams)[PREFIX - 1]
    prefix = [i for i, (rank, _) in enumerate(grams) if rank <= last]
    chosen = pivots(prefix, [grams[i][1] for i in prefix])
    return last, [(grams[i][0], i) for i in prefix], [(grams[i][0], i) for i in chosen]


class Parts:
    """Hashes of the runs of a word's code points, each from two prefix hashes."""

    def __init__(self, word: str):
        self.size = len(word)
        self.upto = [0]
        for c in map(ord, word):
            self.upto.append((self.upto[-1] * BASE + c + 1) % PRIME)
        while len(POWERS) <= self.size:
            POWERS.append(POWERS[-1] * BASE % PRIME)

    def key(self, way: int, size: int, *runs: tuple[int, int]) -> int:
        """A number for a way of sharing text, the other word's size and the shared runs [lo, hi)."""
        h = way * 1_000_003 + size
        for lo, hi in runs:
            h = (h * BASE + (self.upto[hi] - self.upto[lo] * POWERS[hi - lo]) % PRIME + 7) * BASE % PRIME
        return h


def offered(parts: Parts, places: Sequence[int]) -> set[int]:
    """Keys of prefix bigrams at `places`: what a word with that pivot shares with this one if the edit is in the first or
    second half of what stands behind it, or in the first or second half of what stands before it."""
    n, out = parts.size, set()
    for q in places:
        behind, before = q + GRAM + (n - q - GRAM) // 2, q // 2
        out |= {parts.key(0, n, (0, q + GRAM), (behind, n)), parts.key(1, n, (0, behind)), parts.key(2, n, (before, n)), parts.key(3, n, (0, before), (q, n))}
    return out


def asked(parts: Parts, first: int, second: int) -> set[int]:
    """Keys of the pivots at two places, for words one shorter, as long, and one longer: an edit behind the first one's
    bigram, in either half, or before the second one, in either half."""
    n, out = parts.size, set()
    for more in (-1, 0, 1):
        m = n + more
        behind, before = first + GRAM + (m - first - GRAM) // 2, (second + more) // 2
        out |= {parts.key(0, m, (0, first + GRAM), (behind - more, n)), parts.key(1, m, (0, behind)), parts.key(2, m, (before - more, n)), parts.key(3, m, (0, before), (second, n))}
    return out


def signatures(words: DataFrame) -> DataFrame:
    """words(id, word, n) with last, offered and asked; `word` is null where it has more than INLINE code points.

    The bigrams' order is broadcast: LETTERS has 90 after lower-casing, so there are 8,100 at most.
    """
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - GRAM + 1), lambda i: F.col("word").substr(i, F.lit(GRAM)))
    counted = words.select(F.explode(pairs).alias("gram")).groupBy("gram").count().collect()
    order = {r[0]: (i, r[1]) for i, r in enumerate(sorted(counted, key=lambda r: (r[1], r[0])))}
    shared = words.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                some = batch.slice(lo, 1000)
                own, last, keys = some.column(1).to_pylist(), [], ([], [])
                for w in own:
                    rank, prefix, chosen = signature(w, known)
                    parts = Parts(w)
                    last.append(rank)
                    keys[0].append(list(offered(parts, [p for _, p in prefix])))
                    keys[1].append(list(asked(parts, chosen[0][1], chosen[1][1])))
                short = pa.array([w if len(w) <= INLINE else None for w in own], pa.string())
                yield pa.RecordBatch.from_arrays([some.column(0), short, some.column(2), pa.array(last, pa.int32()), *(pa.array(k, pa.list_(pa.int64())) for k in keys)], names=["id", "word", "n", "last", "offered", "asked"])

    return words.select("id", "word", "n").mapInArrow(run, "id long, word string, n long, last int, offered array<long>, asked array<long>")


def near_words(words: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b), both ways round, for all pairs of `words(word, n)` exactly one edit apart.

    Words are distinct and have PREFIX bigrams or more. Keys carry short words, which are compared
    where they meet; pairs of long ones are compared when their texts have been joined.
    """
    words = stored(words.withColumn("id", F.monotonically_increasing_id()), "numbered")
    signed = stored(signatures(words), "signatures")
    side = lambda keys, x: signed.select(F.explode(keys).alias("key"), *[F.col(c).alias(f"{c}_{x}") for c in ("id", "word", "n", "last")])
    met = side("asked", "a").join(side("offered", "b"), "key").where((F.col("last_a") <= F.col("last_b")) & (F.col("id_a") != F.col("id_b")))
    apart = F.levenshtein("word_a", "word_b", EDITS)
    met = stored(met.where(F.coalesce(apart == 1, F.lit(True))).select("id_a", "id_b", apart.isNull().alias("open")).distinct(), "met")
    text = lambda x: words.select(F.col("id").alias(f"id_{x}"), F.col("word").alias(x), F.col("n").alias(f"n_{x}"))
    near = met.join(text("a"), "id_a").join(text("b"), "id_b").where(~F.col("open") | (F.levenshtein("a", "b", EDITS) == 1)).select("a", "b", "n_a", "n_b")
    return near.union(near.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n_b").alias("n_a"), F.col("n_a").alias("n_b"))).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form: a step's form has more occurrences, so paths end.

    Each round doubles the steps taken.
    """
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = stored(at.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def grouped(words: DataFrame, factor: int = 10) -> DataFrame:
    """word, n, n_near, form, form_n and root for every row of `words(word, n)`.

    form: the near word with the most occurrences, if they are `factor` times the word's own or more
    (factor above 1); ties go to the smaller word in code-point order. root: what the forms lead to,
    the word itself where it has none. No words give no rows.
    """
    words = stored(words, "words")
    best = F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("word"))).alias("best")
    near = near_words(words).groupBy("a", "n_a").agg(F.count("*").alias("n_near"), best)
    much = -F.col("best.less") >= factor * F.col("n_a")
    near = near.select(F.col("a").alias("word"), "n_near", F.when(much, F.col("best.word")).alias("form"), F.when(much, -F.col("best.less")).alias("form_n"))
    near = stored(near, "near")
    every = words.join(near, "word", "left").join(_roots(near.where("form IS NOT NULL")), "word", "left")
    return every.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 7, occurring: int = 2, modulus: int = 31, factor: int = 10) -> DataFrame:
    """`grouped` over the vocabulary of all texts.

    Null and empty texts have no words; a null id is an empty text in the deletion's hash. Repeated
    rows count as often as they occur. Other columns of `docs` are not looked at.
    """
    if least < PREFIX + GRAM - 1:
        raise ValueError(f"words need {PREFIX + GRAM - 1} code points or more")
    return grouped(vocabulary(docs, doc_id, text, least, occurring, modulus), factor)
