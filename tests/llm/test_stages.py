"""What stages of the pipeline owe beyond their operators' own tests."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from eventloom.llm import decontaminate, queries, secrets, simhash, toxicity
from eventloom.llm.storage import row_key
from tests.llm.test_operators import brute_items, docs


@pytest.mark.parametrize("part_words", [4, 12, 100_000])
def test_cuts_leave_no_item(spark, part_words):
    """A passage of one item interrupted by another's, three deep."""
    own = [[f"{c}{i}" for i in range(12)] for c in "abc"]
    items = [(n, " ".join(words)) for n, words in enumerate(own)]
    a, b, c = own
    clean = " ".join(f"x{i}" for i in range(60))
    nested = " ".join([*a[:6], *b[:5], *c, *b[5:], *a[6:]])
    rows = [(1, f"{clean} {nested} end"), (2, f"{clean} {' '.join(a[:6])}"), (3, None)]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: r.text for r in decontaminate.decontaminate(docs(spark, *rows), table, part_words=part_words).collect()}
    assert got == {1: f"{clean}  end", 2: rows[1][1], 3: None}
    assert all(brute_items(t, items, 10)[1] == 0 for t in got.values())


def test_stage_leaves_no_hit(spark, sf_dir):
    table = queries.table(spark, sf_dir, "documents")
    left = dict(pipeline.STAGES)["decontamination"](spark, table, sf_dir)
    again = decontaminate.summary(decontaminate.find_items(left, queries.table(spark, sf_dir, "benchmark"), ["doc_id"]))
    assert left.count() > 0 and again.where("contaminated").count() == 0


@pytest.mark.parametrize("prior", [0.5, 0.6, 0.8])
def test_mostly_toxic(prior):
    rng = np.random.default_rng(11)

    def row(toxic):
        words = set(rng.integers(0, 3000, 60).tolist())
        return np.array(sorted(words | (set((5000 + rng.integers(0, 4, 6)).tolist()) if toxic else set())))

    positive = [row(True) for _ in range(400)]
    mixed = [row(rng.random() < prior) for _ in range(1200)]
    features, w, bias = toxicity.fit_rows(positive, mixed, prior)
    weights = dict(zip(features.tolist(), w))
    score = lambda r: toxicity.sigmoid(bias + sum(weights.get(x, 0) for x in r.tolist()))
    assert np.mean([score(row(True)) >= queries.TOXIC for _ in range(200)]) > 0.9
    assert np.mean([score(row(False)) < queries.TOXIC for _ in range(200)]) > 0.9


def test_stages_keep_every_column(spark, sf_dir):
    table = queries.table(spark, sf_dir, "documents").withColumn("more", F.col("doc_id") * 2)
    shape = table.dtypes
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, table, sf_dir)
        assert out.dtypes == shape, name
        assert out.where("more = doc_id * 2").count() == out.count() > 0


CLASHING = "doc_id long, text string, source string, row int, key int, cuts int, `__key` int, `__live` int, `__spans` int, `a.b` int"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, s, *range(7)) for i, t, s in rows], CLASHING)


def test_one_of_each_keeps_columns_of_any_name(spark):
    table = clashing(spark, [(3, "a b c", "s"), (1, "a b c", "s"), (1, "a b c", "s"), (2, None, "s"), (None, "x y", "s")])
    kept = simhash.one_of_each(table)
    assert kept.columns == table.columns
    assert sorted(((r.doc_id, r["__key"], r["a.b"]) for r in kept.collect()), key=str) == [(1, 3, 6), (2, 3, 6), (None, 3, 6)]


@pytest.mark.parametrize("block", [16, 4096])
def test_redacted_texts(spark, monkeypatch, block):
    """Spans of every kind, alone, side by side and overlapping, in texts of many blocks and of all kinds of characters."""
    monkeypatch.setattr(secrets, "BLOCK", block)
    rng = np.random.default_rng(3)
    parts = ["é😀 ", "plain words ", "\n", "password: 'abc{0}def' ", "AKIA{0}ABCDEFGHIJKLMNOP{0} ", "deadbeef{0}deadbeefdeadbeefdeadbeef ", "token={1:032x}", "token=AKIA{0}ABCDEFGHIJKLMNOPQ", "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5p6{0}"]
    texts = ["".join(parts[j].format(n, n * 7919 + i) for i, j in enumerate(rng.integers(0, len(parts), 40))) for n in range(60)]
    texts += ["", "😀" * 5000 + "secret=abcdef" + "é" * 5000]
    rows = [(i, t, f"s{i}") for i, t in enumerate(texts)] + [(900, None, "s")]
    table = clashing(spark, rows)
    out = secrets.redact(table)
    assert out.columns == table.columns
    got = {r.doc_id: r for r in out.collect()}
    assert all((r["__key"], r["__live"], r["a.b"]) == (3, 4, 6) for r in got.values()) and got[900].text is None
    live = {}
    for r in secrets.judged(secrets.matches(table.withColumn("id", F.lit(1)), "doc_id", "text", "doc_id", "source")).where("live").join(
        table.select("doc_id", row_key("doc_id", "text").alias("key")), "key"
    ).collect():
        live.setdefault(r.doc_id, []).append((r.lo, r.hi))
    changed = 0
    for i, t, _ in rows[:-1]:
        out, at = [], 0
        for lo, hi in sorted(live.get(i, [])):
            if lo >= at:
                out += [t[at:lo], "[secret]"]
            at = max(at, hi)
        assert got[i].text == "".join([*out, t[at:]]), i
        changed += got[i].text != t
    assert changed > 50


def test_ownership_of_secrets(spark):
    """Many owners, or two in many repositories, make an example; one owner never does; a shared text counts once."""
    def rows(value, n, owners, text="{0} password={1}"):
        return [(1000 * len(value) + i, text.format(i, value), f"{value}{i % owners}") for i in range(n)]

    table = docs(spark, *rows("aaaaaa", 50, 1), *rows("bbbbbbb", 2, 2), *rows("cccccccc", 30, 2), *rows("ddddddddd", 3, 3), *rows("eeeeeeeeee", 9, 9, "same password={1}"))
    got = {r.doc_id // 1000: r for r in secrets.find_secrets(table).collect()}
    assert {k: (r.n_live, r.n_copied, r.n_repositories, r.n_owners) for k, r in got.items()} == {
        6: (1, 0, 50, 1), 7: (1, 0, 2, 2), 8: (0, 1, 30, 2), 9: (0, 1, 3, 3), 10: (1, 0, 1, 1)
    }


def test_time_of_many_secrets(spark):
    """A text with four times the matches takes no more than some eight times as long: no part is quadratic."""
    times = []
    for n in (10_000, 40_000):
        table = docs(spark, (1, " ".join(f"{i:032x}" for i in range(n)), "s")).select("doc_id", "text", "source")
        start = time.time()
        assert secrets.redact(table).first().text == " ".join(["[secret]"] * n)
        times.append(time.time() - start)
    assert times[1] < 8 * times[0] + 5, times


def test_passes_over_many_automata(spark, sf_dir):
    """Small parts in groups of one and two find and cut what one automaton does, over the given tables."""
    table, items = queries.table(spark, sf_dir, "documents"), queries.table(spark, sf_dir, "benchmark")
    table = table.unionByName(table.where("doc_id < 3"))
    found = lambda **how: sorted(map(str, decontaminate.summary(decontaminate.find_items(table, items, ["doc_id"], **how)).collect()))
    cut = lambda **how: sorted(map(str, decontaminate.decontaminate(table, items, **how).collect()))
    built = decontaminate.automata(items, part_words=300)
    assert built.count() > 4
    assert found(part_words=300, group=4) == found() and cut(part_words=300, group=4) == cut()
    assert decontaminate.decontaminate(table, items, part_words=300, group=4).dtypes == table.dtypes
