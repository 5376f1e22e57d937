"""Bounded samples: hot groups, repeated ids, bytes; and languages beyond one broadcast."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from eventloom.llm import language, queries, samples
from tests.llm.test_operators import docs


def test_first_of_each_group(spark):
    """The same choice as one sort of each group would make, without a task that holds a whole group."""
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("lang"))
    got = samples.first_of_each(rows, "lang", 50, parts=16)
    order = rows.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(7)).alias("h")).orderBy("h", "doc_id").collect()
    want = {r.doc_id for lang in ("hot", "rare") for r in [x for x in order if x.lang == lang][:50]}
    assert {r.doc_id for r in got.collect()} == want and got.columns == rows.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    first = plan.index("Window [", plan.index("Window [") + 1)  # the inner window is printed last
    assert "__part" in plan[first : first + 400]


def test_one_row_of_an_id(spark):
    table = docs(spark, *[(1, f"text {i % 3}") for i in range(200)], *[(2, "same")] * 200, (3, None), (3, "not null"), (4, None))
    chosen = spark.createDataFrame([(i, k) for i in (1, 2, 3, 4, 9) for k in (0, 1)], "doc_id long, kind int")
    got = samples.with_texts(table, chosen, "doc_id", "text").collect()
    assert Counter(r.doc_id for r in got) == {1: 2, 2: 2, 3: 2, 4: 2}
    assert {bytes(r.text) for r in got if r.doc_id == 3} == {b"not null"} and len({r.text for r in got if r.doc_id == 1}) == 1


def test_a_sample_has_a_bound_in_size(spark):
    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.when(F.col("id") == 77, 1_000_000).otherwise(F.col("id") % 7).alias("n"))
    got = samples.within(rows, F.col("n"), 300).collect()
    assert 50 < len(got) < 500 and sum(r.n for r in got) <= 300
    assert samples.within(rows, F.col("n"), 10**9).count() == 500


def test_more_languages_than_are_compared_together(spark):
    rng = np.random.default_rng(2)
    letters = [chr(0x4E00 + i) for i in range(60)]
    rows = [(i, "".join(rng.choice(letters[(i % 7) * 8 : (i % 7) * 8 + 12], 80)), f"l{i % 7}") for i in range(210)]
    table = spark.createDataFrame([*rows, (900, None, "l0"), (901, "12 3", "l1")], "doc_id long, text string, lang string")
    profiles = language.fit(table, queries.learnable(4, 2))
    assert list(profiles) == [f"l{i}" for i in range(7)]
    run = lambda n: sorted(tuple(r) for r in language.identify(table, profiles, ["doc_id"], together=n).select("row.doc_id", "lang_pred", "score").collect())
    assert run(3) == run(1) == run(7)
    assert {i: name for i, name, _ in run(3)} | {900: "und", 901: "und"} == {**{i: n for i, _, n in rows}, 900: "und", 901: "und"}
