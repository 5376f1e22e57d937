"""The registered queries over whole tables: oracles, held-out accuracy, and the pipeline stage by stage."""

import zlib

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from eventloom.llm import queries
from tests.llm.test_operators import brute_components, brute_items, brute_print, brute_secrets
from tests.oracle_check import compare, connect

MIDDLE = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    with connect(sf_dir) as con:
        assert compare(spark, con, sf_dir, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_every_operator_is_registered_and_returns_every_document(spark, sf_dir):
    names = [n for n in entry.queries() if n.startswith("op")]
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14))
    n = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in ("op3_licenses", "op4_secrets", "op6_quality", "op10_pieces", "op12_importance"):
        assert entry.queries()[name](spark, sf_dir).count() == n
    assert entry.queries()["op10_pieces"](spark, sf_dir).where("NOT returned").count() == 0


def rows(sql):
    return duckdb.connect().sql(sql).fetchall()


def test_toxicity_held_out(spark):
    got = {r.doc_id: r for r in queries.op5_toxicity(spark, MIDDLE).collect()}
    toxic = dict(rows(f"SELECT doc_id, toxic FROM '{MIDDLE}/labels.parquet'"))
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(r.predicted, toxic[i]) for i, r in got.items() if r.held_out and i in toxic]
    assert sum(t for p, t in held if p) / sum(p for p, _ in held) > 0.9
    assert sum(p for p, t in held if t) / sum(t for _, t in held) > 0.6


def test_quality_held_out(spark):
    got = {r.doc_id: r for r in queries.op6_quality(spark, MIDDLE).collect()}
    good = dict(rows(f"SELECT doc_id, quality FROM '{MIDDLE}/labels.parquet'"))
    held = [(r.predicted, good[i]) for i, r in got.items() if r.held_out and i in good]
    assert sum(p == t for p, t in held) / len(held) > 0.93


def test_language_held_out(spark):
    got = {r.doc_id: r for r in queries.op8_language(spark, MIDDLE).collect()}
    lang = dict(rows(f"SELECT doc_id, lang FROM '{MIDDLE}/documents.parquet'"))
    held = [r.lang_pred == lang[i] for i, r in got.items() if r.held_out]
    assert sum(held) / len(held) > 0.95


def test_pipeline(spark, sf_dir):
    """Each stage against brute force over all that its predecessor kept."""
    docs = queries.table(spark, sf_dir, "documents")
    text = lambda df: {r.doc_id: r.text for r in df.collect()}
    stages = dict(pipeline.STAGES)
    toxic_free = stages["toxicity"](spark, docs, sf_dir)
    scored = {r.doc_id: r.score for r in queries.op5_toxicity(spark, sf_dir).collect()}
    kept = text(toxic_free)
    assert toxic_free.columns == docs.columns and set(kept) == {i for i, s in scored.items() if s < queries.TOXIC}
    unique = text(stages["near copies"](spark, toxic_free, sf_dir))
    assert set(unique) == set(brute_components({i: brute_print(t) for i, t in kept.items()}).values())
    source = spark.createDataFrame([(i, t, "en", f"s{i % 7}", len(t)) for i, t in unique.items()], docs.schema)
    items = rows(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'")
    clean = stages["decontamination"](spark, source, sf_dir)
    left = {r.doc_id: r for r in clean.collect()}
    for i, t in unique.items():
        n, hit, _ = brute_items(t, items, 10)
        assert (i in left) == (hit <= 0.5 * n), i
        if i in left:
            assert left[i].n_chars == len(left[i].text) and (left[i].text == t) == (hit == 0)
            assert hit == 0 or brute_items(left[i].text, items, 10)[1] < hit
    hidden = text(stages["secrets"](spark, clean, sf_dir))
    assert set(hidden) == set(left)
    for i, r in left.items():
        found = sum(brute_secrets(r.text)[0].values())
        assert found or hidden[i] == r.text
    last = stages["pieces"](spark, clean, sf_dir)
    assert last.count() == len(left) and last.where("NOT returned").count() == 0


def test_pipeline_runs(spark, sf_dir):
    out = pipeline.run(spark, sf_dir)
    assert 0 < out.count() < spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert out.where("NOT returned").count() == 0
