"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import ann, decontaminate, importance, language, licenses, pieces, quality, secrets, simhash, spelling, token_files, topk, toxicity
from eventloom.llm.oracles import importance_sql, licenses_sql, secrets_sql, spelling_sql
from eventloom.llm.storage import bucket_of, shared_folder

END_ID = 2
#: Documents from this score on are rejected as toxic.
TOXIC = 0.7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    found = topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)
    return found.select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    docs = table(spark, sf_dir, "documents")
    path = shared_folder(spark, "tokens")
    token_files.write_token_files(docs, path, definition, END_ID, shards=docs.rdd.getNumPartitions())
    return token_files.read_token_files(spark, path, with_ids=False)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.by_document(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def learnable(modulus: int, held: int):
    """Rows that may be learned from: the crc32 of the id as text is not `held` modulo `modulus`."""

    def holds(doc_id: str) -> Column:
        return ~bucket_of(doc_id, modulus).isin(held, -1)

    return holds


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), learnable(3, 1))
    scored = toxicity.score(docs, model, ["doc_id"])
    return scored.select(F.col("row.doc_id").alias("doc_id"), (bucket_of("row.doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def graded(labels: DataFrame) -> DataFrame:
    """Ratings: 0 of low quality, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratings = graded(table(spark, sf_dir, "labels")).where(learnable(3, 1)("doc_id"))
    out = quality.grade(docs, quality.fit(docs, ratings), ["doc_id"])
    return out.select(F.col("row.doc_id").alias("doc_id"), (bucket_of("row.doc_id", 3) == 1).alias("held_out"), "expected_grade", F.col("tail").alias("score"), (F.col("tail") >= 0.5).cast("int").alias("predicted"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex().alias("fingerprint"), "component_id")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.fit(docs, learnable(4, 2)), ["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"), (bucket_of("row.doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return decontaminate.summary(found).select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def piece_model() -> dict:
    import public_tokenizers

    return pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and what they decode to: n_pieces, a hash of the ids, and whether the text comes back."""
    back = pieces.round_trips(table(spark, sf_dir, "documents"), piece_model())
    return back.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), "n_decoded", "returned")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(ann.clean(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0, k=10)


TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
) SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

DECONTAMINATION_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), t AS (
  SELECT item_id, least(10, len(words)) AS n, unnest(list_transform(range(greatest(len(words) - 9, 1)), lambda i: array_to_string(words[i + 1 : i + 10], ' '))) AS win FROM b WHERE len(words) > 0
), sizes AS (SELECT DISTINCT n FROM t
), g AS (
  SELECT doc_id, n, unnest(range(greatest(len(words) - n + 1, 0))) AS pos, unnest(list_transform(range(greatest(len(words) - n + 1, 0)), lambda i: array_to_string(words[i + 1 : i + n], ' '))) AS win FROM w, sizes
), h AS (SELECT g.doc_id, g.pos, g.n, t.item_id FROM g JOIN t USING (n, win)
), hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM (SELECT DISTINCT doc_id, pos, n FROM h)) GROUP BY doc_id
), its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""

QUERIES = {
    "op1_exact_top_k": op1_exact_top_k,
    "op2_token_files": op2_token_files,
    "op3_licenses": op3_licenses,
    "op4_secrets": op4_secrets,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_language": op8_language,
    "op9_decontamination": op9_decontamination,
    "op10_pieces": op10_pieces,
    "op11_spelling": op11_spelling,
    "op12_importance": op12_importance,
    "op13_nearest": op13_nearest,
}
ORACLES = {
    "op1_exact_top_k": TOP_K_SQL,
    "op3_licenses": licenses_sql(),
    "op4_secrets": secrets_sql(),
    "op9_decontamination": DECONTAMINATION_SQL,
    "op11_spelling": spelling_sql(),
    "op12_importance": importance_sql(),
}
