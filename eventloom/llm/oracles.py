"""DuckDB statements for the scans, written from what they return, not from how Spark computes it."""

from __future__ import annotations

from eventloom.llm.licenses import PHRASES, TEMPLATES, LOWER, UPPER
from eventloom.llm.secrets import COPIED, KINDS, SPREAD, SURE

WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def secrets_sql() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    found = " UNION ALL ".join(
        f"SELECT doc_id, source, t, {i} AS kind, '{name}' AS name, {least} AS least, regexp_extract_all(t, {quoted(p)}) AS own, "
        f"string_split_regex(t, {quoted(p)}) AS gap, regexp_extract_all(t, {quoted(p)}, {group}) AS vals FROM d"
        for i, (name, p, group, least) in enumerate(KINDS)
    )
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
found AS ({found}),
placed AS (
  SELECT doc_id, source, t, kind, name, least, vals[i] AS val, length(own[i]) AS n,
    list_sum(list_transform(gap[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(own[1:i - 1], lambda g: length(g))), 0) AS lo
  FROM (SELECT *, unnest(range(1, len(own) + 1)) AS i FROM found)
),
spans AS (
  SELECT doc_id, source, t, kind, val, lo, name || ':' || lo || ':' || (lo + n) AS span FROM placed
  WHERE length(val) >= least AND (kind < {SURE} OR (regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]')))
),
texts AS (SELECT val, t, min(struct_pack(repository := CAST(doc_id AS VARCHAR), owner := source)) AS f FROM spans GROUP BY val, t),
counted AS (SELECT val, count(DISTINCT f) AS n_repositories, count(DISTINCT f.owner) AS n_owners FROM texts GROUP BY val),
owners AS (SELECT *, NOT (n_owners >= {COPIED} OR (n_owners > 1 AND n_repositories >= {SPREAD})) AS live FROM counted),
kept AS (SELECT doc_id, kind, lo, span, live, n_repositories, n_owners FROM spans JOIN owners USING (val) WHERE kind < {SURE} OR live),
summed AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(span, ',' ORDER BY lo, kind) FILTER (kind < {SURE}) AS base, string_agg(span, ',' ORDER BY lo, kind) FILTER (kind < {SURE} OR live) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied, max(n_repositories) AS n_repositories, max(n_owners) AS n_owners
  FROM kept GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied, coalesce(n_repositories, 0) AS n_repositories, coalesce(n_owners, 0) AS n_owners
FROM d LEFT JOIN summed USING (doc_id)"""


def licenses_sql(k: int = 3, slack: int = 3, least: float = 0.6) -> str:
    listed = [(label, text, False) for label, text in TEMPLATES] + [(label, text, True) for text, label in PHRASES.items()]
    values = ", ".join(f"({n}, '{label}', {base}, string_split('{text}', ' '))" for n, (label, text, base) in enumerate(listed))
    return rf"""
WITH tpl(template, label, base, ws) AS (VALUES {values}),
runs AS (
  SELECT template, label, base, least({k}, len(ws)) AS size, unnest(range(greatest(len(ws) - {k} + 1, 1))) AS start,
    greatest(len(ws) - {k} + 1, 1) AS places, unnest(list_transform(range(greatest(len(ws) - {k} + 1, 1)), lambda i: array_to_string(ws[i + 1:i + {k}], ' '))) AS run
  FROM tpl
),
w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
g AS (
  SELECT doc_id, size, unnest(range(greatest(len(ws) - size + 1, 0))) AS place,
    unnest(list_transform(range(greatest(len(ws) - size + 1, 0)), lambda i: array_to_string(ws[i + 1:i + size], ' '))) AS run
  FROM w, (SELECT DISTINCT size FROM runs)
),
hits AS (SELECT doc_id, template, label, base, size, places, start, place, place - start AS diagonal FROM g JOIN runs USING (size, run)),
full_phrases AS (
  SELECT doc_id, label, TRUE AS base, diagonal AS first, 1.0::DOUBLE AS score FROM hits WHERE base
  GROUP BY doc_id, template, label, places, diagonal HAVING count(DISTINCT start) = places
),
lines AS (SELECT DISTINCT doc_id, template, diagonal FROM hits WHERE NOT base),
begun AS (SELECT *, coalesce(diagonal - lag(diagonal) OVER near > {slack}, TRUE) AS new FROM lines WINDOW near AS (PARTITION BY doc_id, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(new::INTEGER) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM begun),
passages AS (
  SELECT doc_id, label, FALSE AS base, min(place) AS first, count(DISTINCT start) / places AS score FROM hits JOIN numbered USING (doc_id, template, diagonal)
  GROUP BY doc_id, template, label, places, span HAVING count(DISTINCT start) / places >= {least}
),
every AS (SELECT * FROM full_phrases UNION ALL SELECT * FROM passages),
summed AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
    array_to_string(list_sort(list(DISTINCT label) FILTER (base)), ',') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(score) AS score
  FROM every GROUP BY doc_id
)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM w LEFT JOIN summed USING (doc_id)"""


#: crc32 of a text column's UTF-8, and the table it reads, made from the polynomial.
CRC_TABLE = """steps(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
),
crc AS (SELECT list(c ORDER BY i) AS tab FROM steps WHERE k = 8)"""


def crc_sql(of: str) -> str:
    byte = f"CAST('0x' || substr(hex(encode({of})), 2 * i + 1, 2) AS BIGINT)"
    return f"xor(list_reduce([4294967295] || list_transform(range(length(hex(encode({of}))) // 2), lambda i: {byte}), lambda c, b: xor(c >> 8, tab[xor(c, b) % 256 + 1])), 4294967295)"


def spelling_sql() -> str:
    return rf"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')), '{UPPER}', '{LOWER}') AS run FROM documents
  ) WHERE length(run) >= 7 GROUP BY doc_id, run
),
hashed AS (SELECT run, n, {crc_sql("concat(doc_id, ':', run)")} AS h FROM runs, crc),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
  ) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
),
cut AS (SELECT word, n, i, substr(word, 1, i) || '*' || substr(word, i + 2) AS hole, substr(word, 1, i) || substr(word, i + 2) AS less FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT x.word AS a, x.n AS na, y.word AS b, y.n AS nb FROM cut x JOIN cut y ON x.hole = y.hole AND x.i = y.i AND x.word <> y.word
  UNION SELECT x.word, x.n, y.word, y.n FROM words x JOIN cut y ON x.word = y.less
  UNION SELECT y.word, y.n, x.word, x.n FROM words x JOIN cut y ON x.word = y.less
),
best AS (SELECT a, na, b, nb, row_number() OVER (PARTITION BY a ORDER BY nb DESC, b) AS r, count(*) OVER (PARTITION BY a) AS n_near FROM near),
formed AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN nb >= 10 * n THEN b END AS form, CASE WHEN nb >= 10 * n THEN nb END AS form_n FROM words w LEFT JOIN best ON a = w.word AND r = 1),
walk(word, root) AS (SELECT word, word FROM formed UNION ALL SELECT walk.word, form FROM walk JOIN formed ON formed.word = walk.root WHERE form IS NOT NULL)
SELECT f.word, n, n_near, form, form_n, root FROM formed f JOIN walk USING (word) WHERE root NOT IN (SELECT word FROM formed WHERE form IS NOT NULL)"""


def importance_sql() -> str:
    return rf"""
WITH RECURSIVE {CRC_TABLE},
d AS (SELECT doc_id, {WORDS} AS ws FROM documents),
b AS (SELECT {WORDS} AS ws FROM benchmark),
every AS (SELECT DISTINCT unnest(ws) AS w FROM d UNION SELECT DISTINCT unnest(ws) FROM b),
placed AS (SELECT w, {crc_sql("w")} % 10000 AS bucket FROM every, crc),
s AS (SELECT bucket, count(*) AS s FROM (SELECT unnest(ws) AS w FROM d) JOIN placed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(ws) AS w FROM b) JOIN placed USING (w) GROUP BY bucket),
totals AS (SELECT (SELECT coalesce(sum(len(ws)), 0) FROM d) AS ss, (SELECT coalesce(sum(len(ws)), 0) FROM b) AS tt),
gains AS (
  SELECT w, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (ss + 10000) AS DOUBLE) / CAST((coalesce(s, 0) + 1) * (tt + 10000) AS DOUBLE))) AS BIGINT) AS gain
  FROM placed LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), totals
),
summed AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM (SELECT doc_id, unnest(ws) AS w FROM d) JOIN gains USING (w) GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256(concat('2024:', doc_id)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN summed USING (doc_id)
),
in_order AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) FILTER (n_features >= 20) OVER () AS large FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= large * 10 // 100 THEN place END AS rank FROM in_order"""
