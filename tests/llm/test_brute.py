"""Registered queries that SQL cannot express, against plain re-implementations over a whole small table."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import pieces, quality, queries, toxicity
from eventloom.llm.words import words_of
from tests.llm.test_operators import brute_components, brute_print, docs

public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def texts(spark, sf_dir):
    return {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()}


def test_token_files_query(spark, sf_dir, texts):
    from tokenizers import Tokenizer

    plain, start, want = Tokenizer.from_file(public.path("word_bpe_49k.json")), 0, set()
    for i in sorted(texts):
        ids = [*plain.encode(texts[i] or "", add_special_tokens=False).ids, 2]
        want.add((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert {tuple(r) for r in queries.op2_token_files(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()} == want


def test_simhash_query(spark, sf_dir, texts):
    prints = {i: brute_print(t) for i, t in texts.items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash(spark, sf_dir).collect()}
    assert got == {i: (f"{prints[i] & (2**64 - 1):016x}", c) for i, c in brute_components(prints).items()}


# ---- 10 pieces


def brute_pieces(text, model):
    """Best segmentation of a whole marked text, one position after the other; of equal scores the longer last piece."""
    known, longest = model["pieces"], max(map(len, model["pieces"]))
    unknown = min(s for _, s in known.values()) - 10
    best, back = [0.0], [None]
    for p in range(1, len(text) + 1):
        options = [(best[p - n] + known[text[p - n : p]][1], n) for n in range(1, min(p, longest) + 1) if text[p - n : p] in known]
        if text[p - 1] not in known:
            options.append((best[p - 1] + unknown, 0))
        score, n = max(options)
        best.append(score)
        back.append(n)
    out, p = [], len(text)
    while p:
        n = back[p]
        out += [known[text[p - n : p]][0]] if n else [model["bytes"][b] for b in reversed(text[p - 1].encode())]
        p -= n or 1
    return out[::-1]


def marked(text, model):
    """A text as the model sees it: a blank in front and marks for blanks; marks of its own are bytes, and cut it."""
    mark = [model["bytes"][b] for b in pieces.MARK.encode()]
    out = []
    for k, part in enumerate(text.split(pieces.MARK)):
        out += (mark if k else []) + brute_pieces((pieces.MARK * (not k) + part).replace(" ", pieces.MARK), model)
    return out


def test_pieces_query(spark, sf_dir, texts):
    model = queries.piece_model()
    want = [(i, marked(t, model) if t else [] if t == "" else None) for i, t in texts.items()]
    table = spark.createDataFrame(want, "doc_id long, ids array<int>").select("doc_id", F.size("ids").cast("long").alias("n"), F.xxhash64("ids").alias("h"))
    got = queries.op10_pieces(spark, sf_dir).collect()
    assert {(r.doc_id, r.n_pieces, r.ids_hash) for r in got} == {tuple(r) for r in table.collect()} and all(r.returned for r in got)


def test_segment_equals_brute_force():
    model = queries.piece_model()
    rng = np.random.default_rng(5)
    alphabet = [*"abcdefgilnorst", "é", "ß", "😀", "\x00", "ion", "the", pieces.MARK + "un"]
    chunks = ["".join(rng.choice(alphabet, rng.integers(1, 16))) for _ in range(1500)]
    encoder = pieces.Encoder(model)
    want = [brute_pieces(c, model) for c in chunks]
    assert encoder.segment(chunks) == want and [encoder.viterbi(c) for c in chunks] == want
    decoder, ids = pieces.Decoder(model["written"]), [*want, [], [model["bytes"][0xC3]], [model["bytes"][0xFF]] * 3]
    ends = np.cumsum([len(i) for i in ids])
    assert decoder.decode_many(np.concatenate([np.array(i, np.int32) for i in ids]), ends) == [pieces.decode_ids(i, model["written"]) for i in ids]


# ---- classifiers


def test_language_query(spark, sf_dir):
    """Rank-order profiles with plain counters over the whole table."""
    rows = queries.table(spark, sf_dir, "documents").select("doc_id", "text", "lang").collect()

    def grams(text):
        out = Counter()
        for word in "".join(c if c.isalpha() else " " for c in (text or "").lower()).split():
            w = f" {word} "
            out.update(word)
            out.update(w[i : i + n] for n in (2, 3) for i in range(len(w) - n + 1))
        # a word's last blank is the next one's first: pairs across it are letters, a blank, letters
        words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
        out.update(a[-1] + " " + b[0] for a, b in zip(words, words[1:]))
        return out

    def key(g):
        return [ord(c) for c in g]

    def number(g):
        n = 0
        for c in g:
            n = n << 21 | ord(c)
        return n

    def top(counts):
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], number(x[0])))[:400]]

    learned = {}
    for r in rows:
        if r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            learned.setdefault(r.lang, Counter()).update(grams(r.text))
    profiles = {lang: {g: i for i, g in enumerate(top(c))} for lang, c in sorted(learned.items())}
    want = {}
    for r in rows:
        own = top(grams(r.text))
        near = {lang: sum(400 - (abs(p[g] - i) if g in p else 400) for i, g in enumerate(own)) for lang, p in profiles.items()}
        best = max(near.values(), default=0)
        want[r.doc_id] = (next(n for n, v in near.items() if v == best), best / sum(near.values())) if own else ("und", 0.0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in queries.op8_language(spark, sf_dir).collect()}
    assert {i: n for i, (n, _) in got.items()} == {i: n for i, (n, _) in want.items()}
    assert all(abs(got[i][1] - s) < 1e-12 for i, (_, s) in want.items())


def adam(gradient, w, steps, rate, fix=lambda w: w):
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = fix(w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8))
    return w


def sigmoid(x):
    return 1 / (1 + np.exp(-x))


def test_toxicity_query(spark, sf_dir, texts):
    """The non-negative risk with dense matrices and words as text, over the same documents."""
    labels = {r.doc_id: r.toxic for r in queries.table(spark, sf_dir, "labels").collect() if r.toxic is not None}
    free = [i for i in texts if zlib.crc32(str(i).encode()) % 3 != 1]
    known = [i for i in free if i in labels]
    prior = sum(labels[i] == 1 for i in known) / len(known)
    marks = {i: toxicity.marks((t or "").encode()) for i, t in texts.items()}
    positive, mixed = [i for i in known if labels[i] == 1], free
    p, u = (Counter(w for i in ids for w in marks[i]) for ids in (positive, mixed))
    chosen = []
    for w, n in p.items():
        a, b = n / len(positive), (u[w] + 1) / (len(mixed) + 2)
        if n >= 3 and (a - b) / np.sqrt(b * (1 - b) * (1 / len(positive) + 1 / len(mixed))) >= 5 and a / b >= min(2, prior**-0.5):
            chosen.append(w)
    x = lambda ids: np.array([[*(float(w in marks[i]) for w in chosen), 1.0] for i in ids])
    xp, xu = x(positive), x(mixed)

    def gradient(w):
        gp, gu = xp @ w, xu @ w
        risk = np.log1p(np.exp(gu)).mean() - prior * np.log1p(np.exp(gp)).mean()
        plus, minus, neg = -xp.T @ sigmoid(-gp) / len(xp), xp.T @ sigmoid(gp) / len(xp), xu.T @ sigmoid(gu) / len(xu)
        g = prior * (plus - minus) + neg if risk >= 0 else prior * minus - neg
        g[:-1] += 1e-5 * w[:-1]
        return g

    start = np.zeros(len(chosen) + 1)
    start[-1] = np.log(prior / (1 - prior))
    w = adam(gradient, start, 400, 0.1, lambda w: np.append(np.maximum(w[:-1], 0), w[-1]))
    score = dict(zip(texts, sigmoid(x(texts) @ w)))
    got = {r.doc_id: r for r in queries.op5_toxicity(spark, sf_dir).collect()}
    assert len(chosen) > 5 and set(got) == set(texts)
    assert max(abs(got[i].score - s) for i, s in score.items()) < 1e-3
    assert all(got[i].predicted == (s >= 0.7) for i, s in score.items() if abs(s - 0.7) > 1e-3)


def test_quality_is_cumulative_link_regression(spark):
    """Weights and thresholds by a dense re-implementation, over features taken from the operator."""
    rng = np.random.default_rng(3)
    rows, grades = [], []
    for i in range(150):
        g = int(rng.integers(0, 3))
        rows.append((i, " ".join(f"{'abc'[g] if rng.random() < 0.5 else 'd'}{rng.integers(0, 8)}" for _ in range(12))))
        grades.append((i, g))
    table = docs(spark, *rows)
    w, theta = quality.fit(table, spark.createDataFrame(grades, "doc_id long, grade int"))
    found = [quality.features(t.encode(), {}) for _, t in rows]
    used = sorted({int(c) for i, _ in found for c in i})
    x = np.zeros((len(rows), len(used)))
    for n, (index, value) in enumerate(found):
        for c, v in zip(index.tolist(), value.tolist()):
            x[n, used.index(c)] += v
    y = np.array([g for _, g in grades])

    def cuts(c):
        return np.array([-np.inf, c[0], c[0] + np.exp(c[1]), np.inf])

    def gradient(z):
        t, s = cuts(z[-2:]), x @ z[:-2]
        hi, lo = sigmoid(t[y + 1] - s), sigmoid(t[y] - s)
        p = np.maximum(hi - lo, 1e-9)
        dhi, dlo = hi * (1 - hi) / p / len(y), lo * (1 - lo) / p / len(y)
        g1 = -dhi[y == 0].sum() + dlo[y == 1].sum()
        g2 = -dhi[y == 1].sum() + dlo[y == 2].sum()
        return np.concatenate([x.T @ (dhi - dlo) + 3e-4 * z[:-2], [g1 + g2, np.exp(z[-1]) * g2]])

    z = adam(gradient, np.zeros(len(used) + 2), 300, 0.05)
    assert np.abs(w[used] - z[:-2]).max() < 1e-6 and np.abs(theta - cuts(z[-2:])[1:3]).max() < 1e-6
    graded = {r.doc_id: r for r in quality.grade(table, (w, theta), ["doc_id"]).select("row.doc_id", "expected_grade", "tail").collect()}
    above = 1 - sigmoid(theta[None, :] - (x @ z[:-2])[:, None])
    assert all(abs(graded[i].expected_grade - above[i].sum()) < 1e-5 and abs(graded[i].tail - above[i, 0]) < 1e-5 for i in range(150))


def test_words_of_are_the_documented_ones(texts):
    for t in list(texts.values())[:50]:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        assert [w.decode() for w in words_of((t or "").encode())] == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
