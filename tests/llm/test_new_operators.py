"""Spelling variants, importance resampling and nearest neighbours against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventloom.llm import ann, importance, pieces, queries, spelling, token_files
from tests.llm.test_operators import LONG, TEXTS, docs

# ---- 11 spelling variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_vocabulary(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run
            if len(word) >= 7:
                counts[word] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def brute_grouped(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, words[w], len(near[w]), form[w], words.get(form[w]), root))
    return out


def grouped(spark, words):
    found = spelling.grouped(spark.createDataFrame(list(words.items()), "word string, n long"))
    return {tuple(r) for r in found.select("word", "n", "n_near", "form", "form_n", "root").collect()}


def test_spelling_groups(spark):
    rng = np.random.default_rng(4)
    words = {}
    for _ in range(30):  # families of near words over few letters, so that bigrams repeat and tie
        base = "".join(rng.choice(list("abcé"), rng.integers(7, 12)))
        for _ in range(25):
            w, at = base, int(rng.integers(0, len(base)))
            w = [w[:at] + w[at + 1 :], w[:at] + "aé"[at % 2] + w[at:], w[:at] + "bc"[at % 2] + w[at + 1 :], w][int(rng.integers(0, 4))]
            if len(w) >= 7:
                words[w] = int(10 ** rng.integers(0, 4)) + 1
    words |= {"aaaaaaa": 5, "aaaaaaaa": 60, "aaaaaaaaa": 700, "aaaaaaaaaa": 8000, "zzzzzzz": 2, "x" * 3000: 2, "x" * 3001: 30}
    assert grouped(spark, words) == brute_grouped(words)


def test_spelling_of_documents(spark):
    rows = [(i, t) for i, t in TEXTS] + [(10 + i, "Kilometre kilometre KILOMETRE kilometres Kilomètre kilomètre ÉCLAIRS éclairs Éclairs éclairs") for i in range(40)]
    rows += [(100 + i, "a" * 50_000 + " thirdlyx thirdly" + "÷×" * 5) for i in range(3)] + [rows[5]] * 4
    table = docs(spark, *rows).withColumn("word", F.lit("x")).withColumn("n", F.lit("y"))
    got = {tuple(r) for r in spelling.variants(table).select("word", "n", "n_near", "form", "form_n", "root").collect()}
    assert got == brute_grouped(brute_vocabulary(rows)) and len(got) > 5
    assert spelling.variants(docs(spark)).count() == 0


def test_every_pair_one_edit_apart_is_met(spark):
    """Random words over three letters and all kinds of edits at all places, the ends included."""
    rng = np.random.default_rng(7)
    words = {}
    for _ in range(120):
        base = "".join(rng.choice(list("abc"), rng.integers(7, 13)))
        for at in range(len(base) + 1):
            c = "abcd"[int(rng.integers(0, 4))]
            for w in (base, base[:at] + c + base[at:], base[:at] + base[at + 1 :], base[:at] + c + base[at + 1 :]):
                if len(w) >= 7:
                    words[w] = int(rng.integers(2, 50))
    got = {(r.a, r.b) for r in spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((i, w[:i] + "*" + w[i + 1 :]), set()).add(w)
    want = {(a, b) for own in holes.values() for a in own for b in own if a != b}
    want |= {p for w in words for i in range(len(w)) if (v := w[:i] + w[i + 1 :]) in words for p in ((w, v), (v, w))}
    assert got == want and len(want) > 5000


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=7, max_size=12), st.integers(0, 12), st.sampled_from("abc"), st.integers(0, 2), st.randoms(use_true_random=False))
def test_pivots_meet_prefixes(a, at, letter, kind, random):
    """Of two words one edit apart, the one with the earlier prefix has a pivot in the other's, in place or moved by the edit."""
    at = min(at, len(a) - 1)
    b = [a[:at] + a[at + 1 :], a[:at] + letter + a[at:], a[:at] + letter + a[at + 1 :]][kind]
    if len(b) < 5 or a == b:
        return
    grams = [x + y for x in "abc" for y in "abc"]
    random.shuffle(grams)
    order = {g: (i, random.randint(1, 4)) for i, g in enumerate(grams)}
    (last_a, pre_a, piv_a), (last_b, pre_b, piv_b) = spelling.signature(a, order), spelling.signature(b, order)
    if last_a > last_b:
        a, b, piv_a, pre_b = b, a, piv_b, pre_a
    more = len(b) - len(a)
    assert any((g, p) in pre_b or (g, p + more) in pre_b for g, p in piv_a)


def test_pivots_are_the_cheapest_apart():
    rng = np.random.default_rng(8)
    for _ in range(300):
        places = sorted(rng.choice(20, rng.integers(3, 8), replace=False).tolist())
        weights = rng.integers(1, 6, len(places)).tolist()
        cost = dict(zip(places, weights))
        chosen = spelling.pivots(places, weights)
        pairs = [(cost[x] + cost[y], (x, y)) for x, y in combinations(places, 2) if y - x >= 2]
        assert (sum(cost[p] for p in chosen), chosen) == min(pairs)


# ---- 12 importance resampling


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def runs(text, longest):
    own = words(text)
    return [" ".join(own[i : i + n]) for n in range(1, longest + 1) for i in range(len(own) - n + 1)]


def brute_ranked(rows, items, longest, buckets, least, percent):
    bucket = lambda w: zlib.crc32(w.encode()) % buckets
    s, t = (Counter(bucket(w) for text in texts for w in runs(text, longest)) for texts in ([x for _, x in rows], items))
    ss, tt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets))))
    out = []
    for doc_id, text in rows:
        own = runs(text, longest)
        weight = sum(gain(bucket(w)) for w in own)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(words(text)), len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    large = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    place = {id(r): i for i, r in enumerate(large[: len(large) * percent // 100], 1)}
    return Counter((*r, place.get(id(r))) for r in out)


@pytest.mark.parametrize("longest,buckets,together", [(1, 10_000, None), (3, 50, 64)])
def test_importance(spark, monkeypatch, longest, buckets, together):
    if together:
        monkeypatch.setattr(importance, "TOGETHER", together)
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(rng.choice(["Red", "green", "BLÜE", "x1", "—", "of", "the"], rng.integers(0, 60)))) for i in range(20, 220)]
    rows += [(i, t) for i, t in TEXTS] + [rows[3], rows[3]]
    items = ["red green of", None, "", "The x1 of blÜe", "unseen words"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    table = docs(spark, *rows).withColumn("weight", F.lit("x")).withColumn("rank", F.lit("y"))
    got = importance.ranked(table, target, longest=longest, buckets=buckets, percent=30)
    got = got.select("doc_id", "n_words", "n_features", "weight", "score", "rank")
    assert Counter(map(tuple, got.collect())) == brute_ranked(rows, items, longest, buckets, 20, 30)
    drawn = importance.resample(table, target, longest=longest, buckets=buckets, percent=30)
    assert drawn.columns == table.columns and {r.doc_id for r in drawn.collect()} == {r.doc_id for r in got.where("rank IS NOT NULL").collect()}


def test_importance_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert importance.ranked(docs(spark), none).count() == 0
    got = importance.ranked(docs(spark, (1, LONG), (2, None)), none, percent=50).collect()
    assert {(r.doc_id, r["rank"]) for r in got} == {(1, None), (2, None)}  # one large document: half of one is none
    assert importance.resample(docs(spark, (1, LONG)), none, percent=100).count() == 1


def test_runs_of_words_stay_inside_a_text():
    texts = pa.array(["a b", None, "c", "a b c", ""])
    found = list(importance.features(texts, 3, 1 << 32))
    names = [[texts[i].as_py() for i in range(5)]]
    for n, (bucket, ends) in enumerate(found, 1):
        own = [[zlib.crc32(r.encode()) for r in runs(t, n) if len(r.split()) == n] for t in names[0]]
        assert [bucket[lo:hi].tolist() for lo, hi in zip([0, *ends[:-1]], ends)] == own


# ---- 13 nearest neighbours


def brute_nearest(rows, is_query, k):
    """(query, k nearest as (distance, id)) with vectors padded to one width."""
    width = max(len(v) for _, v in rows)
    m = np.array([[*v, *[0.0] * (width - len(v))] for _, v in rows])
    ids = np.array([i for i, _ in rows])
    out = {}
    for q, (i, _) in enumerate(rows):
        if is_query(i):
            d = np.sqrt(((m[q] - m) ** 2).sum(axis=1))
            other = np.flatnonzero(ids != i)
            order = other[np.lexsort((ids[other], d[other]))[:k]]
            out[i] = [(d[j], ids[j]) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        own = out.setdefault(r.query_id, [])
        own.append((r.score, r.vec_id))
        assert r["rank"] == len(own)
    return out


def test_nearest_with_one_list_is_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(200)]
    rows = [(i, rows[50][1] if 50 <= i < 120 else v) for i, v in rows]  # a third are equal
    rows += [(300, [5.0]), (310, [5.0, 0.0]), (320, [-0.0] * 5 + [1.0])]
    bad = [(900, None), (910, [None] * 6), (920, [float("nan")] * 6), (930, [float("inf")] * 6), (940, [0.0] * 6), (950, []), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + bad], "vec_id long, embedding array<float>, row int, list string")
    got = found(ann.nearest(ann.clean(df), F.col("vec_id") % 10 == 0, k=5))
    assert got == brute_nearest(rows, lambda i: i % 10 == 0, 5)


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_nearest_over_many_lists(spark, spread):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 16))
    rows = [(i, (centres[i % 40 if i % 3 else 0] + spread * rng.normal(size=16)).tolist()) for i in range(4000)]  # a third around one centre
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    index = ann.Index(ann.clean(df), 11, lists_of=40)
    sizes = {r["list"]: r["n"] for r in index.blocks.groupBy("list").agg(F.sum(F.length("rows") / 8).alias("n")).collect()}
    assert 60 < len(sizes) < 200 and max(sizes.values()) < 3 * 40 * ann.REPLICAS
    assert 4000 <= sum(sizes.values()) <= 4000 * ann.REPLICAS
    if spread < 1:
        assert index.ratio < 5
    got, want = found(ann.nearest(ann.clean(df), F.col("vec_id") % 20 == 0, lists_of=40)), brute_nearest(rows, lambda i: i % 20 == 0, 10)
    assert {q: len(v) for q, v in got.items()} == {q: 10 for q in want}
    hit = sum(len({i for _, i in got[q]} & {i for _, i in own}) for q, own in want.items())
    assert hit / (10 * len(want)) >= 0.95
    exact = dict(rows)
    for q, own in got.items():
        for d, i in own:
            assert abs(d - math.dist(exact[q], exact[i])) < 1e-12


def test_nearest_recall_of_the_query(spark):
    path = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in queries.table(spark, path, "embeddings").collect()]
    want = brute_nearest(rows, lambda i: i % 100 == 0, 10)
    got = found(queries.op13_nearest(spark, path))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert sum(len({i for _, i in got[q]} & {i for _, i in own}) for q, own in want.items()) / (10 * len(want)) >= 0.9


def test_nearest_small(spark):
    shape = "vec_id long, embedding array<float>"
    assert ann.nearest(ann.clean(spark.createDataFrame([], shape)), F.lit(True)).count() == 0
    assert ann.nearest(ann.clean(spark.createDataFrame([(0, [1.0])], shape)), F.lit(True)).count() == 0
    two = spark.createDataFrame([(0, [3.0]), (1, [0.0, 4.0])], shape)
    assert found(ann.nearest(ann.clean(two), F.lit(True))) == {0: [(5.0, 1)], 1: [(5.0, 0)]}
    same = spark.createDataFrame([(7, [1.0, 1.0]), (7, [1.0, 2.0]), (8, [1.0, 4.0])], shape)  # a repeated id
    assert found(ann.nearest(ann.clean(same), F.col("vec_id") == 7)) == {7: [(2.0, 8), (3.0, 8)]}


def test_graph_finds_all_within_a_ratio():
    rng = np.random.default_rng(9)
    graph = ann.Graph(rng.normal(size=(600, 8)))
    queries_ = rng.normal(size=(200, 8))
    missed = total = 0
    for x, (ids, d) in zip(queries_, graph.within(queries_, 1.3)):
        far = np.sqrt(((x - graph.centroids) ** 2).sum(axis=1))
        want = set(np.flatnonzero(far <= 1.3 * far.min()).tolist())
        assert np.allclose(d, far[ids]) and (np.diff(d) >= 0).all()
        missed += len(want - set(ids.tolist()))
        total += len(want)
    assert missed <= 0.02 * total


def test_cells_are_balanced():
    sample = np.random.default_rng(1).normal(size=(1000, 4)) ** 3
    for lists in (1, 7, 64):
        cells = ann.balanced_cells(sample, lists)
        assert sorted(np.concatenate(cells)) == list(range(1000)) and len(cells) == lists
        assert max(map(len, cells)) - min(map(len, cells)) <= 8


# ---- check of the third round: seconds of op2 and op10


def test_marks_behind_words_are_apart():
    """op2_token_files: a word was encoded anew with each run of marks behind it. The ids are those of the whole text."""
    public = pytest.importorskip("public_tokenizers")
    with open(public.path("word_bpe_49k.json"), encoding="utf-8") as f:
        definition = f.read()
    assert token_files.shortcuts(definition) == (True, True)
    one, whole = token_files.WordIds(definition, True, True), token_files.WordIds(definition, by_word=False)
    texts = [t.encode() for t in ("Wort%%% Wort### wort.$$$ Wort, Wort!? ", "it's... we'll! x2% 3;; é?! ein-&\tß.\n", "a.b c,, .d e.\x1c f.", "", "%%% . x<|startoftext|> y|>. z<|endoftext|>.")]
    assert one.encode_many(texts) == [one.encode(t) for t in texts] == [whole.encode(t) for t in texts]
    assert {w for w in one.known if w.startswith(b"Wort")} == {b"Wort"}


def test_tokens_added_with_marks_are_left_to_the_tokenizer():
    """Words are not cut at marks that a token of their own may hold."""
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(public.path("word_bpe_49k.json")))
    tokenizer.add_tokens(["end%%"])
    assert token_files.shortcuts(tokenizer.to_str())[0] is False


def test_segments_are_packed_for_all_chunks():
    """op10_pieces: the ways back were walked in Python, an id at a time. Characters of no piece are spelt in bytes."""
    pytest.importorskip("public_tokenizers")
    encoder = pieces.Encoder(queries.piece_model())
    chunks = ["▁the", "\x00", "▁internationalisation", "漢字\U0001f600x", "a", "▁▁▁", "ßé\U0001f600", "\U0001f600\U0001f600", "zzzzq%"]
    packed = encoder.segmented(chunks)
    assert [np.frombuffer(p, "<i4").tolist() for p in packed] == [encoder.viterbi(c) for c in chunks] == encoder.segment(chunks)
