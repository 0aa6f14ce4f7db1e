"""Operators 11 and 12: clusters against brute force in Python integers, languages by held-out accuracy and parts."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from wardline.llm import centroid_clustering as cc
from wardline.llm import language_id as li

FOLDER = "/root/testdata/sf0.01"


# --- operator 11 ----------------------------------------------------------------------------
def brute_clusters(rows, k, rounds, dims, seed=3, scale=1024):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    rank = lambda r: (r[0] is None, "" if r[0] is None else hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(),
                      np.asarray(r[1], "<i4").tobytes())
    centroids = [v for _, v in sorted(kept, key=rank)[:k]]
    def assigned():
        out = []
        for i, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((i, d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        near = assigned()
        for c in range(len(centroids)):
            own = [v for (_, v), (_, n, _) in zip(kept, near) if n == c]
            if own:
                centroids[c] = [sum(col) // len(own) for col in zip(*own)]
    return sorted(assigned(), key=str), centroids


@pytest.fixture(scope="module")
def vectors(spark):
    def make(rows):
        data = [(i, v, "x", 1, "y") for i, v in rows]
        return spark.createDataFrame(data, "vec_id long, embedding array<double>, v string, cluster int, distance string").repartition(3)
    return make


def odd_vectors(dims, n=200):
    rng = random.Random(9)
    rows = [(i, [rng.choice((-1, 1)) * rng.random() ** 3 for _ in range(dims)]) for i in range(n)]
    rows += [(1000, None), (1001, []), (1002, [0.5] * (dims - 1)), (1003, [None] + [0.0] * (dims - 1)), (1004, [math.nan] + [0.0] * (dims - 1)),
             (1005, [math.inf] + [0.0] * (dims - 1)), (1006, [0.0] * dims), (1006, [0.0] * dims), (7, [0.25] * dims), (None, [0.5] * dims),
             (None, [0.5] * dims), (1007, [-0.5] * dims), (1008, [1e-9] * dims)]
    return rows


@pytest.mark.parametrize("k,rounds", [(1, 2), (3, 0), (5, 4), (8, 10), (400, 2)])
def test_clusters_equal_brute_force(vectors, k, rounds):
    rows = odd_vectors(6)
    found, centroids = cc.cluster(vectors(rows), k=k, rounds=rounds, dims=6)
    want, want_centroids = brute_clusters(rows, k, rounds, 6)
    assert centroids == want_centroids
    assert sorted((tuple(r) for r in found.collect()), key=str) == want


def test_clusters_of_large_numbers_are_exact(vectors):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1e5, 1e5) + x * 1e-3 for x in range(4)]) for i in range(60)]
    found, centroids = cc.cluster(vectors(rows), k=4, rounds=3, dims=4, scale=1000)
    want, want_centroids = brute_clusters(rows, 4, 3, 4, scale=1000)
    assert centroids == want_centroids and sorted((tuple(r) for r in found.collect()), key=str) == want


def test_report_sums_and_digest(vectors):
    rows = odd_vectors(6)
    got = cc.report(vectors(rows), k=5, rounds=3, dims=6).collect()
    want, centroids = brute_clusters(rows, 5, 3, 6)
    total = sum(d for *_, d in want)
    by = {c: sum(d for _, n, d in want if n == c) for c in range(5)}
    assert len(got) == len(want)
    for r in got:
        assert (r.inertia, r.cluster_inertia) == (total, by[r.cluster])
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_empty_and_unusable_tables_give_no_rows(vectors):
    assert cc.report(vectors([(1, None)]), dims=6).count() == 0
    assert cc.report(vectors([(1, None)]).where("false"), dims=6).count() == 0


def test_tournament_takes_the_smaller_number_on_a_tie():
    v = np.asarray([[0, 0], [1, 0], [5, 5], [3, 3]], np.int32)
    winner, distance = cc.Bisectors([[2, 0], [0, 0], [2, 0], [6, 6]]).nearest(v)
    assert winner.tolist() == [1, 0, 3, 0] and distance.tolist() == [0, 1, 2, 10]
    large = np.asarray([[1 << 30, -(1 << 30)]], np.int64)
    winner, distance = cc.Bisectors([[0, 0], [(1 << 30) - 1, -(1 << 30)]]).nearest(large)
    assert winner.tolist() == [1] and distance.tolist() == [1]


def test_components_out_of_range_are_an_error(vectors):
    with pytest.raises(Exception, match="too large"):
        cc.cluster(vectors([(1, [1e300] * 6)]), dims=6)


# --- operator 12 ----------------------------------------------------------------------------
def test_held_out_documents_are_recognised(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: r for r in li.identify(docs, li.fit(docs)).collect()}
    rows = docs.select("doc_id", "lang", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= got[r.doc_id].score <= 1
    away = [r for r in rows if got[r.doc_id].held_out and r.text and li.has_letter(r.text)]
    for lang in {r.lang for r in away}:
        own = [r for r in away if r.lang == lang]
        assert sum(got[r.doc_id].lang_pred == lang for r in own) >= 0.98 * len(own)


def test_held_out_rows_and_other_columns_teach_nothing(spark):
    schema = "doc_id long, text string, lang string, source string, x string, score double"
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "der die das und nicht", "de", "a", "x", 1.0) if i % 2 else (i, "the and that not of", "en", "b", "x", 1.0)
            for i in range(200) if i not in out]
    wrong = [(i, "der die das und nicht", "zz", "q", "x", 0.0) for i in out]
    first = li.fit(spark.createDataFrame(rows, schema))
    both = li.fit(spark.createDataFrame(rows + wrong, schema))
    assert first.langs == both.langs == ["de", "en"]
    assert all(np.array_equal(first.duels[k], both.duels[k]) for k in first.duels)


def test_odd_texts(spark):
    schema = "doc_id long, text string, lang string, row string, x int, h string, lang_pred string"
    known = [(i, t, c, "r", 1, "h", "p") for i, (t, c) in enumerate([("uno dos tres casa perro", "es"), ("one two three house dog", "en"),
                                                                     ("un deux trois maison chien", "fr"), ("", ""), (None, "de"), ("12 34", "xx")] * 8)]
    odd = [(900, None, None, None, None, None, None), (901, "", "en", "r", 1, "h", "p"), (902, "12 !? 34", "en", "r", 1, "h", "p"),
           (903, "½ ² Ⅷ", None, "r", 1, "h", "p"), (904, "one two house " * 200000, None, "r", 1, "h", "p"), (None, "un deux maison", None, "r", 1, "h", "p"),
           (905, "x", None, "r", 1, "h", "p"), (905, "x", None, "r", 1, "h", "p"), (906, "日本語", None, "r", 1, "h", "p")]
    docs = spark.createDataFrame(known + odd, schema)
    model = li.fit(docs)
    assert set(model.langs) == {"es", "en", "fr"}  # nothing to learn from texts without letters
    got = {}
    for r in li.identify(docs, model).collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    assert all(got[i] == [("und", 0.0)] for i in (900, 901, 902, 903))
    assert got[904][0][0] == "en" and got[None][0][0] == "fr" and len(got[905]) == 2 and got[905][0] == got[905][1]
    assert got[906][0][0] in model.langs
    assert {r.lang_pred for r in li.identify(docs, None).collect()} == {"und"}
    empty = docs.where("false")
    assert li.fit(empty) is None and li.identify(empty, model).count() == 0
    alone = li.fit(docs.where("lang = 'fr'"))
    assert {r.lang_pred for r in li.identify(docs, alone).collect()} == {"und", "fr"}


def test_sample_is_bounded_and_takes_each_text_once(spark):
    rows = [(i, "the same text" if i % 3 else f"text number {i} of many", "en") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    class Spy(li.LanguageModel):
        def __init__(self, x, langs):
            seen.append(len(langs))
    original, li.LanguageModel = li.LanguageModel, Spy
    try:
        li.fit(docs, sample=50)
    finally:
        li.LanguageModel = original
    assert 30 <= seen[0] <= 50


def test_long_texts_have_the_profile_of_the_whole(monkeypatch):
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefg éß.1\n") for _ in range(n)).encode() for n in (0, 1, 3, 4, 5, 63, 64, 65, 200, 1000)]
    whole = li.profiles(texts)
    monkeypatch.setattr(li, "PART", 64)
    assert np.allclose(li.profiles(texts), whole, atol=1e-6)


def test_profiles_count_byte_ngrams():
    text = "Ab.ab".encode()
    x = li.profiles([text])[0] ** 2
    assert x[ord("a")] == pytest.approx(0.4) and x[32] == pytest.approx(0.2)
    at = 0
    for n, places in enumerate(li.PLACES):
        block = x[at:at + places]
        assert block.sum() == pytest.approx(1) and np.count_nonzero(block) <= len(text) - n
        at += places


def test_duel_reaches_the_optimum_of_its_program():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 5)).astype(np.float32)
    sign = np.where(x[:, 0] + 0.5 * rng.normal(size=80) > 0, 1.0, -1.0)
    w = li.fit_svm(x, sign, epochs=2000).astype(np.float64)
    full = np.hstack([x, np.ones((80, 1))])
    slack = np.maximum(0, 1 - sign * (full @ w))
    gradient = w - 2 * full.T @ (slack * sign)
    assert np.abs(gradient).max() < 2e-2


def test_families_are_predicted_before_languages():
    rng = np.random.default_rng(3)
    langs = ["en", "de", "nl", "fr", "es", "xx"]
    centre = rng.random((6, li.FEATURES)).astype(np.float32)
    y = [langs[i % 6] for i in range(120)]
    x = np.stack([centre[i % 6] + 0.05 * rng.random(li.FEATURES) for i in range(120)]).astype(np.float32)
    model = li.LanguageModel(x, y)
    names = {model.langs[a] + model.langs[b] for a, b in model.duels}
    assert model.families == ["germanic", "only xx", "romance"] and names == {"deen", "denl", "ennl", "esfr"}
    best, score = model.predict(x)
    assert [model.langs[i] for i in best] == y and ((0 <= score) & (score <= 1)).all()
