"""Operator 13 against a brute-force count in Python integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from wardline.llm import source_divergence as sd


def brute(docs, least, ranks):
    clean = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")))
             for lang, source, text in docs]
    out = []
    for lang in {d[0] for d in clean}:
        mine = [d for d in clean if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= least}
        counts = defaultdict(Counter)
        for _, source, terms in mine:
            counts[source].update(t for t in terms if t in kept)
        whole = sum(counts.values(), Counter())
        v = len(kept)
        def share(c, t):
            return 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * v)
        sources = {d[1] for d in mine}
        for s in sources:
            terms = [(share(counts[s], t) - share(whole, t), t) for t in kept if counts[s][t] and share(counts[s], t) > share(whole, t)]
            for part, found, most in (("term", terms, ranks), ("pair", [(sum(abs(share(counts[s], t) - share(counts[o], t)) for t in kept), o) for o in sources - {s}], None)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda r: (-r[0], r[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


def odd_docs(seed=5, n=150):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randint(1, 3))) for _ in range(60)] + ["Ünï", "ünï", "ÉTÉ", "日本", "𝔘x", "zz", "a.b"]
    docs = [(rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s1", "s1", "S2", "é", "", None]), " ".join(rng.choices(words, k=rng.randint(0, 40)))) for _ in range(n)]
    docs += [("fr", "alone", "un deux"), ("xx", "only", None), ("xx", "other", ""), ("en", "bare", "12 34"), ("en", "s1", "same words"), ("en", "s1", "same words"),
             ("en", "long", "ab Cd\t" * 3000), ("en", "s1", "x" * 5000), ("", "", "ab ab"), (None, None, None)]
    return docs


@pytest.fixture(scope="module")
def table(spark):
    def make(docs):
        data = [(i, t, c, s, "x", "y", "z", 1) for i, (c, s, t) in enumerate(docs)]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, term string, n string, rank string, value int").repartition(3)
    return make


@pytest.mark.parametrize("least,ranks", [(1, 50), (3, 5), (3, 1), (30, 50), (1000, 50)])
def test_audit_equals_brute_force(table, least, ranks):
    docs = odd_docs()
    assert sorted(tuple(r) for r in sd.audit(table(docs), least, ranks).collect()) == brute(docs, least, ranks)


def test_ranks_within_one_value_follow_utf8(table):
    docs = [("en", "a", f"{w} {w}") for w in ("zeta", "été", "alpha", "日本", "𝔘x", "beta") for _ in range(2)] + [("en", "b", "other")] * 2
    got = sd.audit(table(docs), 2, 4).where("part = 'term' and source = 'a'").orderBy("rank").collect()
    assert [(r.item, r.rank) for r in got] == [("alpha", 1), ("beta", 2), ("zeta", 3), ("été", 4)]


def test_counts_in_small_blocks_and_many_flushes(table, monkeypatch):
    docs = odd_docs(8)
    want = brute(docs, 2, 50)
    monkeypatch.setattr(sd, "BLOCK", 7)
    monkeypatch.setattr(sd, "HELD", 10)
    monkeypatch.setattr(sd, "CELLS_AT_ONCE", 12)
    assert sorted(tuple(r) for r in sd.audit(table(docs), 2, 50).collect()) == want


def test_shares_of_counts_beyond_a_long_product(spark):
    big = 40_000_000_000
    kept = spark.createDataFrame([("en", "t", 2 * big, [("a", 2 * big)]), ("en", "u", big + 3, [("a", big), ("b", 3)])],
                                 "lang string, term string, total long, places array<struct<source:string,n:long>>")
    found = spark.createDataFrame([("en", "a", 3 * big, 2, 3 * big + 3), ("en", "b", 3, 2, 3 * big + 3)],
                                  "lang string, source string, size long, terms long, lang_size long")
    share = lambda c, n: 1 + 10**9 * (c + 5) // (n + 10)
    value = abs(share(2 * big, 3 * big) - share(0, 3)) + abs(share(big, 3 * big) - share(3, 3))
    assert {(r.source, r.item, r.value) for r in sd.pair_ranks(kept, found).collect()} == {("a", "b", value), ("b", "a", value)}
    terms = {(r.source, r.item): r.value for r in sd.term_ranks(kept, found).collect()}
    q = {"t": share(2 * big, 3 * big + 3), "u": share(big + 3, 3 * big + 3)}
    want = {(s, t): share(c, n) - q[t] for s, t, c, n in (("a", "t", 2 * big, 3 * big), ("b", "u", 3, 3), ("a", "u", big, 3 * big)) if share(c, n) > q[t]}
    assert terms == want and terms


def test_empty_table(table):
    assert sd.audit(table(odd_docs()).where("false")).count() == 0


def test_blocks_never_cut_a_term(monkeypatch):
    monkeypatch.setattr(sd, "BLOCK", 5)
    text = "aé日bcdefgh ij, k  lmnopqrstuv".encode()
    assert [t for block in sd._blocks(text) for t in block] == sd._TERM.findall(text)
    assert not np.any([len(b) > 4 for b in sd._blocks(text)])
