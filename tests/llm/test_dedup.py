"""Exact, near, substring and line dedup against brute force, with every odd input."""

import collections
import hashlib
import os
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from wardline.llm import common, exact_dedup, line_dedup, quality_classifier, simhash, substring_dedup, units
from wardline.llm.components import connected

BLANK = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def union_find(n, pairs):
    up = list(range(n))

    def find(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


# components ----------------------------------------------------------------------------------------------

@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(spark, shape):
    rng = np.random.default_rng(4)
    edges = {"chain": [(i, i + 1) for i in range(60)], "star": [(0, i) for i in range(1, 40)], "none": [(3, 3)],
             "random": [tuple(map(int, rng.integers(0, 80, 2))) for _ in range(60)]}[shape]
    got = {r.id: r.root for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = union_find(80, edges)
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert set(got) == touched
    groups = collections.defaultdict(set)
    for i in touched:
        groups[want[i]].add(got[i])
    assert all(len(g) == 1 for g in groups.values()) and len({min(g) for g in groups.values()}) == len(groups)


# exact ---------------------------------------------------------------------------------------------------

def exact_want(pairs):
    groups = collections.defaultdict(list)
    for i, t in pairs:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), i is None, i))
    out = []
    for content, rows in groups.items():
        rows = sorted(rows, key=lambda r: (r[0], r[1], r[2] or 0))
        for n, r in enumerate(rows):
            out.append((r[2], rows[0][2], len(rows), n == 0, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact(documents, odd_pairs, weak):
    """Also with a digest so weak that different contents share it: contents decide."""
    digest = (lambda c: F.substring(c, 1, 1)) if weak else exact_dedup._sha256
    got = exact_dedup.classes(documents(odd_pairs), salts=3, digest=digest).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == exact_want(odd_pairs)


def test_exact_keeps_rows_whole(documents, odd_pairs):
    docs = documents(odd_pairs)
    out = exact_dedup.dedup(docs)
    assert out.schema == docs.schema
    kept = collections.Counter((r[0], r[4]) for r in exact_want(odd_pairs) if r[3])
    assert collections.Counter((r.doc_id, hashlib.sha256(BLANK.sub("", r.text or "").encode()).hexdigest()) for r in out.collect()) == kept
    assert exact_dedup.dedup(docs.limit(0)).count() == 0 and exact_dedup.classes(docs.limit(0)).count() == 0


# simhash -------------------------------------------------------------------------------------------------

def print_want(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_classes(documents, odd_pairs):
    pairs = odd_pairs + [(200 + i, " ".join(["common words in a long text that change little"] * 40) + f" end{i}") for i in range(6)]
    prints = [print_want(t) for _, t in pairs]
    near = [(a, b) for a in range(len(pairs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = union_find(len(pairs), near)
    name = {r: min((pairs[k][0] for k in range(len(pairs)) if roots[k] == r and pairs[k][0] is not None), default=None) for r in roots}
    want = sorted([(pairs[k][0], f"{prints[k]:016x}", name[roots[k]]) for k in range(len(pairs))], key=str)
    docs = documents(pairs)
    assert sorted(map(tuple, simhash.classes(docs).collect()), key=str) == want
    out = simhash.dedup(docs)
    assert out.schema == docs.schema and out.count() == len(set(roots))
    kept = [print_want(r.text) for r in out.collect()]
    assert all((a ^ b).bit_count() > 2 for n, a in enumerate(kept) for b in kept[:n])
    assert simhash.dedup(docs.limit(0)).count() == 0 and simhash.classes(docs.limit(0)).count() == 0


def test_spark_hash_is_the_contracts(spark):
    got = spark.sql("select xxhash64('a b c') h").first().h
    assert got % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42) == simhash.shingle_hashes(b"A b C")[0]


def test_blocks_lose_no_pair():
    masks = simhash.block_masks()
    assert len(masks) == 15 and min(m.bit_count() for m in masks) >= 42
    for a in range(64):
        for b in range(a):
            assert any(not m & (1 << a | 1 << b) for m in masks)


def test_gray_forest_finds_all_pairs():
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fp = np.unique(np.concatenate([centres] + [c ^ (np.uint64(1) << rng.integers(0, 64, 60, dtype=np.uint64)) for c in centres]))
    bucket = rng.integers(0, 3, len(fp))
    forest = simhash.GrayForest(fp, bucket)
    a, b = forest.pairs(np.arange(len(fp)), 2)
    got = {tuple(sorted((int(forest.order[x]), int(forest.order[y])))) for x, y in zip(a, b)}
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp))
            if bucket[i] == bucket[j] and (int(fp[i]) ^ int(fp[j])).bit_count() <= 2}
    assert got == want and len(want) > 1000
    stars = simhash.spanning_stars(fp, bucket, chunk=17)
    assert len(stars[0]) == len(fp) - len(set(union_find(len(fp), want)))


# substrings ----------------------------------------------------------------------------------------------

def substring_want(pairs, width):
    words = [WORD.findall(t or "") for _, t in pairs]
    seen = collections.Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (i, _), w in zip(pairs, words):
        gone = set()
        for k in range(len(w) - width + 1):
            if seen[tuple(w[k:k + width])] > 1:
                gone |= set(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_regions", [2000, 1])
def test_substrings(documents, odd_pairs, shard_regions, monkeypatch):
    """Also with every anchor dealt by window."""
    whole = substring_dedup.spans
    monkeypatch.setattr(substring_dedup, "spans", lambda docs, width, gram: whole(docs, width, gram, shard_regions))
    pairs = odd_pairs + [(300, "one two three four five six seven " * 12)]
    docs = documents(pairs)
    assert sorted(map(tuple, substring_dedup.digests(docs).collect()), key=str) == substring_want(pairs, 35)


def test_no_automaton_grows_with_a_hot_passage(documents, monkeypatch):
    """A passage with other words around it in every document: its edge windows lie in as many distinct regions."""
    limit, whole, automaton = 4, substring_dedup.spans, substring_dedup.SuffixAutomaton

    class Bounded(automaton):
        def __init__(self, sequences, times):
            if len(sequences) > limit:
                raise ValueError(f"{len(sequences)} sequences in one automaton")
            automaton.__init__(self, sequences, times)

    monkeypatch.setattr(substring_dedup, "SuffixAutomaton", Bounded)
    monkeypatch.setattr(substring_dedup, "spans", lambda docs, width, gram: whole(docs, width, gram, limit))
    own = lambda i, side: " ".join(f"{side}{i}w{k}" for k in range(50))
    passage, pair = (" ".join(f"{x}{k}" for k in range(60)) for x in ("shared", "pair"))
    pairs = [(i, f"{own(i, 'a')} {passage} {own(i, 'b')}") for i in range(30)]
    pairs += [(100 + i, f"{own(i, 'c')} {pair} {own(i, 'd')}") for i in range(2)] + [(None, pairs[0][1])] * 2
    got = substring_dedup.digests(documents(pairs)).collect()
    assert sorted(map(tuple, got), key=str) == substring_want(pairs, 35)


def test_substrings_removed_from_rows(documents, odd_pairs):
    docs = documents(odd_pairs)
    rows = substring_dedup.remove(docs).collect()
    assert len(rows) == len(odd_pairs) and substring_dedup.remove(docs).schema == docs.schema
    by = {r.doc_id: r for r in rows}
    assert by[100].text is None and by[112].text == "" and by[112].n_chars == 0 and by[115].text == "a\nb\r\nc"
    assert substring_dedup.remove(docs.limit(0)).count() == 0 and substring_dedup.digests(docs.limit(0)).count() == 0


def test_automaton_counts_like_brute_force():
    rng = np.random.default_rng(2)
    for width in (1, 2, 4):
        texts = [[b"ab"[x:x + 1] for x in rng.integers(0, 2, n)] for n in (9, 14, 5, 1, 9)]
        times = [1, 1, 2, 1, 1]
        seen = collections.Counter()
        for t, n in zip(texts, times):
            for i in range(len(t) - width + 1):
                seen[tuple(t[i:i + width])] += n
        automaton = substring_dedup.SuffixAutomaton(texts, times)
        for t in texts:
            want = {k for i in range(len(t) - width + 1) if seen[tuple(t[i:i + width])] > 1 for k in range(i, i + width)}
            assert {k for a, b in automaton.repeated(t, width) for k in range(a, b)} == want


# lines ---------------------------------------------------------------------------------------------------

def test_lines(documents):
    rng = np.random.default_rng(6)
    words = ["".join(map(chr, rng.integers(97, 107, 5))) for _ in range(200)]
    pick = lambda n: " ".join(rng.choice(words, n))
    base = pick(40)
    near = [base[:k * 7] + "#" + base[k * 7:] for k in range(1, 9)]
    pairs = [(1, "\n".join([base, pick(12), "short", ""])), (2, "\n".join(near)), (3, "short\nother\n \n" + pick(30)), (4, None), (5, ""),
             (None, base), (6, "twice\n" + base.replace("a", "b")), (6, "twice\n" + base.replace("a", "b")), (7, "é日本🤦 line\né日本🤦 line"),
             (8, pick(9000))]

    def shingles(line):
        line = line.ljust(8, "\0")
        return {line[i:i + 8] for i in range(len(line) - 7)}

    places = [(i is None, i or 0, n, k, line) for n, (i, t) in enumerate(pairs) for k, line in enumerate((t or "").split("\n")) if WORD.search(line)]
    sets = [shingles(p[4]) for p in places]
    near = [(a, b) for a in range(len(places)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    roots = union_find(len(places), near)
    first = {}
    for k in sorted(range(len(places)), key=lambda k: places[k][:4]):
        first.setdefault(roots[k], k)
    gone = collections.defaultdict(list)
    for k, p in enumerate(places):
        if first[roots[k]] != k:
            gone[p[2]].append(p[3])
    want = [(i, sum(p[2] == n for p in places), len(gone[n]), ",".join(map(str, gone[n]))) for n, (i, _) in enumerate(pairs)]
    copies = [n for n, (i, _) in enumerate(pairs) if i == 6]
    want[copies[1]] = (6, 2, 2, "all")
    docs = documents(pairs)
    assert sorted(map(tuple, line_dedup.summary(docs).collect()), key=str) == sorted(want, key=str)
    out = line_dedup.remove(docs)
    assert out.schema == docs.schema and out.count() == len(pairs)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] == pairs[0][1] and texts[2] == "" and texts[4] is None
    assert line_dedup.summary(docs.limit(0)).count() == 0


def test_lines_of_copied_rows_are_removed(documents):
    """Rows of one text and one or no doc_id: what remove() leaves is what summary() says."""
    pairs = [(None, "first line of it\n\nsecond and last"), (None, "first line of it\n\nsecond and last"), (6, "a third one"), (6, "a third one"),
             (7, " \n"), (7, " \n"), (None, None), (None, None)]
    docs = documents(pairs)
    out = [(r.doc_id, r.text) for r in line_dedup.remove(docs).collect()]
    assert sorted(out, key=str) == sorted([(None, pairs[0][1]), (None, ""), (6, "a third one"), (6, ""), *pairs[4:]], key=str)
    left = collections.Counter((i, sum(bool(WORD.search(x)) for x in (t or "").split("\n"))) for i, t in out)
    assert left == collections.Counter((r.doc_id, r.n_lines - r.n_removed) for r in line_dedup.summary(docs).collect())


def test_large_line_buckets_without_all_pairs(spark, monkeypatch):
    """One bucket of template lines, near copies and chains: all components found, few pairs compared."""
    rng = np.random.default_rng(12)
    own = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    template = own(60)
    texts = [template + own(40) for _ in range(150)]  # alike in half their shingles
    base = template + own(60)
    texts += [base[:100 + k % 20] + own(1) + base[101 + k % 20:] for k in range(60)]  # near copies of one line
    chain = template + own(60)
    for _ in range(12):  # each one like the one before, the ends unlike
        chain = chain[8:] + own(8)
        texts.append(chain)
    texts = sorted(set(texts))
    sets = [line_dedup.shingles(x) for x in texts]
    near = [(a, b) for a in range(len(texts)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    asked, compared = [], line_dedup._compared
    monkeypatch.setattr(line_dedup, "_compared", lambda pairs, lines: asked.append(pairs.count()) or compared(pairs, lines))
    table = spark.createDataFrame([(k, str(k).encode(), x, [7]) for k, x in enumerate(texts)], "number long, id binary, line string, bands array<long>")
    edges = [(r.a, r.b) for r in line_dedup.links(table, table).collect()]
    assert union_find(len(texts), edges) == union_find(len(texts), near) and set(edges) <= {(b, a) for a, b in near}
    assert sum(asked) < len(texts) * (len(texts) - 1) // 10


def test_line_recall_at_the_threshold():
    """Share of pairs at similarity 0.8 to 0.85 that meet in a bucket, on signatures computed here."""
    rng = np.random.default_rng(9)
    masks = np.asarray([m % (1 << 64) for m in line_dedup._masks()], np.uint64)
    met = 0
    for _ in range(400):
        pool = rng.integers(0, 1 << 63, 110, dtype=np.uint64) * np.uint64(2)
        a, b = pool[:100], np.concatenate([pool[10:100], pool[100:]])  # 90 shared of 110
        least = [np.asarray([(s ^ m).min() for m in masks]).reshape(line_dedup.BANDS, line_dedup.ROWS) for s in (a, b)]
        met += bool((least[0] == least[1]).all(axis=1).any())
    assert met >= 399


def test_line_bands_lose_few_pairs_at_the_threshold():
    """By the bands' own numbers: at similarity 0.8 fewer than one pair in ten thousand shares no bucket."""
    assert (1 - 0.8 ** line_dedup.ROWS) ** line_dedup.BANDS < 1e-4
    assert len(set(line_dedup._masks())) == line_dedup.BANDS * line_dedup.ROWS


def test_line_signatures_do_not_mix():
    lines = ["", "abc", "x" * 40, "a longer line of words", "日本語🤦 é", "z" * 8]
    together = line_dedup._least_hashes(lines)
    assert (together == np.concatenate([line_dedup._least_hashes([x]) for x in lines])).all()
    assert together.shape == (6, line_dedup.BANDS * line_dedup.ROWS) and len({tuple(r) for r in together.tolist()}) == 6


# what steps leave behind ---------------------------------------------------------------------------------

def test_hashing_words_keeps_none_of_them():
    units.forget()
    words = [b"word %d" % i for i in range(1000)]
    assert substring_dedup.word_hashes(words).tolist() == [xxhash.xxh3_64_intdigest(w) for w in words]
    assert [k for k in units.worker_store() if not k.startswith("__")] == []


@pytest.mark.parametrize("step", ["substring", "simhash", "quality", "quality keep"])
def test_steps_drop_what_other_operators_left_with_the_worker(spark, documents, step):
    def fill(batches):
        units.worker_store()["packing ids"] = "left"
        yield from batches

    def look(batches):
        for batch in batches:
            left = "packing ids" in units.worker_store()
            yield pa.RecordBatch.from_arrays([pa.array([left] * batch.num_rows)], ["left"])

    docs = documents([(i, "one two three") for i in range(4)]).coalesce(1)
    model = quality_classifier.AttentionModel()
    model.share = 1.0
    assert docs.mapInArrow(fill, docs.schema).count() == 4
    one = {"substring": lambda: substring_dedup._anchored(docs, 35, 8), "simhash": lambda: simhash.fingerprints(docs),
           "quality": lambda: quality_classifier.scores(docs, model), "quality keep": lambda: quality_classifier.keep(docs, model)}[step]()
    one.collect()
    assert not any(r.left for r in docs.select("doc_id").mapInArrow(look, "left boolean").collect())


def test_written_steps_leave_no_shuffle_files(spark):
    def shuffles():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString("\n").split("\n")
        return {b.split("_")[1] for b in blocks if b.startswith("shuffle_")}

    before, setting = shuffles(), spark.conf.get(common.CLEANUP)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    assert sorted(common.written(rows, "test-counts").collect()) == sorted(rows.collect())
    own = spark.range(1000).repartition(3, "id")
    common.written(own, "test-dealt")
    for _ in range(50):
        if len(shuffles() - before) <= 1:  # that of rows.collect()
            break
        time.sleep(0.1)
    assert len(shuffles() - before) <= 1
    assert spark.conf.get(common.CLEANUP) == setting


def test_band_keys_are_shuffled_once(spark, documents, monkeypatch):
    plans = {}
    monkeypatch.setattr(line_dedup, "written", lambda df, name: plans.setdefault(name, df) and common.written(df, name))
    docs = documents([(i, f"the same long line of text, number {i % 3}") for i in range(30)])
    line_dedup.summary(docs).collect()
    found = plans["line-buckets"].withColumn("more", F.lit(1))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("ReusedExchange") >= 1


# line dedup: cheap forms of the same answers ------------------------------------------------------------------

def test_blank_lines_are_told_by_their_front_alone(spark):
    odd = ["", " ", "\t\x0b\x0c\r ", "\xa0", " \xa0", "a", "  a  ", "　", "日本", "\r\x85", "\x1c", "\0", " \0 ", "x" * 1000 + " " * 1000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(odd)] + [(99, "\n".join(odd)), (100, None)], "doc_id long, text string")
    worded = [t for t in odd if t.strip(" \t\x0b\x0c\r")]
    assert sorted(r.line for r in line_dedup.lines(docs).select("line").collect()) == sorted(worded * 2)
    counts = {r.doc.doc_id: r.n_lines for r in line_dedup._documents(docs).collect()}
    assert counts == {**{i: int(t in worded) for i, t in enumerate(odd)}, 99: len(worded), 100: 0}
    for step in (line_dedup.lines(docs), line_dedup._documents(docs)):
        assert "translate(" not in step._jdf.queryExecution().optimizedPlan().toString()


def test_shingles_of_lines_are_counted_as_sets_would(monkeypatch):
    rng = random.Random(8)
    plain = ["".join(rng.choice("ab é\xff\0") for _ in range(rng.randint(1, 60))) for _ in range(300)] + ["x", "\0", "a" * 5000, "é" * 8]
    wide = plain + ["日本語🤦" * k for k in range(1, 9)] + ["a" * 30 + "ł", "Ā" * 8]
    groups = [(x,) for x in wide] + [(rng.choice(wide), rng.choice(wide)) for _ in range(500)]
    assert line_dedup._distinct(groups) == [len(set().union(*map(line_dedup.shingles, g))) for g in groups]
    expected = [len(line_dedup.shingles(x)) for x in plain]
    monkeypatch.setattr(line_dedup, "shingles", None)  # no sets of strings for such lines
    assert line_dedup._distinct((x,) for x in plain) == expected


# line dedup: what it leaves and what it shuffles --------------------------------------------------------------

def _tables(spark):
    folder = common.shared_folder(spark).removeprefix("file://")
    return {os.path.relpath(os.path.join(at, x), folder) for at, names, _ in os.walk(folder) for x in names}


def test_line_dedup_leaves_only_its_classes(spark, documents):
    docs = documents([(i, f"the same long line of text, number {i % 3}\nand one of its own, {i * 7919}") for i in range(60)])
    before = _tables(spark)
    found = line_dedup.summary(docs)
    assert [x.split("-")[:2] for x in _tables(spark) - before] == [["line", "classes"]]
    assert sum(r.n_removed for r in found.collect()) >= 57


def test_a_scratch_block_keeps_what_it_is_told_to(spark):
    before = _tables(spark)
    with pytest.raises(ZeroDivisionError), common.scratch(spark) as kept:
        inner = common.written(spark.range(5), "inner")
        with common.scratch(spark) as further:
            outer = further(inner.where("id > 1"), "outer")
        stays = kept(outer.where("id > 2"), "stays")
        assert outer.count() == 3 and len(_tables(spark) - before) == 4
        1 / 0
    assert [r.id for r in stays.orderBy("id").collect()] == [3, 4]
    assert [x.split("-")[0] for x in _tables(spark) - before] == ["stays"]
    readers = [stays.where("id > 3"), stays.where("id > 4")]
    common.drop_with(readers, stays)
    del readers[0]
    assert _tables(spark) != before
    del readers[0]
    assert _tables(spark) == before
    common.drop_with([spark.range(1)], spark.range(2))  # no written table


def test_lines_that_meet_no_other_are_not_shuffled(spark, documents, monkeypatch):
    rng = np.random.default_rng(4)
    own = ["".join(map(chr, rng.integers(97, 123, 60))) for _ in range(300)]
    plans = {}
    monkeypatch.setattr(line_dedup, "written", lambda df, name: plans.setdefault(name, df) and common.written(df, name))
    docs = documents([(i, x) for i, x in enumerate(own)] + [(1000, own[0] + "x"), (1001, own[0])])
    out = {r.doc_id: r.n_removed for r in line_dedup.summary(docs).collect()}
    assert {i for i, n in out.items() if n} == {1000, 1001}
    assert "getbit" in plans["line-texts"]._jdf.queryExecution().optimizedPlan().toString()
