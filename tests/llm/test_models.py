"""Chat trees by round trip; classifier and line field by gradients, brute force and held-out accuracy."""

import collections
import hashlib
import itertools
import math
import re
import tracemalloc
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from wardline.llm import chat_tree, quality_classifier, quality_rules

DATA = "/root/testdata/sf0.01"


# chat ----------------------------------------------------------------------------------------------------

@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="a<[|\\>]/\n"), st.text(alphabet="sI<[|\\>]/ \nend")), max_size=4))
def test_template_is_reversible(turns):
    formatted = "".join(chat_tree.format_turn(*t)[0] for t in turns)
    assert chat_tree.parse(formatted) == turns
    for role, text in turns:
        assert not re.search(r"</s>|\[INST\]|\[/INST\]|<\||\|>", chat_tree.escape(text)) and chat_tree.unescape(chat_tree.escape(role)) == role


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string, path string")


CHATS = [(c, t, r, x, "turns", "path") for c, t, r, x in [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello </s>"), (2, 0, "system", "be kind"), (2, 1, "user", "hi"),
    (2, 2, "assistant", "hey"), (3, 0, "system", "be kind"), (3, 1, "user", "hi"), (4, 1, "assistant", None), (4, 0, None, ""),
    (None, 0, "user", "a"), (None, None, "assistant", "b"), (5, 0, "user", "x"), (5, 0, "assistant", "tie"), (5, 0, "user", "x"),
    (6, 0, "user", "long " * 3000), (6, 1, "assistant", "yes")]] + [(10 + k, t, r, x, None, None) for k in range(12)
                                                                  for t, r, x in ((0, "user", "same"), (1, "assistant", "same"))]


def chat_want(rows):
    by = collections.defaultdict(list)
    for c, t, r, x, *_ in rows:
        by[c].append((t is None, t or 0, r or "", x or ""))
    out = []
    for c, turns in by.items():
        turns = [(r, x) for _, _, r, x in sorted(turns)]
        said, learned = "".join(f"{r}\n{x}\n" for r, x in turns), "".join(x for r, x in turns if r == "assistant")
        out.append((c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest(),
                    sum(len(chat_tree.format_turn(*t)[0]) for t in turns)))
    return sorted(out, key=str)


@pytest.mark.parametrize("chars,convs", [(1 << 16, 2048), (120, 3)])
def test_chat_round_trip(spark, chars, convs):
    pieces = chat_tree.prefix_trees(conversations(spark, CHATS), chars, convs)
    assert sorted(map(tuple, chat_tree.read_back(pieces).collect()), key=str) == chat_want(CHATS)
    rows = pieces.collect()
    assert len({r.piece for r in rows}) == len(rows)
    for r in rows:
        assert len(r.text) <= chars or len(r.conversations) == 1
        assert "".join(r.text[n.start:n.end] for n in r.nodes) == r.text
        for n in r.nodes:
            chain, at = [], n.parent
            while at >= 0:
                chain.append((r.nodes[at].start, r.nodes[at].end))
                at = r.nodes[at].parent
            assert n.position == sum(b - a for a, b in chain)
            assert {x for a, b in chain for x in range(a, b)} == {x for s in n.ancestors for x in range(s.start, s.end)}


@pytest.mark.parametrize("chars,convs", [(1 << 16, 2048), (120, 3)])
def test_chat_tokens(spark, chars, convs):
    """Round trip through ids; positions, masks and intervals in tokens lie where those in characters do."""
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    library.encode_special_tokens = True
    odd = CHATS + [(50, 0, "endoftext", "<|endoftext|> 日本 🤦", None, None), (50, 1, "assistant", "  \n\n", None, None), (51, 0, "assistant", "", None, None)]
    pieces = chat_tree.prefix_trees(conversations(spark, odd), chars, convs)
    tokens = chat_tree.tokenized(pieces, path)
    assert sorted(map(tuple, chat_tree.read_back(tokens, path).collect()), key=str) == chat_want(odd)
    texts = {r.piece: r for r in pieces.collect()}
    for r in tokens.collect():
        written = texts[r.piece]
        assert len(r.nodes) == len(written.nodes) and r.nodes[-1].end == len(r.ids) and r.conversations == written.conversations
        for n, c in zip(r.nodes, written.nodes):
            decode = lambda a, b: library.decode(r.ids[a:b], skip_special_tokens=False)
            assert decode(n.start, n.end) == written.text[c.start:c.end] and decode(n.loss_start, n.loss_end) == written.text[c.loss_start:c.loss_end]
            assert "".join(decode(s.start, s.end) for s in n.ancestors) == "".join(written.text[s.start:s.end] for s in c.ancestors)
            assert n.position == sum(s.end - s.start for s in n.ancestors) and n.parent == c.parent


def test_shared_turns_are_written_once(spark):
    rows = chat_tree.prefix_trees(conversations(spark, CHATS[:8]).coalesce(1)).collect()
    if len(rows) == 1:
        assert rows[0].text.count("be kind") == 1 and len(rows[0].nodes) == 4
    assert sum(r.text.count("be kind") for r in rows) <= len(rows)
    assert chat_tree.read_back(chat_tree.prefix_trees(conversations(spark, []))).count() == 0


# classifier ----------------------------------------------------------------------------------------------

def test_gradients_are_right():
    rng = np.random.default_rng(0)
    model = quality_classifier.AttentionModel(hidden=5, gates=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    bags = np.asarray([1, 3, 2])
    x, y = rng.normal(0, 0.3, (6, quality_classifier.FEATURES)), np.asarray([1.0, 0.0, 1.0])

    def loss():
        p = model.scores(x, bags)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    found = model._gradients(x, bags, y, 0.0)
    for name, g in found.items():
        for at in list(np.ndindex(g.shape))[:: max(1, g.size // 6)]:
            keep = model.weights[name][at]
            model.weights[name][at] = keep + 1e-5
            high = loss()
            model.weights[name][at] = keep - 1e-5
            low = loss()
            model.weights[name][at] = keep
            assert abs((high - low) / 2e-5 - g[at]) < 1e-5, name


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.scores(docs, quality_classifier.fit(docs, labels)).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95 and got.score.between(0, 1).all()
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id)


def test_classifier_on_odd_rows(spark, documents, odd_pairs):
    docs = documents(odd_pairs)
    labels = spark.createDataFrame([(i, i % 2, None) for i in range(20)] + [(None, 1, 0), (105, None, 0)], "doc_id long, quality int, toxic int")
    model = quality_classifier.fit(docs, labels)
    got = quality_classifier.scores(docs, model).collect()
    assert len(got) == len(odd_pairs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert quality_classifier.keep(docs, model, 0.0).schema == docs.schema and quality_classifier.keep(docs, model, 0.0).count() == len(odd_pairs)
    none = quality_classifier.fit(docs, labels.limit(0))
    assert none.share == 1.0 and quality_classifier.keep(docs, none).count() == len(odd_pairs)
    assert quality_classifier.scores(docs.limit(0), model).count() == 0


def plain_score(weights, features):
    """One bag, in plain Python: encode, gate, weigh, score."""
    w = {k: v.astype(float).tolist() for k, v in weights.items()}
    dot = lambda x, m, j: sum(a * row[j] for a, row in zip(x, m))
    squash = lambda z: 1 / (1 + math.exp(-z))
    hidden = [[math.tanh(dot(x, w["encode"], j) + w["encode_bias"][j]) for j in range(len(w["encode_bias"]))] for x in features]
    raw = [sum(math.tanh(dot(h, w["signal"], j)) * squash(dot(h, w["gate"], j)) * w["attend"][j] for j in range(len(w["attend"]))) for h in hidden]
    share = [math.exp(r - max(raw)) for r in raw]
    bag = [sum(a * h[j] for a, h in zip(share, hidden)) / sum(share) for j in range(len(hidden[0]))]
    return squash(sum(a * b for a, b in zip(bag, w["score"])) + w["bias"][0])


def test_scores_equal_a_plain_forward_pass(monkeypatch):
    rng = np.random.default_rng(4)
    model = quality_classifier.AttentionModel(hidden=6, gates=4)
    texts = [bytes(rng.integers(32, 127, n, dtype=np.uint8)) for n in (0, 5, 1024, 1025, 2048, 9000, 20000)]
    x, bags = quality_classifier.passages(texts)
    want = [plain_score(model.weights, x[a:a + n].astype(float).tolist()) for a, n in zip(np.cumsum(bags) - bags, bags)]
    assert np.allclose(model.score_texts(texts), want, atol=1e-5)
    monkeypatch.setattr(quality_classifier, "PART", 2 * quality_classifier.PASSAGE)
    assert np.allclose(model.score_texts(texts), want, atol=1e-5)
    assert model.score_texts([]).tolist() == []


def test_a_very_long_text_is_encoded_in_parts():
    model, text = quality_classifier.AttentionModel(), b"some words of prose, and some more.\n" * 700_000
    tracemalloc.start()
    score = model.score_texts([text, b"short"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert 0 <= score[0] <= 1 and peak < 4 * len(text)


def test_passages_do_not_mix():
    texts = [b"abc" * 700, b"", b"XY\n" * 10]
    together, bags = quality_classifier.passages(texts)
    assert bags.tolist() == [3, 1, 1]
    alone = np.concatenate([quality_classifier.passages([t])[0] for t in texts])
    assert np.allclose(together, alone)


# quality rules -------------------------------------------------------------------------------------------

def base_want(text):
    words, lines = re.findall(r"[^\x20\x09-\x0D]+", text), [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(zip(words, words[1:], words[2:]))
    again = {k for i, w in enumerate(zip(words, words[1:], words[2:])) if seen[w] > 1 for k in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), sum(x in lines[:k] for k, x in enumerate(lines)), len(again),
            len(words) < 50 or 100 * len(again) > 50 * len(words))


def test_rules_base_measures(documents, odd_pairs):
    got = quality_rules.verdicts(documents(odd_pairs), quality_rules.LineField()).collect()
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted([tuple(r[n] for n in names) for r in got], key=str) == sorted([(i, *base_want(t or "")) for i, t in odd_pairs], key=str)
    assert all(r.kept == (not r.base_failed) for r in got)  # a field that knows nothing calls all lines content
    assert quality_rules.verdicts(documents([]), quality_rules.LineField()).count() == 0


def test_viterbi_and_likelihood_like_brute_force():
    rng = np.random.default_rng(3)
    field = quality_rules.LineField()
    field.emit, field.bias, field.move = rng.normal(size=(quality_rules.FEATURES, 2)), rng.normal(size=2), rng.normal(size=(2, 2))
    for n in (1, 2, 5):
        x = rng.random((n, quality_rules.FEATURES))
        score = x @ field.emit + field.bias
        value = {y: sum(score[i, k] for i, k in enumerate(y)) + sum(field.move[a, b] for a, b in zip(y, y[1:]))
                 for y in itertools.product((0, 1), repeat=n)}
        assert tuple(field.decode(x).tolist()) == max(value, key=value.get)


def test_line_field_on_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.verdicts(docs, quality_rules.fit(docs, labels)).join(labels, "doc_id")
    rows = [r for r in got.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1 and not r.base_failed]
    assert np.mean([r.kept == bool(r.quality) for r in rows]) > 0.9
    assert np.mean([r.kept for r in rows if r.quality]) > 0.95


def chain_likelihood(field, x, y):
    """Log likelihood of a label sequence, by listing all sequences."""
    def value(labels):
        score = x @ field.emit + field.bias
        return sum(score[t, v] for t, v in enumerate(labels)) + sum(field.move[a, b] for a, b in zip(labels, labels[1:]))
    every = [value(v) for v in itertools.product((0, 1), repeat=len(x))]
    return value(y) - np.logaddexp.reduce(every)


def test_field_is_fitted_to_the_maximum_of_its_likelihood():
    rng = np.random.default_rng(8)
    chains = [rng.normal(0.3 * (k % 2), 1, (1 + k % 5, quality_rules.FEATURES)) for k in range(24)]
    labels, decay = [k % 2 for k in range(24)], 1e-2
    field = quality_rules.LineField().fit(chains, labels, rounds=3000, rate=0.1, decay=decay)
    n = sum(map(len, chains))

    def goal():
        fit = sum(chain_likelihood(field, x, [y] * len(x)) for x, y in zip(chains, labels)) / n
        return fit - decay / 2 * ((field.emit ** 2).sum() + (field.move ** 2).sum())

    for name in ("emit", "bias", "move"):
        weights = getattr(field, name)
        for at in np.ndindex(weights.shape):
            keep, step = weights[at], 1e-5
            weights[at] = keep + step
            high = goal()
            weights[at] = keep - step
            low = goal()
            weights[at] = keep
            assert abs(high - low) / (2 * step) < 2e-3, (name, at)
