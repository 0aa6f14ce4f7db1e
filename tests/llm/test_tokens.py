"""Codec, counts and packing against the libraries and against exact invariants."""

import base64
import collections
import hashlib
import pathlib
import random
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
from tokenizers import Tokenizer  # noqa: E402

from wardline.llm import bpe_codec, packing, token_counts, units, words  # noqa: E402

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(5)
    bits = [*"aab  \n\tcZ'sé日本🤦​\xa0 \x1c\x85½Ⅷ!!..12 ", "<|endoftext|>", "'ll", "  ", "\r\n", "aaaa", "՘", "₏", "Ᲊ"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(4000)] + ["", "ab" * 3000, "a" * 3001]


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_codec_encodes_like_the_rank_library(odd_texts, reference):
    codec = bpe_codec.Codec(RANKS, P.PATTERN)
    ids = codec.encode(odd_texts)
    assert ids == [reference.encode_ordinary(t) for t in odd_texts]
    assert [codec.decode(i) for i in ids] == [t.encode() for t in odd_texts]


def test_byte_characters_are_the_librarys():
    from tokenizers.pre_tokenizers import ByteLevel

    assert sorted(bpe_codec.byte_characters()) == sorted(ByteLevel.alphabet())


def test_codec_on_tables(documents, odd_pairs, reference):
    docs = documents(odd_pairs)
    encoded = bpe_codec.encode(docs, RANKS, P.PATTERN, offsets=True)
    rows = encoded.collect()
    assert len(rows) == len(odd_pairs) and encoded.schema["row"].dataType == docs.schema
    for r in rows:
        text = r.row.text or ""
        assert r.ids == reference.encode_ordinary(text)
        covered = "".join(text[a:b] for k, (a, b) in enumerate(zip(r.starts, r.ends)) if k == 0 or a >= r.ends[k - 1])
        assert covered == text  # tokens inside one character share its offsets
    back = bpe_codec.decode(encoded.select("ids", "row"), RANKS, P.PATTERN).collect()
    assert all(bytes(r.bytes) == (r.row.row.text or "").encode() for r in back)
    got = bpe_codec.round_trip(docs, RANKS, P.PATTERN).collect()
    ids = [reference.encode_ordinary(t or "") for _, t in odd_pairs]
    want = collections.Counter((i, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
                               for (i, t), x in zip(odd_pairs, ids))
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe_codec.round_trip(docs.limit(0), RANKS, P.PATTERN).count() == 0


def test_counts_like_the_library(odd_texts, documents, odd_pairs):
    library = Tokenizer.from_file(JSON)
    merger = token_counts.RankMerger(JSON)
    assert merger.count(odd_texts) == [len(e.ids) for e in library.encode_batch(odd_texts, add_special_tokens=False)]
    got = token_counts.token_counts(documents(odd_pairs), JSON).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in odd_pairs]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert token_counts.token_counts(documents([]), JSON).count() == 0


def test_memory_of_units_may_be_small(monkeypatch, odd_texts):
    monkeypatch.setattr(units, "REMEMBERED", 50)
    memory = units.UnitMemory(lambda texts: [len(t) for t in texts])
    for at in range(0, len(odd_texts), 100):
        part = odd_texts[at:at + 100]
        assert [sum(v) for v in memory.values(part)] == [len(t) for t in part]


def test_pieces_and_places(documents, odd_pairs):
    library = Tokenizer.from_file(JSON)
    docs = documents(odd_pairs)
    rows = packing.packed_pieces(docs, JSON, 256).collect()
    assert packing.packed_pieces(docs.limit(0), JSON).count() == 0
    at = collections.defaultdict(list)
    for r in rows:
        at[r.sequence_id].append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    want = collections.Counter()
    for i, t in odd_pairs:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) if len(ids) <= 256 else len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids) + 1, 256)]
        want.update((i, k, a, b - a, zlib.crc32(np.asarray(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert len(at) <= 1.02 * sum(r.length for r in rows) / 256 + 1


@pytest.mark.parametrize("lengths", [[], [2048] * 5, [700] * 10 + [1400], [1025] * 7, [1] * 5000, None])
def test_plan_holds_every_length(lengths):
    lengths = lengths if lengths is not None else (np.random.default_rng(1).gamma(1.2, 500, 4000).astype(int) % 2048 + 1).tolist()
    histogram = dict(collections.Counter(lengths))
    chosen = packing.plan(histogram)
    held = collections.Counter()
    for items, n in chosen:
        assert sum(items) <= 2048 and n > 0
        held.update({s: n * items.count(s) for s in set(items)})
    assert held == histogram
    count, slots = sum(n for _, n in chosen), packing.Slots(chosen)
    assert slots.sequences == count
    if len(lengths) == 4000:
        assert count <= 1.003 * -(-sum(lengths) // 2048) + 1
    if lengths:
        length = np.asarray(sorted(lengths))
        rank = np.arange(len(length)) - np.searchsorted(length, length)
        sequence, offset = slots.find(length, rank)
        places = sorted(zip(sequence.tolist(), offset.tolist(), length.tolist()))
        for (s, o, n), (s2, o2, _) in zip(places, places[1:]):
            assert o2 == o + n if s == s2 else o2 == 0


def test_words_like_the_library(monkeypatch):
    """Texts of white space, signs and letters of all sorts, with a memory that is always full."""
    monkeypatch.setattr(words, "REMEMBERED", 200)
    library, rng = Tokenizer.from_file(JSON), random.Random(5)
    mine = words.WordIds(library)
    parts = [" ", " ", " ", "\n", "\n", "\t", "\r", "\x0b", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u180e", "\u200b", "\u3000", "a", "b", "the", "é",
             "Ü", "ß", "ń", "日", "1", "²", "Ⅷ", "'s", "'t", "'", "’", ".", ",", "!", "?", "#", "|", "_", "<|endoftext|>", "<|", "💩", "ª", "word", "Word", "don't"]
    for _ in range(10):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(1000)] + ["", " ", "\n", "  a", "x " * 3000, "a\n\n"]
        want = [np.asarray(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
        assert mine.ids(texts) == want


def test_a_word_of_a_batch_is_looked_up_once():
    """Lookups follow the distinct pieces of a batch, not its words, of which a GB has some 200 million."""
    class Memory(dict):
        lookups = 0

        def __getitem__(self, key):
            if isinstance(found := super().__getitem__(key), bytes):
                Memory.lookups += 1
            return found

    library = Tokenizer.from_file(JSON)
    mine = words.WordIds(library)
    mine.young = Memory({k: Memory(v) if isinstance(v, dict) else v for k, v in mine.young.items()})
    texts = ["some word, other words.\nnext line " * 500] * 20 + ["", "", "word"] + [""] * 3
    assert mine.ids(texts) == [np.asarray(e.ids, "<u4").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert Memory.lookups < 100
    assert mine.ids([]) == [] and mine.ids(["", ""]) == [b"", b""] and mine.ids(["", "  ", ""])[1] == mine.ids(["  "])[0] != b""


def item_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [k for k, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(capacity - n)
    return len(rooms)


@pytest.mark.parametrize("low,high,count", [(1, 2048, 1500), (900, 1149, 1000), (600, 779, 1000), (1, 40, 3000), (683, 683, 301)])
def test_plan_is_no_worse_than_best_fit_and_the_bound_holds(low, high, count):
    lengths = np.random.default_rng(7).integers(low, high + 1, count).tolist()
    histogram = dict(collections.Counter(lengths))
    planned, fitted = (sum(n for _, n in packing.plan(histogram)), sum(n for _, n in packing._best_fit(histogram, 2048)))
    bound = packing.lower_bound(histogram)
    assert fitted == item_best_fit(lengths, 2048)
    assert -(-sum(lengths) // 2048) <= bound <= planned <= fitted


def test_bound_is_met_where_it_is_tight():
    assert packing.lower_bound({1025: 7}) == 7 and packing.lower_bound({683: 10}) == 5 and packing.lower_bound({}) == 0
    assert packing.lower_bound({700: 10, 1400: 1}) == 6 == sum(n for _, n in packing.plan({700: 10, 1400: 1}))


def test_identical_rows_are_numbered_by_many_tasks(documents, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_SALT", 50)
    rows = packing.packed_pieces(documents([(None, "")] * 500 + [(1, "a b c")] * 300), JSON, 16).collect()
    assert len(rows) == 800 and len({(r.sequence_id, r.offset) for r in rows}) == 800
    assert len({r.sequence_id for r in rows}) == -(-(500 + 300 * 4) // 16)


# what packing takes of a worker's memory --------------------------------------------------------------------

def test_packing_takes_little_memory_of_a_worker():
    """24 MB of words that are mostly new, beyond what a worker takes that has met one document."""
    script = """
import random, sys
import pyarrow as pa
import pyarrow.compute
sys.path.insert(0, sys.argv[1])
from wardline.llm import packing

def used():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 / 2 ** 20

rng = random.Random(4)
common = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(2000)]
def text():
    return " ".join(rng.choice(common) if rng.random() < 0.8 else f"{rng.choice(common)}{rng.choice(common)}" for _ in range(2000))

batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1800)), "text": [text() for _ in range(1800)]})
small = batch.slice(0, 1)
names = ["doc_id", "piece", "start", "length", "ids_crc32"]
run = packing._cut(sys.argv[2], 2048, bytes(4), False, names)
list(run([small]))
before, most = used(), 0.0
for _ in run([batch]):
    most = max(most, used())
print(batch.nbytes >> 20, most - before)
"""
    root = str(pathlib.Path(packing.__file__).parents[2])
    done = subprocess.run([sys.executable, "-c", script, root, JSON], capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr
    size, grown = done.stdout.split()
    assert int(size) >= 20 and float(grown) < 120, done.stdout


def test_packing_hands_the_encoder_few_texts_at_a_time_and_drops_what_others_left(monkeypatch):
    met = []

    class Encoder:
        def ids(self, texts):
            met.append(sum(map(len, texts)))
            return [b"\1\0\0\0" * 3] * len(texts)

    mine = f"packing ids {JSON}"
    units.forget()
    units.worker_store().update({"codec": "left", mine: Encoder()})
    texts = ["x" * 100_000] * 150 + ["y" * 9_000_000]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(151)), "text": texts})
    rows = [r for b in packing._cut(JSON, 2048, bytes(4), False, ["doc_id", "piece", "start", "length", "ids_crc32"])([batch]) for r in b.to_pylist()]
    assert [k for k in units.worker_store() if not k.startswith("__")] == [mine]
    units.forget()
    assert sorted(met)[-1] == 9_000_000 and sorted(met)[-2] <= 4 << 20 and sum(met) == 24_000_000
    assert [r["doc_id"] for r in rows] == list(range(151)) and {r["length"] for r in rows} == {4}
