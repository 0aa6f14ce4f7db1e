"""Operator 3, substring dedup by suffix automata of reference shards.

A window is ``width`` consecutive words. A word goes if a window over it occurs anywhere else. The reference of
such a search is the corpus itself and grows with it, so no automaton of it can be sent to every task.
Instead the reference is dealt into shards by content, and each shard's automaton meets just the passages
that can match in it:

* The anchor of a window is the smallest-hashed ``gram``-word group in it, a function of its words alone;
  equal windows have equal anchors. Neighbouring windows with one anchor form a region. An anchor that occurs
  once in the corpus cannot have a repeated window, and most of the text ends here.
* Regions that are equal word for word (128 bits of hash) collapse to one with a multiplicity. An anchor with
  one distinct region needs no search: the region repeats as a whole. The others are fetched as text.
* A shard is the regions of one anchor. A suffix automaton over them counts the places of every substring,
  with multiplicity; each region is streamed through it, its matching statistics are cut back to ``width``
  words, and windows that occur twice or more become maximal spans.
* An anchor with more than SHARD_REGIONS distinct regions is dealt again by window: its windows (128 bits of
  hash) are counted with multiplicity by an aggregation that combines before the shuffle, and those with two
  places are joined back to their regions. So no shard and no automaton grows with the corpus, however many
  regions share a window.

Defined results: null text has no words; texts shorter than the window keep all words; words are the runs
without ASCII blanks, unchanged; windows are judged on the input; rows that repeat (also with one doc_id, or
a null one) repeat each other's windows and each row stays; columns of any name pass through ``remove``;
empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_of, written
from .units import forget

WIDTH = 35
GRAM = 8
#: Distinct regions of one anchor that one automaton holds.
SHARD_REGIONS = 2000


# anchors -------------------------------------------------------------------------------------------------

def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def regions(counts: np.ndarray, hashes: np.ndarray, width: int, gram: int) -> list[np.ndarray]:
    """Regions of several documents laid end to end: document, first word, windows, anchor, two content hashes."""
    none = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 3
    n = len(hashes)
    if n < width:
        return none
    span = width - gram + 1
    grams = np.zeros(n - gram + 1, np.uint64)
    for j in range(gram):
        grams = grams * np.uint64(0x2545F4914F6CDD1D) + hashes[j:n - gram + 1 + j]
    grams = _mixed(grams)
    at = np.lib.stride_tricks.sliding_window_view(grams, span).argmin(axis=1)
    first = np.arange(n - width + 1)
    at = at + first
    owner = np.repeat(np.arange(len(counts)), counts)
    inside = owner[:n - width + 1] == owner[width - 1:]
    first, at = first[inside], at[inside]
    if not len(first):
        return none
    opens = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (first[1:] != first[:-1] + 1)])
    windows = np.diff(np.r_[opens, len(first)])
    start = first[opens]
    content = []
    for base in (0xD1342543DE82EF95, 0xAF251AF3B0F025B5):
        # polynomial prefix sums; a region's hash is its slice, moved to power zero
        power = _powers(base, n)
        sums = np.r_[np.uint64(0), np.add.accumulate(hashes * power[:n])]
        end = start + windows + width - 1
        inverse = _powers(pow(base, -1, 1 << 64), n)
        content.append(_mixed((sums[end] - sums[start]) * inverse[start] + windows.astype(np.uint64)))
    doc = owner[start]
    begins = np.cumsum(counts) - counts
    return [doc, start - begins[doc], windows, grams[at[opens]], *content]


def _lists(values: np.ndarray, docs: np.ndarray, n: int, kind) -> pa.ListArray:
    bounds = np.searchsorted(docs, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.astype(kind) if values.dtype != np.uint64 else values.view(np.int64)))


def _key(docs: DataFrame) -> DataFrame:
    """``row`` (all columns), text and the key of a document: doc_id and a hash of its text."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.select("row", F.struct(F.col("row.doc_id").alias("doc_id"), F.xxhash64(text_of("row.text")).alias("hash")).alias("key"),
                       F.encode(text_of("row.text"), "UTF-8").alias("text"))


def _anchored(docs: DataFrame, width: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for part in slices(batches):
            words = [t.split() for t in part.column("text").to_pylist()]
            counts = np.asarray([len(w) for w in words])
            doc, start, windows, anchor, one, two = regions(counts, word_hashes([w for ws in words for w in ws]), width, gram)
            n = len(words)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), _lists(anchor, doc, n, None), _lists(one, doc, n, None), _lists(two, doc, n, None),
                 _lists(start, doc, n, np.int32), _lists(windows, doc, n, np.int32)],
                ["key", "anchor", "one", "two", "start", "windows"])

    rows = _key(docs).select("key", "text")
    longs, ints = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    schema = T.StructType([rows.schema["key"], *(T.StructField(c, longs) for c in ("anchor", "one", "two")),
                           *(T.StructField(c, ints) for c in ("start", "windows"))])
    return rows.mapInArrow(run, schema)


# the automaton -------------------------------------------------------------------------------------------

class SuffixAutomaton:
    """Suffix automaton of several word sequences, with the number of places of each state's substrings."""

    def __init__(self, sequences: list[list[bytes]], times: list[int]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length, self.places = [-1], [0], [0]
        for words, count in zip(sequences, times):
            last = 0
            for word in words:
                last = self._extend(last, word)
                self.places[last] += count
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            self.places[self.link[state]] += self.places[state]

    def _state(self, length: int, moves: dict[bytes, int], link: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.places.append(0)
        return len(self.length) - 1

    def _split(self, state: int, target: int, word: bytes) -> int:
        """A copy of ``target`` for the substrings that ``state`` reaches by ``word``."""
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, known, word)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, target, word)
        return new

    def repeated(self, words: list[bytes], width: int) -> list[tuple[int, int]]:
        """Maximal spans of ``words`` covered by windows that have two places or more."""
        state, matched, spans = 0, 0, []
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.next[state]:
                state, matched = self.next[state][word], matched + 1
            while matched >= width and self.length[self.link[state]] >= width:
                state = self.link[state]
                matched = self.length[state]
            if matched >= width and self.places[state] > 1:
                begin = i + 1 - width
                if spans and begin <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], i + 1)
                else:
                    spans.append((begin, i + 1))
        return spans


def _shard_spans(width: int):
    """Rows (anchor, one, two, times, words) sorted by anchor to the repeated spans of each region."""
    def judge(anchor: int, held: dict[tuple, tuple]) -> list[tuple]:
        texts = {k: words.split() for k, (_, words) in held.items()}
        automaton = SuffixAutomaton(list(texts.values()), [times for times, _ in held.values()])
        return [(anchor, *k, a, b) for k, words in texts.items() for a, b in automaton.repeated(words, width)]

    def batch(found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) or [[]] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[i], pa.int64()) for i in range(3)] + [pa.array(columns[i], pa.int32()) for i in (3, 4)],
            ["anchor", "one", "two", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, {}  # a copied document may send its region twice; one is held
        for part in slices(batches, "words"):
            found = []
            for anchor, one, two, times, words in zip(*(c.to_pylist() for c in part.columns)):
                if held and last != anchor:
                    found += judge(last, held)
                    held = {}
                last = anchor
                held[one, two] = times, words
            yield batch(found)
        yield batch(judge(last, held) if held else [])
    return run


# spans of documents --------------------------------------------------------------------------------------

def _packed(rows: DataFrame, *keep: str) -> DataFrame:
    """Texts compressed before they travel."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for part in slices(batches):
            packed = pa.array([squeeze(t) for t in part.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), packed], [*keep, "packed"])

    narrow = rows.select(*keep, "text")
    return narrow.mapInArrow(run, T.StructType([*(narrow.schema[c] for c in keep), T.StructField("packed", T.BinaryType())]))


def _same_key(left: str, right: str) -> Column:
    return F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id")) & (F.col(f"{left}.hash") == F.col(f"{right}.hash"))


def _fetched(docs: DataFrame, wanted: DataFrame, width: int, cut: bool = False) -> DataFrame:
    """Words of each wanted region (key, anchor, one, two, times, start, windows); with ``cut`` the hashes of its windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = zstandard.ZstdDecompressor()
        for part in slices(batches, "packed"):
            out: list[tuple] = []
            for packed, asked in zip(part.column("packed").to_pylist(), part.column("asked").to_pylist()):
                words = opened.decompress(packed).split()
                for r in asked:
                    first, n = r["start"], r["windows"]
                    if cut:
                        text = [xxhash.xxh3_128_digest(b" ".join(words[k:k + width])) for k in range(first, first + n)]
                    else:
                        text = b" ".join(words[first:first + n + width - 1])
                    out.append((r["anchor"], r["one"], r["two"], r["times"], text))
            columns = list(zip(*out)) or [[]] * 5
            kinds = [pa.int64()] * 4 + [pa.list_(pa.binary()) if cut else pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["anchor", "one", "two", "times", "words"])

    region = F.struct("anchor", "one", "two", "times", "start", "windows")
    asked = wanted.groupBy("key").agg(F.collect_list(region).alias("asked")).alias("w")
    texts = _packed(_key(docs), "key").alias("t")
    joined = texts.join(asked, _same_key("t.key", "w.key")).select("t.packed", "w.asked")
    return joined.mapInArrow(run, f"anchor long, one long, two long, times long, words {'array<binary>' if cut else 'binary'}")


def _counted(docs: DataFrame, dealt: DataFrame, width: int) -> DataFrame:
    """Windows with two places or more as spans of their regions (dealt ones), without an automaton."""
    regions = written(_fetched(docs, dealt, width, cut=True).distinct(), "dealt-regions")  # copied documents send theirs twice
    each = regions.select("anchor", "one", "two", "times", F.posexplode("words").alias("from", "window"))
    often = each.groupBy("anchor", "window").agg(F.sum("times").alias("n")).where("n > 1").select("anchor", "window")
    often = written(often, "dealt-windows")  # else the join stands on the aggregation and cannot split a hot window
    return each.join(often, ["anchor", "window"]).select("anchor", "one", "two", "from", (F.col("from") + width).alias("to"))


def spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, shard_regions: int = SHARD_REGIONS) -> DataFrame:
    """``key`` and the list ``cut`` of word spans to remove, for each distinct document that loses words."""
    table = written(_anchored(docs, width, gram), "anchors")
    often = table.select(F.explode("anchor").alias("anchor")).groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    each = table.select("key", F.explode(F.arrays_zip("anchor", "one", "two", "start", "windows")).alias("r")).select("key", "r.*")
    places = written(each.join(often, "anchor"), "repeated-anchors")

    # grouping by a new column keeps the join free to split a hot anchor, and combines before the shuffle
    first = F.min(F.struct("key", "start"))
    distinct = (
        places.groupBy("anchor", "one", "two", "windows").agg(F.count("*").alias("times"), first.alias("at"))
        .select("anchor", "one", "two", "windows", "times", "at.key", "at.start")
    )
    distinct = written(distinct, "distinct-regions")
    shards = distinct.groupBy("anchor").agg(F.count("*").alias("regions"))
    sized = distinct.join(shards, "anchor")
    whole = sized.where("regions = 1").select(
        "anchor", "one", "two", F.lit(0).alias("from"), (F.col("windows") + (width - 1)).alias("to"))
    wanted = sized.where((F.col("regions") > 1) & (F.col("regions") <= shard_regions))
    found = _fetched(docs, wanted, width).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(
        _shard_spans(width), "anchor long, one long, two long, `from` int, `to` int")
    crowded = written(shards.where(F.col("regions") > shard_regions), "dealt-anchors")
    if not crowded.isEmpty():
        found = found.unionByName(_counted(docs, distinct.join(crowded, "anchor"), width))
    verdict = whole.unionByName(found).groupBy("anchor", "one", "two").agg(
        F.collect_set(F.struct("from", "to")).alias("spans"))
    marked = places.join(verdict, ["anchor", "one", "two"]).select("key", F.explode(F.expr(
        "transform(spans, s -> named_struct('from', start + s.`from`, 'to', start + s.`to`))")).alias("span"))
    return marked.groupBy("key").agg(F.collect_set("span").alias("cut"))


def _kept(text: bytes, cut) -> tuple[int, list[bytes]]:
    words = text.split()
    if not cut:
        return len(words), words
    out, at = [], 0
    for a, b in sorted((s["from"], s["to"]) for s in cut):
        if a > at:
            out += words[at:a]
        at = max(at, b)
    return len(words), out + words[at:]


def _with_cuts(docs: DataFrame, keep: list[str], width: int, gram: int) -> DataFrame:
    """``keep`` of key, rest (all columns but text) and void (null text), with packed text and its cuts."""
    found = written(spans(docs, width, gram), "cuts").alias("s")
    rest = F.struct(*[F.col(f"row.`{c}`") for c in docs.columns if c != "text"] or [F.lit(0)])
    rows = _key(docs).withColumns({"rest": rest, "void": F.col("row.text").isNull()})
    texts = _packed(rows, *dict.fromkeys(["key", *keep])).alias("t")
    return texts.join(found, _same_key("t.key", "s.key"), "left").select(*[f"t.{c}" for c in keep], "t.packed", "s.cut")


def digests(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = zstandard.ZstdDecompressor()
        for part in slices(batches, "packed"):
            total, gone, sha = [], [], []
            for packed, cut in zip(part.column("packed").to_pylist(), part.column("cut").to_pylist()):
                n, words = _kept(opened.decompress(packed), cut)
                total.append(n)
                gone.append(n - len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)],
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = _with_cuts(docs, ["key"], width, gram).select("key.doc_id", "packed", "cut")
    return rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], T.StructField("n_words", T.LongType()),
                                              T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]))


def remove(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """The documents, all columns, with the repeated words gone from ``text``.

    A text that loses nothing stays as it is; of another the kept words are joined by one space, and n_chars,
    where there is such a column, follows. Null texts stay null.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = zstandard.ZstdDecompressor()
        for part in slices(batches, "packed"):
            texts = []
            for packed, cut in zip(part.column("packed").to_pylist(), part.column("cut").to_pylist()):
                text = opened.decompress(packed)
                texts.append((b" ".join(_kept(text, cut)[1]) if cut else text).decode())
            yield pa.RecordBatch.from_arrays([part.column("rest"), part.column("void"), pa.array(texts, pa.string()), part.column("cut").is_valid()],
                                             ["rest", "void", "text", "changed"])

    rows = _with_cuts(docs, ["rest", "void"], width, gram)
    fields = [rows.schema["rest"], rows.schema["void"], T.StructField("text", T.StringType()), T.StructField("changed", T.BooleanType())]
    out = rows.mapInArrow(run, T.StructType(fields))
    values = {"text": F.when(~F.col("void"), F.col("text"))}
    if "n_chars" in docs.columns:
        values["n_chars"] = F.when(F.col("changed"), F.length("text")).otherwise(F.col("rest.n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[values.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
