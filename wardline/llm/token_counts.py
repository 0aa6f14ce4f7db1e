"""Operator 9, token counts by rank-synchronous array merging.

Pre-tokens of a batch lie end to end in numpy arrays of symbols (ragged: a sequence number per symbol). Each
round finds every sequence's lowest-rank pair, applies it at all its places in that sequence at once, and
retires sequences without a pair left; what survives is counted. Distinct units are merged once per worker.

Defined results: null text counts as empty (0 tokens); special strings found in a text count as one token
each, the library's default; very long texts and very long pre-tokens are merged whole; repeated rows stay;
columns besides doc_id and text are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from .bpe_codec import byte_characters
from .common import slices, text_of
from .units import TEXT_BYTES, UnitMemory, worker_store

#: Fixed value: the byte-level pre-tokenizer's own split pattern.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class RankMerger:
    """Counts tokens of strings from a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.size = len(vocab)
        self.symbol = np.asarray([vocab[c] for c in byte_characters()], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.asarray([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order
        self.made = np.asarray([vocab[a + b] for a, b in pairs], np.int64)
        self.split = regex.compile(SPLIT)
        self.splitter = ByteLevel(add_prefix_space=False, use_regex=True)
        self.specials = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
        self.unit_counts = UnitMemory(self.count_strings, tuple(self.specials))

    @staticmethod
    def kept(path: str) -> RankMerger:
        store, key = worker_store(), f"merger {path}"
        if key not in store:
            store[key] = RankMerger(path)
        return store[key]

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], len(self.keys))

    def merge(self, words: list[bytes]) -> np.ndarray:
        """Symbols that survive in each pre-token."""
        counts = np.zeros(len(words), np.int64)
        lengths = np.asarray([len(w) for w in words], np.int64)
        symbols = self.symbol[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        none = len(self.keys)
        while len(symbols):
            rank = np.full(len(symbols), none)
            inside = owner[:-1] == owner[1:]
            rank[:-1][inside] = self._ranks(symbols[:-1][inside], symbols[1:][inside])
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[first, len(symbols)])
            low = np.minimum.reduceat(rank, first)
            done = low == none
            counts[owner[first[done]]] = sizes[done]
            hit = (rank == np.repeat(low, sizes)) & (rank != none)
            at = np.flatnonzero(hit)
            # in a run of touching places (the pair is one symbol twice) every second one merges
            opens = np.r_[True, at[1:] != at[:-1] + 1] if len(at) else np.zeros(0, bool)
            run = np.flatnonzero(opens)
            within = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[within % 2 == 0]
            symbols[at] = self.made[rank[at]]
            stay = ~np.repeat(done, sizes)
            stay[at + 1] = False
            symbols, owner = symbols[stay], owner[stay]
        return counts

    def _plain(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and its number of special tokens."""
        parts, found = [text], 0
        for s in self.specials:
            cut = [p for part in parts for p in part.split(s)]
            found += len(cut) - len(parts)
            parts = cut
        return [w for p in parts for w in self._cut(p)], found

    def _cut(self, text: str) -> list[str]:
        """Pre-tokens; beyond Latin letters the library's own splitter knows which characters are letters to it."""
        if text.isascii() or max(text) < "\u0250":
            return self.split.findall(text)
        return [text[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(text)]

    def count_strings(self, texts: list[str]) -> list[int]:
        split = [self._plain(t) for t in texts]
        words = list({w for ws, _ in split for w in ws})
        size = dict(zip(words, self.merge([w.encode() for w in words]).tolist()))
        return [found + sum(map(size.__getitem__, ws)) for ws, found in split]

    def count(self, texts: list[str]) -> list[int]:
        return [sum(x) for x in self.unit_counts.values(texts)]


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = RankMerger.kept(path)
        for part in slices(batches, size=TEXT_BYTES):
            n = np.asarray(merger.count(part.column("text").to_pylist()), np.int64)
            size = pa.compute.binary_length(part.column("text")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), size, pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
