"""Operator 5, byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

A rank file (token bytes and rank) becomes a tokenizers model: each byte stands as one printable character,
each token may arise from any split of its bytes into two known tokens, in rank order, which is how a
rank-driven encoder merges. Decoding maps characters back to bytes and joins them before any character
is formed, so tokens that hold only part of a character are handled.

Defined results: null text counts as empty (no ids, empty bytes); special strings are ordinary text; ids
that the vocabulary lacks raise a KeyError; a null id list decodes to empty; very long texts are encoded
whole; repeated rows stay; further columns of any name pass through ``encode`` and ``decode``.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_of
from .units import TEXT_BYTES, UnitMemory, worker_store


def byte_characters() -> list[str]:
    """The printable character for each byte: itself where it is printable, else the next free one from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    shown = {b: chr(b) for b in plain}
    free = iter(range(256, 512))
    return [shown[b] if b in shown else chr(next(free)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file each executor has at ``path``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def build_tokenizer(ranks: dict[bytes, int], pattern: str):
    """A tokenizers model that merges by rank within each match of ``pattern``."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    shown = byte_characters()
    spell = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [
        (spell[token[:i]], spell[token[i:]])
        for token in sorted(ranks, key=ranks.get) for i in range(1, len(token))
        if token[:i] in ranks and token[i:] in ranks
    ]
    made = Tokenizer(models.BPE(vocab={spell[t]: r for t, r in ranks.items()}, merges=merges))
    made.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
        pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
    ])
    return made


class Codec:
    """Encoder and decoder of one rank file; kept for the life of the Python worker."""

    def __init__(self, path: str, pattern: str):
        ranks = read_ranks(path)
        self.tokenizer = build_tokenizer(ranks, pattern)
        unshown = {c: b for b, c in enumerate(byte_characters())}
        self.bytes_of = {i: bytes(unshown[c] for c in t) for t, i in self.tokenizer.get_vocab().items()}
        self.text_ids = UnitMemory(self._ids)

    @staticmethod
    def kept(path: str, pattern: str) -> Codec:
        store, key = worker_store(), f"codec {path} {pattern}"
        if key not in store:
            store[key] = Codec(path, pattern)
        return store[key]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [[i for ids in units for i in ids] for units in self.text_ids.values(texts)]

    def encode_with_offsets(self, texts: list[str]) -> tuple[list[list[int]], list[list[tuple[int, int]]]]:
        """Ids and character offsets; a token within a character carries that character's offsets."""
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [e.ids for e in found], [e.offsets for e in found]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _nested(df: DataFrame) -> DataFrame:
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = False) -> DataFrame:
    """``row`` (all input columns), ``ids`` and, if asked for, ``starts`` and ``ends`` in characters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.kept(path, pattern)
        for part in slices(batches, size=TEXT_BYTES):
            texts = part.column("text").to_pylist()
            columns, names = [part.column("row")], ["row", "ids"]
            if offsets:
                ids, spans = codec.encode_with_offsets(texts)
                columns += [pa.array(ids, pa.list_(pa.int32()))]
                columns += [pa.array([[s[k] for s in x] for x in spans], pa.list_(pa.int32())) for k in (0, 1)]
                names += ["starts", "ends"]
            else:
                columns.append(pa.array(codec.encode(texts), pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = _nested(docs).select("row", text_of("row.text").alias("text"))
    numbers = T.ArrayType(T.IntegerType())
    schema = T.StructType([rows.schema["row"], T.StructField("ids", numbers)])
    if offsets:
        schema = schema.add("starts", numbers).add("ends", numbers)
    return rows.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``row`` (all input columns) and ``bytes`` of the id list in column ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.kept(path, pattern)
        for part in batches:
            found = [codec.decode(x or []) for x in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("row"), pa.array(found, pa.binary())], ["row", "bytes"])

    rows = _nested(encoded).select("row", "row.ids")
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("bytes", T.BinaryType())]))


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: encoded, then decoded from the ids, in one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.kept(path, pattern)
        names = {i: str(i) for i in codec.bytes_of}
        for part in slices(batches, size=TEXT_BYTES):
            counts, digests, decoded = [], [], []
            for units in codec.text_ids.values(part.column("text").to_pylist()):
                ids = [i for x in units for i in x]
                counts.append(len(ids))
                digests.append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests), pa.array(decoded)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
