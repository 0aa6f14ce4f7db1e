"""Operator 2, chat formatting as prefix trees.

A turn is written ``<|role|>\\n text <|end|>\\n``; in role and text each of ``< [ | \\`` is followed by a backslash,
so that no control string of this or another template survives, and undoing it is exact. Conversations are
sorted by the digests of their turns, which brings those with the same first turns together, and dealt out by
range. Each task walks its conversations in that order and holds the current path: turns shared with the
conversation before (compared in full) are not written again, new ones are appended depth first.

A tree is written in pieces of bounded size. A piece is a text and its nodes: place, parent, position id of
the first character (they count on through the segment), span under the loss mask, and the ancestor intervals
the segment attends to besides itself (touching ancestors joined). A piece that fills up, or the end of a
task's range, closes the tree, and the next piece writes the ancestors of its first conversation again; so a
first turn that a third of all conversations share is one piece's text nowhere larger than PIECE_CHARS.

``tokenized`` turns pieces into token ids. A segment's mark, text and end are encoded apart, so the loss mask, the segments and
the intervals fall between tokens, and shared turns have the same tokens in every conversation. Places, position
ids, loss spans and ancestor intervals are then counted in tokens.

Defined results: null text and null role count as empty; a null turn ranks last, ties rank by role, then text;
rows without a conv_id are one conversation; rows that repeat are turns that repeat; equal conversations share
one leaf; a conversation longer than a piece has one of its own; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe_codec import byte_characters
from .common import text_of
from .units import worker_store
from .words import WordIds

PIECE_CHARS = 1 << 16
PIECE_CONVERSATIONS = 2048
LEARNED_ROLE = "assistant"
_SPECIAL = re.compile(r"([<\[|\\])")
_ESCAPED = re.compile(r"([<\[|\\])\\")
_TURN = re.compile(r"<\|(.*?)\|>\n(.*?)<\|end\|>\n", re.S)


def escape(text: str) -> str:
    return _SPECIAL.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The segment of a turn, and where its text lies in it."""
    head, body = f"<|{escape(role)}|>\n", escape(text)
    return f"{head}{body}<|end|>\n", len(head), len(head) + len(body)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


class Piece:
    """Part of a tree in depth-first order."""

    def __init__(self):
        self.text: list[str] = []
        self.chars = 0
        self.nodes: list[dict] = []
        self.conversations: list[tuple] = []
        self.path: list[tuple[str, str, int]] = []  # role, text, node of the latest conversation

    def missing(self, turns: list[tuple[str, str]]) -> tuple[int, list]:
        """How many first turns are written already, and the segments of the others."""
        shared = 0
        for (role, text, _), turn in zip(self.path, turns):
            if (role, text) != turn:
                break
            shared += 1
        return shared, [format_turn(*t) for t in turns[shared:]]

    def add(self, conv_id, turns: list[tuple[str, str]], shared: int, segments: list) -> None:
        del self.path[shared:]
        for (role, text), (segment, low, high) in zip(turns[shared:], segments):
            parent = self.path[-1][2] if self.path else -1
            start = self.chars
            node = {"parent": parent, "start": start, "end": start + len(segment), "position": 0, "ancestors": [],
                    "loss_start": start, "loss_end": start}
            if parent >= 0:
                above = self.nodes[parent]
                node["position"] = above["position"] + above["end"] - above["start"]
                node["ancestors"] = self._joined(above)
            if role == LEARNED_ROLE:
                node["loss_start"], node["loss_end"] = start + low, start + high
            self.path.append((role, text, len(self.nodes)))
            self.nodes.append(node)
            self.text.append(segment)
            self.chars += len(segment)
        self.conversations.append((conv_id, self.path[-1][2]))

    @staticmethod
    def _joined(above: dict) -> list[dict]:
        spans = above["ancestors"]
        if spans and spans[-1]["end"] == above["start"]:
            return [*spans[:-1], {"start": spans[-1]["start"], "end": above["end"]}]
        return [*spans, {"start": above["start"], "end": above["end"]}]


def _piece_schema(conv_type: T.DataType) -> T.StructType:
    number, span = T.LongType(), T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    node = T.StructType([T.StructField("parent", T.LongType()), T.StructField("start", number), T.StructField("end", number),
                         T.StructField("position", number), T.StructField("loss_start", number), T.StructField("loss_end", number),
                         T.StructField("ancestors", T.ArrayType(span))])
    leaf = T.StructType([T.StructField("conv_id", conv_type), T.StructField("node", number)])
    return T.StructType([T.StructField("piece", number), T.StructField("text", T.StringType()),
                         T.StructField("nodes", T.ArrayType(node)), T.StructField("conversations", T.ArrayType(leaf))])


def prefix_trees(conversations: DataFrame, piece_chars: int = PIECE_CHARS, piece_conversations: int = PIECE_CONVERSATIONS) -> DataFrame:
    """Pieces of the prefix trees: ``piece, text, nodes, conversations`` (conv_id and leaf node)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = _piece_schema(conversations.schema["conv_id"].dataType)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        piece = Piece()

        def row() -> dict:
            nonlocal number, piece
            done, piece = piece, Piece()
            number += 1
            return {"piece": number - 1, "text": "".join(done.text), "nodes": done.nodes,
                    "conversations": [{"conv_id": c, "node": n} for c, n in done.conversations]}

        for batch in batches:
            for k in range(batch.num_rows):
                turns = [(t["role"], t["text"]) for t in batch.column("turns")[k].as_py()]
                shared, segments = piece.missing(turns)
                grown = piece.chars + sum(len(s[0]) for s in segments)
                if piece.conversations and (grown > piece_chars or len(piece.conversations) >= piece_conversations):
                    yield pa.RecordBatch.from_pylist([row()], schema=arrow)
                    shared, segments = piece.missing(turns)
                piece.add(batch.column("conv_id")[k].as_py(), turns, shared, segments)
        if piece.conversations:
            yield pa.RecordBatch.from_pylist([row()], schema=arrow)

    turn = F.struct(F.col("turn").isNull().alias("last"), F.col("turn"), text_of("role").alias("role"), text_of("text").alias("text"))
    whole = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    digest = "array_join(transform(turns, t -> md5(concat(length(t.role), ':', t.role, t.text))), '')"
    path = whole.select("conv_id", F.expr("transform(turns, t -> struct(t.role, t.text))").alias("turns"), F.expr(digest).alias("path"))
    return path.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id").select(
        "conv_id", "turns").mapInArrow(run, schema)


def _coder(path: str) -> tuple[WordIds, list[bytes]]:
    """Ids of texts, control strings being ordinary text, and the bytes of every id."""
    store, key = worker_store(), f"chat ids {path}"
    if key not in store:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocabulary = sorted(tokenizer.get_vocab(with_added_tokens=False).items(), key=lambda v: v[1])
        table = [b""] * (vocabulary[-1][1] + 1)
        for token, i in vocabulary:
            table[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        store[key] = WordIds(tokenizer), table
    return store[key]


def tokenized(pieces: DataFrame, tokenizer: str) -> DataFrame:
    """The pieces as tokens: ``piece, ids, nodes, conversations``; ``nodes`` counts places, positions and spans in tokens."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = {f.name: f for f in pieces.schema}
    schema = T.StructType([fields["piece"], T.StructField("ids", T.ArrayType(T.IntegerType())), fields["nodes"], fields["conversations"]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, _ = _coder(tokenizer)
        for batch in batches:
            for k in range(batch.num_rows):
                piece = batch.slice(k, 1).to_pylist()[0]
                text, nodes, ends, parts = piece["text"], [], [], []
                for n in piece["nodes"]:
                    learned = n["loss_end"] > n["loss_start"]
                    cuts = [n["start"], n["loss_start"], n["loss_end"], n["end"]] if learned else [n["start"], n["end"]]
                    parts += [text[a:b] for a, b in zip(cuts, cuts[1:])]
                    ends.append(len(parts))
                ids = coder.ids(parts)
                sizes, at, first = [len(x) // 4 for x in ids], 0, 0
                for n, last in zip(piece["nodes"], ends):
                    size = sizes[first:last]
                    node = {"parent": n["parent"], "start": at, "end": at + sum(size), "position": 0, "ancestors": [], "loss_start": at, "loss_end": at}
                    if len(size) == 3:
                        node["loss_start"], node["loss_end"] = at + size[0], at + size[0] + size[1]
                    if n["parent"] >= 0:
                        above = nodes[n["parent"]]
                        node["position"] = above["position"] + above["end"] - above["start"]
                        node["ancestors"] = Piece._joined(above)
                    nodes.append(node)
                    at, first = node["end"], last
                flat = struct.unpack(f"<{at}I", b"".join(ids))
                yield pa.RecordBatch.from_pylist([{"piece": piece["piece"], "ids": list(flat), "nodes": nodes, "conversations": piece["conversations"]}], schema=arrow)

    return pieces.mapInArrow(run, schema)


def read_back(pieces: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Each conversation parsed from the pieces: counts and digests of its turns and of its text under the loss mask.

    Pieces of tokens need the ``tokenizer`` they were made with; their ids are decoded.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _coder(tokenizer)[1] if tokenizer else None
        for batch in batches:
            for k in range(batch.num_rows):
                piece = batch.slice(k, 1).to_pylist()[0]
                nodes, out = piece["nodes"], []
                if table is None:
                    text, joined = piece["text"], "".join
                else:
                    text = [table[i] for i in piece["ids"]]
                    joined = lambda parts: b"".join(b for p in parts for b in p).decode()
                for leaf in piece["conversations"]:
                    path, at = [], leaf["node"]
                    while at >= 0:
                        path.append(nodes[at])
                        at = nodes[at]["parent"]
                    path.reverse()
                    formatted = joined(text[n["start"]:n["end"]] for n in path)
                    turns = parse(formatted)
                    loss = unescape(joined(text[n["loss_start"]:n["loss_end"]] for n in path))
                    said = "".join(f"{role}\n{body}\n" for role, body in turns)
                    out.append((leaf["conv_id"], len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
                                hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in out], batch.schema.field("conversations").type.value_type.field("conv_id").type),
                     *(pa.array([r[i] for r in out], k) for i, k in zip(range(1, 6), (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())))],
                    ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    conv = pieces.schema["conversations"].dataType.elementType["conv_id"]
    return pieces.mapInArrow(run, T.StructType([
        T.StructField("conv_id", conv.dataType), T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())]))
