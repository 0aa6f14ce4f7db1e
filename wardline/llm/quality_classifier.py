"""Operator 6, quality classifier by attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE bytes. Each passage becomes byte-class, class-pair and hashed
byte-trigram frequencies and the share of repeated byte groups, and is encoded by a learned layer; gated attention (tanh times sigmoid, softmax over
the bag) weighs the passages, and a logistic layer scores the weighted sum. Only documents carry labels; the
attention learns which passages speak for them. Encoder, attention and scorer are trained together by Adam.

The model is fitted on the driver from at most ``sample`` labelled documents, those with the smallest hash of
doc_id; the model is a few small arrays, whatever the input. Scoring reads every whole text once, no shuffle.

Defined results: null text counts as empty, and an empty text is one empty passage with a score of its own; a
null doc_id has no label and is not held out; labels that are null or repeat are dropped or counted once
(smallest label); without labels of both kinds every score is the share of label 1, or 1 if there is no label;
repeated rows stay; ``keep`` passes columns of any name through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, text_of
from .units import forget

PASSAGE = 1024
#: Bytes of one text that are encoded together, whole passages.
PART = 512 * PASSAGE
CLASSES = 16
TRIGRAMS = 256
#: Slots that tell whether an eight-byte group was in the passage before.
SEEN = 4096
FEATURES = CLASSES + CLASSES * CLASSES + TRIGRAMS + 1
#: Labelled documents the model is fitted on, at most.
SAMPLE = 4000


# passages ------------------------------------------------------------------------------------------------

def _byte_classes() -> np.ndarray:
    groups = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r\x0b\x0c", ".", ",", "!?",
              "#*", "$%&", "|<>", "'\"`", ":;-_/\\@", "()[]{}~^+="]
    table = np.full(256, CLASSES - 1, np.int64)  # bytes above ASCII, control characters
    for k, group in enumerate(groups):
        table[list(group.encode())] = k
    return table


def passages(texts: list[bytes], at_once: int = 1 << 20) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage, and the number of passages of each text; ``at_once`` bytes are worked on together."""
    parts, held, size = [], [], 0
    for text in texts:
        if held and size + len(text) > at_once:
            parts.append(_passages(held))
            held, size = [], 0
        held.append(text)
        size += len(text)
    parts.append(_passages(held))
    return np.concatenate([x for x, _ in parts]), np.concatenate([bags for _, bags in parts])


def _passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    table = _byte_classes()
    sizes = np.asarray([len(t) for t in texts], np.int64)
    bags = np.maximum(1, -(-sizes // PASSAGE))
    first = np.cumsum(bags) - bags
    data = np.frombuffer(b"".join(texts), np.uint8)
    begin = np.cumsum(sizes) - sizes
    within = np.arange(len(data)) - np.repeat(begin, sizes)
    passage = np.repeat(first, sizes) + within // PASSAGE
    n = int(bags.sum())
    kind = table[data]
    out = np.zeros((n, FEATURES), np.float32)
    out[:, :CLASSES] = np.bincount(passage * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
    pair = passage[1:] == passage[:-1]
    code = (passage[:-1] * CLASSES + kind[:-1]) * CLASSES + kind[1:]
    width = CLASSES * CLASSES
    out[:, CLASSES:CLASSES + width] = np.bincount(code[pair], minlength=n * width).reshape(n, width)
    three = passage[2:] == passage[:-2]
    wide = data.astype(np.uint32)
    mixed = ((wide[:-2] * 0x9E3779B1 + wide[1:-1] * 0x85EBCA77 + wide[2:] * 0xC2B2AE3D) & 0xFFFFFFFF) >> 24
    code = passage[:-2] * TRIGRAMS + mixed.astype(np.int64)
    out[:, CLASSES + width:-1] = np.bincount(code[three], minlength=n * TRIGRAMS).reshape(n, TRIGRAMS)
    lengths = np.maximum(out[:, :CLASSES].sum(axis=1, keepdims=True), 1)
    out = np.sqrt(out / lengths)
    if len(data) > 8:
        eight = passage[7:] == passage[:-7]
        group = np.zeros(len(data) - 7, np.uint64)
        for k in range(8):
            group = group * np.uint64(0x9E3779B97F4A7C15) + wide[k:len(data) - 7 + k]
        seen = np.zeros(n * SEEN, bool)
        seen[passage[:-7][eight] * SEEN + (group[eight] >> np.uint64(52)).astype(np.int64)] = True
        groups = np.bincount(passage[:-7][eight], minlength=n)
        out[:, -1] = 4 * (1 - seen.reshape(n, SEEN).sum(axis=1) / np.maximum(groups, 1)) * (groups > 0)
    return out, bags


# the model -----------------------------------------------------------------------------------------------

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class AttentionModel:
    """Gated-attention bag classifier; ``share`` alone scores when there was nothing to learn."""

    def __init__(self, hidden: int = 24, gates: int = 12, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.share = None
        self.weights = {
            "encode": rng.normal(0, 1 / np.sqrt(8), (FEATURES, hidden)), "encode_bias": np.zeros(hidden),
            "signal": rng.normal(0, 1 / np.sqrt(hidden), (hidden, gates)), "gate": rng.normal(0, 1 / np.sqrt(hidden), (hidden, gates)),
            "attend": rng.normal(0, 1 / np.sqrt(gates), gates), "score": rng.normal(0, 1 / np.sqrt(hidden), hidden), "bias": np.zeros(1),
        }
        self.weights = {k: v.astype(np.float32) for k, v in self.weights.items()}

    def _encoded(self, x: np.ndarray) -> dict:
        """Encodings of passages and their raw attention."""
        w = self.weights
        h = np.tanh(x @ w["encode"] + w["encode_bias"])
        signal, gate = np.tanh(h @ w["signal"]), _sigmoid(h @ w["gate"])
        return {"h": h, "signal": signal, "gate": gate, "raw": (signal * gate) @ w["attend"]}

    def _forward(self, x: np.ndarray, bags: np.ndarray) -> dict:
        w, first, owner = self.weights, np.cumsum(bags) - bags, np.repeat(np.arange(len(bags)), bags)
        h, signal, gate, raw = self._encoded(x).values()
        raw = np.exp(raw - np.maximum.reduceat(raw, first)[owner])
        attention = raw / np.add.reduceat(raw, first)[owner]
        bag = np.add.reduceat(h * attention[:, None], first, axis=0)
        return {"h": h, "signal": signal, "gate": gate, "attention": attention, "bag": bag, "owner": owner, "first": first,
                "p": _sigmoid(bag @ w["score"] + w["bias"])}

    def scores(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(bags), self.share)
        return self._forward(x, bags)["p"]

    def score_texts(self, texts: list[bytes]) -> np.ndarray:
        """Scores of texts of any length; a longer one is encoded in parts, of which only encodings and weights are kept."""
        long = [k for k, t in enumerate(texts) if len(t) > PART]
        out = np.zeros(len(texts))
        short = [t if len(t) <= PART else b"" for t in texts]
        if texts:
            out[:] = self.scores(*passages(short))
        for k in long if self.share is None else ():
            top, weight, total = -np.inf, 0.0, 0.0
            for at in range(0, len(texts[k]), PART):  # whole passages, so the parts' features are the text's
                f = self._encoded(passages([texts[k][at:at + PART]])[0])
                high = max(top, float(f["raw"].max()))
                share, fade = np.exp(f["raw"] - high), np.exp(top - high)
                weight, total, top = weight * fade + share.sum(), total * fade + share @ f["h"], high
            out[k] = _sigmoid((total / weight) @ self.weights["score"] + self.weights["bias"])[0]
        return out

    def _gradients(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray, decay: float) -> dict[str, np.ndarray]:
        w, f = self.weights, self._forward(x, bags)
        d = (f["p"] - y) / len(y)
        d_bag = d[:, None] * w["score"]
        towards = (f["h"] * d_bag[f["owner"]]).sum(axis=1)
        mean = np.add.reduceat(towards * f["attention"], f["first"])
        d_raw = f["attention"] * (towards - mean[f["owner"]])
        d_mix = d_raw[:, None] * w["attend"]
        d_signal = d_mix * f["gate"] * (1 - f["signal"] ** 2)
        d_gate = d_mix * f["signal"] * f["gate"] * (1 - f["gate"])
        d_h = d_bag[f["owner"]] * f["attention"][:, None] + d_signal @ w["signal"].T + d_gate @ w["gate"].T
        d_in = d_h * (1 - f["h"] ** 2)
        found = {"encode": x.T @ d_in, "encode_bias": d_in.sum(axis=0), "signal": f["h"].T @ d_signal, "gate": f["h"].T @ d_gate,
                 "attend": (f["signal"] * f["gate"]).T @ d_raw, "score": f["bag"].T @ d, "bias": np.asarray([d.sum()])}
        return {k: g + decay * w[k] * (k != "bias") for k, g in found.items()}

    def fit(self, x: np.ndarray, bags: np.ndarray, y: np.ndarray, epochs: int = 25, batch: int = 128, rate: float = 0.01,
            decay: float = 1e-4, seed: int = 11) -> AttentionModel:
        if len(set(y.tolist())) < 2:
            self.share = float(y.mean()) if len(y) else 1.0
            return self
        rng, first = np.random.default_rng(seed), np.cumsum(bags) - bags
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(bags))
            for at in range(0, len(order), batch):
                pick = order[at:at + batch]
                rows = np.concatenate([np.arange(first[i], first[i] + bags[i]) for i in pick])
                step += 1
                for k, g in self._gradients(x[rows], bags[pick], y[pick], decay).items():
                    mean[k] += 0.1 * (g - mean[k])
                    square[k] += 0.001 * (g * g - square[k])
                    fall = rate * (1 - epoch / epochs)
                    self.weights[k] -= fall * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


# on tables -----------------------------------------------------------------------------------------------

def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AttentionModel:
    """A model from at most ``sample`` labelled documents outside the held-out third."""
    known = labels.where(~held_out()).where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = (
        docs.select("doc_id", text_of().alias("text")).join(chosen, "doc_id").groupBy("doc_id")
        .agg(F.min(F.struct("text", "quality")).alias("r")).select("doc_id", "r.*").orderBy("doc_id").collect()
    )
    x, bags = passages([r.text.encode() for r in rows])
    return AttentionModel().fit(x, bags, np.asarray([float(r.quality) for r in rows]))


def _scored(rows: DataFrame, model: AttentionModel) -> DataFrame:
    """``row``, ``text`` and ``score`` for rows of (row, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for part in slices(batches):
            scored = pa.array(model.score_texts([t.encode() for t in part.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([part.column("row"), part.column("text"), scored], ["row", "text", "score"])

    fields = [rows.schema["row"], T.StructField("text", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(run, T.StructType(fields))


def scores(docs: DataFrame, model: AttentionModel) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for part in slices(batches):
            scored = pa.array(model.score_texts([t.encode() for t in part.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), scored], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: AttentionModel, threshold: float = 0.5) -> DataFrame:
    """The documents that score ``threshold`` or more, with all columns; texts go through Python once."""
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    rows = docs.select(F.struct(rest.alias("rest"), F.col("text").isNull().alias("void")).alias("row"), text_of().alias("text"))
    kept = _scored(rows, model).where(F.col("score") >= threshold)
    text = F.when(~F.col("row.void"), F.col("text")).cast(docs.schema["text"].dataType)
    return kept.select(*[(text if c == "text" else F.col(f"row.rest.`{c}`")).alias(c) for c in docs.columns])
