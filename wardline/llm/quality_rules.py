"""Operator 8, quality rules by line sequence labelling.

The base measures are counts over the whole text. The verdict comes from a linear-chain conditional random
field over the lines that have a word: each line is described by a few bounded measures, the chain by the
change between neighbours, and Viterbi decoding marks every line content or boilerplate. A document that
passes the base rules stays if content lines hold at least half of its words.

The field is trained here, on the driver, by gradient ascent on the likelihood of at most ``sample`` labelled
documents (smallest hash of doc_id, outside the held-out third of the quality classifier); the label of a
document stands for each of its lines. The field is a few dozen numbers. Scoring is one pass without shuffle;
a long text is decoded whole, its lines as arrays.

Defined results: null text has no words; documents without words fail the base rules (fewer than 50 words);
ties in Viterbi go to content; without labels of both kinds every line is content; a null doc_id is scored and
never learned from; repeated rows stay; columns besides doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, text_of
from .quality_classifier import held_out

MIN_WORDS = 50
REPEAT_PERCENT = 50
CONTENT_SHARE = 0.5
SAMPLE = 3000
_SYMBOLS = re.compile(r"[#*$%&|<>]")
#: Character groups that the line measures count.
GROUPS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "symbol": b"#*$%&|<>", "stop": b".", "comma": b",",
    "shout": b"!?", "path": b":;/\\_@=", "bracket": b"()[]{}",
}
FEATURES = 2 * len(GROUPS) + 5
CONTENT, BOILERPLATE = 0, 1


# measures ------------------------------------------------------------------------------------------------

def _codes(words: list[bytes]) -> tuple[np.ndarray, int]:
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)), len(seen)


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text has twice or more."""
    n = len(words)
    if n < 4:
        return 0
    code, size = _codes(words)
    pair = np.unique(code[:-1] * size + code[1:], return_inverse=True)[1].reshape(-1)
    window = pair[:-1] * size + code[2:]
    _, place, count = np.unique(window, return_inverse=True, return_counts=True)
    twice = count[place.reshape(-1)] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= twice
    return int(covered.sum())


def line_measures(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of lines that have a word, and their numbers of words."""
    words = [line.split() for line in lines]
    counts = np.asarray([len(w) for w in words], np.float64)
    sizes = np.asarray([max(1, sum(map(len, w))) for w in words], np.float64)
    distinct = np.asarray([len(set(w)) for w in words], np.float64)
    table = np.zeros((256, len(GROUPS)))
    for k, group in enumerate(GROUPS.values()):
        table[list(group), k] = 1
    data = np.frombuffer(b"".join(lines), np.uint8)
    lengths = np.asarray([len(line) for line in lines])
    sums = np.zeros((len(lines), len(GROUPS)))
    starts = np.cumsum(lengths) - lengths
    for k in range(len(GROUPS)):
        sums[:, k] = np.add.reduceat(table[data, k], starts)
    share = sums / sizes[:, None]
    seen: dict[bytes, int] = {}
    again = np.asarray([seen.setdefault(line, i) != i for i, line in enumerate(lines)], np.float64)
    return np.column_stack([np.sqrt(share), share > 0.1, 1 - distinct / counts, np.minimum(counts, 40) / 40, counts < 4,
                            np.minimum(sizes / counts, 20) / 20, again]).astype(np.float64), counts


# the field -----------------------------------------------------------------------------------------------

class LineField:
    """Linear-chain conditional random field with two labels."""

    def __init__(self):
        self.emit, self.bias = np.zeros((FEATURES, 2)), np.zeros(2)
        self.move = np.zeros((2, 2))

    def fit(self, chains: list[np.ndarray], labels: list[int], rounds: int = 150, rate: float = 0.3, decay: float = 1e-4) -> LineField:
        """Maximum likelihood; all chains advance together, padded to the longest."""
        if len(set(labels)) < 2:
            return self
        chains, labels = zip(*sorted(zip(chains, labels), key=lambda c: -len(c[0])))
        sizes = np.asarray([len(c) for c in chains])
        x = np.concatenate(chains)
        y = np.repeat(labels, sizes)
        first = np.cumsum(sizes) - sizes
        alive = [int((sizes > t).sum()) for t in range(sizes[0])]
        rows = [first[:n] + t for t, n in enumerate(alive)]
        target = np.zeros((len(x), 2))
        target[np.arange(len(x)), y] = 1
        stays = np.asarray([[sum(s - 1 for s, v in zip(sizes, labels) if v == 0), 0], [0, sum(s - 1 for s, v in zip(sizes, labels) if v == 1)]], float)
        second = {"emit": np.zeros_like(self.emit), "bias": np.zeros(2), "move": np.zeros((2, 2))}
        for _ in range(rounds):
            score = x @ self.emit + self.bias
            ahead, back = np.zeros_like(score), np.zeros_like(score)
            for t, at in enumerate(rows):
                ahead[at] = score[at]
                if t:
                    before = ahead[at - 1][:, :, None] + self.move
                    ahead[at] += np.logaddexp(before[:, 0], before[:, 1])
            for t in range(len(rows) - 1, 0, -1):
                at = rows[t]
                after = self.move + (score[at] + back[at])[:, None, :]
                back[at - 1] = np.logaddexp(after[:, :, 0], after[:, :, 1])
            total = ahead + back
            norm = np.logaddexp(total[:, 0], total[:, 1])
            node = np.exp(total - norm[:, None])
            inner = np.ones(len(x), bool)
            inner[first] = False
            at = np.flatnonzero(inner)
            edge = np.exp(ahead[at - 1][:, :, None] + self.move + (score[at] + back[at])[:, None, :] - norm[at][:, None, None])
            steps = {"emit": x.T @ (target - node) / len(x) - decay * self.emit, "bias": (target - node).mean(axis=0),
                     "move": (stays - edge.sum(axis=0)) / len(x) - decay * self.move}
            for name, g in steps.items():
                second[name] += g * g
                setattr(self, name, getattr(self, name) + rate * g / (np.sqrt(second[name]) + 1e-8))
        return self

    def decode(self, x: np.ndarray) -> np.ndarray:
        """Best labels of a chain; ties go to content."""
        score = x @ self.emit + self.bias
        if not score.any() and not self.move.any():
            return np.zeros(len(x), np.int64)
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = 0.0, 0.0
        back = []
        for i, (s0, s1) in enumerate(score.tolist()):
            if i:
                from0, from1 = a + m00 < b + m10, a + m01 < b + m11
                a, b = (b + m10 if from0 else a + m00) + s0, (b + m11 if from1 else a + m01) + s1
                back.append((from0, from1))
            else:
                a, b = s0, s1
        out = np.zeros(len(x), np.int64)
        label = int(b > a)
        for i in range(len(x) - 1, -1, -1):
            out[i] = label
            if i:
                label = int(back[i - 1][label])
        return out


def worded_lines(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.strip()]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> LineField:
    """A field from at most ``sample`` labelled documents outside the held-out third."""
    known = labels.where(~held_out()).where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = (
        docs.select("doc_id", text_of().alias("text")).join(chosen, "doc_id").groupBy("doc_id")
        .agg(F.min(F.struct("text", "quality")).alias("r")).select("doc_id", "r.*").orderBy("doc_id").collect()
    )
    chains, kinds = [], []
    for r in rows:
        if lines := worded_lines(r.text.encode()):
            chains.append(line_measures(lines)[0])
            kinds.append(CONTENT if r.quality else BOILERPLATE)
    return LineField().fit(chains, kinds)


def judge(text: bytes, field: LineField) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept."""
    words = text.split()
    n = len(words)
    chars = len(b"".join(words).decode())
    lines = worded_lines(text)
    repeats = repeat_words(words)
    failed = n < MIN_WORDS or 100 * repeats > REPEAT_PERCENT * n
    share = 1.0
    if lines:
        x, counts = line_measures(lines)
        share = float(counts[field.decode(x) == CONTENT].sum() / counts.sum())
    return (n, chars, len(_SYMBOLS.findall(text.decode())), len(lines) - len(set(lines)), repeats, failed, share,
            not failed and share >= CONTENT_SHARE)


def verdicts(docs: DataFrame, field: LineField) -> DataFrame:
    """Measures and verdict of every document."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = list(zip(*(judge(t, field) for t in part.column("text").to_pylist())))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(found, kinds))], ["doc_id", *names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"{n} {'boolean' if k == pa.bool_() else 'double' if k == pa.float64() else 'long'}" for n, k in zip(names, kinds))
    return docs.select("doc_id", F.encode(text_of(), "UTF-8").alias("text")).mapInArrow(run, f"doc_id {kind}, {columns}")
