"""Operator 12, language identification by hierarchical discrimination.

First the family of a text's language is predicted by a softmax layer over all families. Within the family every two
languages have a linear support vector machine of their own (squared hinge, dual coordinate descent); the language
that wins most of these duels is the prediction, the sum of its margins and then the name settling ties. Texts are
profiles of byte n-grams: 1 to 4 bytes, ASCII letters in lower case, other ASCII as blanks; each order hashed to
a bounded number of places and scaled to length one.

The models are fitted on the driver from the profiles (not the texts) of at most ``sample`` distinct texts for each of
the ``languages`` most frequent languages, those with the smallest hash of the text. What a fit moves is bounded by
these two, whatever the input. Prediction reads every whole text once, without a shuffle; a long text is profiled
in parts, and few texts are held as profiles at once.

FAMILIES names the family of common language codes; a code it lacks is a family of its own.

Defined results: null text, or text without a letter (Unicode category L), is ``und`` with score 0; so is every text
when there was nothing to learn from. With one language learned the others are that one. A null doc_id is not held out; null
languages teach nothing, '' is a language like any other; repeated texts of a language teach once, every row is predicted; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, text_of

#: Distinct texts per language the models are fitted on, and languages that are learned, at most.
SAMPLE, LANGUAGES = 400, 200
UNKNOWN = "und"
#: Places for the n-grams of each length.
PLACES = (256, 1024, 2048, 2048)
FEATURES = sum(PLACES)
#: Texts held as profiles at once, and bytes of a text that are profiled together.
TEXTS, PART = 256, 1 << 20

# fixed values: language families by ISO 639-1 code
FAMILIES = {code: family for family, codes in {
    "germanic": "en de nl sv da no nb nn is fo fy lb af yi",
    "romance": "fr es it pt ro ca gl oc la co",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "indic": "hi ur bn pa gu mr ne si as or",
    "iranian": "fa ps ku tg",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt ug",
    "semitic": "ar he mt am",
    "dravidian": "ta te kn ml",
    "malayic": "id ms jv su tl",
}.items() for code in codes.split()}


def family_of(lang: str) -> str:
    """Family of a language code; the code itself where it is not listed."""
    return FAMILIES.get(re.split("[-_]", lang.lower())[0], f"only {lang}")


# profiles ------------------------------------------------------------------------------------------------

_FOLD = bytes(c if c > 127 else ord(chr(c).lower()) if chr(c).isalpha() else 32 for c in range(256))
_MULTIPLIERS = np.asarray([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def _add(counts: np.ndarray, texts: list[bytes], first: int) -> None:
    """Add the n-grams of the texts to rows first, first + 1, ... of the counts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    wide, mixed, at = data.astype(np.uint32), np.zeros(len(data), np.uint32), 0
    for n, places in enumerate(PLACES):
        size = len(data) - n
        if size <= 0:
            break
        if n:
            mixed = mixed[:size] + wide[n:] * _MULTIPLIERS[n]
            place = (mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - places.bit_length() + 1)
        else:
            mixed = wide * _MULTIPLIERS[0]
            place = wide
        code = owner[:size] * places + place
        code = code[owner[n:] == owner[:size]]
        counts[first:first + len(texts), at:at + places] += np.bincount(code, minlength=len(texts) * places).reshape(-1, places)
        at += places


def profiles(texts: list[bytes]) -> np.ndarray:
    """One row per text: roots of n-gram shares, each length scaled to one."""
    counts = np.zeros((len(texts), FEATURES), np.float32)
    held: list[bytes] = []
    size = start = 0
    for k, text in enumerate(texts):
        if held and size + len(text) > PART:
            _add(counts, held, start)
            held, size = [], 0
        if not held:
            start = k
        if len(text) > PART:  # alone, in parts that overlap by the longest n-gram but one byte
            for at in range(0, len(text), PART):
                part, again = text[max(0, at - len(PLACES) + 1):at + PART].translate(_FOLD), min(at, len(PLACES) - 1)
                _add(counts, [part], k)
                if again:
                    once = np.zeros((1, FEATURES), np.float32)
                    _add(once, [part[:again]], 0)
                    counts[k] -= once[0]
        else:
            held.append(text.translate(_FOLD))
            size += len(text)
    if held:
        _add(counts, held, start)
    at = 0
    for places in PLACES:
        block = counts[:, at:at + places]
        block /= np.maximum(block.sum(axis=1, keepdims=True), 1)
        at += places
    return np.sqrt(counts, out=counts)


_LETTERLIKE = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTERLIKE.finditer(text))


# models --------------------------------------------------------------------------------------------------

def fit_softmax(x: np.ndarray, y: np.ndarray, kinds: int, steps: int = 200, rate: float = 0.3, decay: float = 1e-4) -> np.ndarray:
    """Weights (features + 1, kinds) of a softmax layer whose kinds count alike, by Adam over all rows."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    weight = (1 / np.bincount(y, minlength=kinds)[y] / kinds).astype(np.float32)
    w = np.zeros((x.shape[1], kinds), np.float32)
    mean, square = np.zeros_like(w), np.zeros_like(w)
    truth = np.eye(kinds, dtype=np.float32)[y]
    for step in range(1, steps + 1):
        gradient = x.T @ ((_softmax(x @ w) - truth) * weight[:, None]) + decay * w
        mean += 0.1 * (gradient - mean)
        square += 0.01 * (gradient * gradient - square)
        w -= rate * (1 - step / (steps + 1)) * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return w


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_svm(x: np.ndarray, sign: np.ndarray, cost: float = 1.0, epochs: int = 30, seed: int = 5) -> np.ndarray:
    """Weights (features + 1) of a linear machine with squared hinge, by dual coordinate descent.

    The primal is |w|^2 / 2 + cost * sum of max(0, 1 - sign (w . x))^2; the bias is the weight of a constant.
    """
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    own, rng = 1 / (2 * cost), np.random.default_rng(seed)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1], np.float32)
    curve = np.einsum("ij,ij->i", x, x) + own
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(len(x)):
            slope = sign[i] * float(x[i] @ w) - 1 + own * alpha[i]
            step = max(alpha[i] - slope / curve[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += np.float32(step * sign[i]) * x[i]
                most = max(most, abs(step))
        if most < 1e-4:
            break
    return w


class LanguageModel:
    """Family layer and, per family, the duels of its languages."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families = sorted({family_of(c) for c in self.langs})
        home = np.asarray([self.families.index(family_of(c)) for c in self.langs], np.int64)
        y = np.asarray([self.langs.index(c) for c in langs], np.int64)
        self.family_weights = fit_softmax(x, home[y], len(self.families)) if len(self.families) > 1 else None
        self.members = [np.flatnonzero(home == f) for f in range(len(self.families))]
        self.duels: dict[tuple[int, int], np.ndarray] = {}
        for members in self.members:
            for a, b in combinations(members.tolist(), 2):
                rows = np.flatnonzero((y == a) | (y == b))
                self.duels[a, b] = fit_svm(x[rows], np.where(y[rows] == a, 1.0, -1.0))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of languages, and scores: the family's probability times the mean chance of the winner's duels."""
        best, score = np.zeros(len(x), np.int64), np.ones(len(x))
        family = np.zeros(len(x), np.int64)
        if self.family_weights is not None:
            chance = _softmax(x @ self.family_weights[:-1] + self.family_weights[-1])
            family = chance.argmax(axis=1)
            score = chance.max(axis=1).astype(np.float64)
        for f, members in enumerate(self.members):
            rows = np.flatnonzero(family == f)
            if not len(rows):
                continue
            wins, margins, chances = (np.zeros((len(rows), len(members))) for _ in range(3))
            for i, j in combinations(range(len(members)), 2):
                w = self.duels[int(members[i]), int(members[j])]
                margin = (x[rows] @ w[:-1] + w[-1]).astype(np.float64)
                p = 1 / (1 + np.exp(-np.clip(3 * margin, -30, 30)))
                for side, sign in ((i, 1), (j, -1)):
                    wins[:, side] += (margin >= 0) if sign > 0 else (margin < 0)
                    margins[:, side] += sign * margin
                    chances[:, side] += p if sign > 0 else 1 - p
            order = np.lexsort((-margins, -wins), axis=1)[:, 0]
            best[rows] = members[order]
            if len(members) > 1:
                score[rows] *= chances[np.arange(len(rows)), order] / (len(members) - 1)
        return best, np.clip(score, 0, 1)


# on tables -----------------------------------------------------------------------------------------------

def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES) -> LanguageModel | None:
    """A model from documents that are not held out; None if there are none with a language and a letter."""
    taught = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
    counts = taught.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return None
    # a threshold on the hash leaves a few times the sample; the smallest hashes are then counted off
    parts = 1 << 30
    bound = F.create_map(*[F.lit(v) for r in counts for v in (r.lang, -(-parts * min(r["count"], 4 * sample) // r["count"]))])
    few = taught.select("lang", "text", F.xxhash64("text").alias("h")).where(F.pmod("h", F.lit(parts)) < F.element_at(bound, F.col("lang")))
    once = few.groupBy("lang", "h").agg(F.min("text").alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(parts)), "h"))
    chosen = once.withColumn("nth", nth).where(F.col("nth") <= sample).select("lang", "h", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _small(batches):
            texts = part.column("text").to_pylist()
            keep = pa.array([has_letter(t) for t in texts], pa.bool_())
            rows = profiles([t.encode() for t in texts]).astype("<f2")
            packed = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("h"), packed], ["lang", "h", "x"]).filter(keep)

    found = sorted(chosen.mapInArrow(run, "lang string, h long, x binary").collect(), key=lambda r: (r.lang, r.h))
    if not found:
        return None
    x = np.frombuffer(b"".join(r.x for r in found), "<f2").reshape(-1, FEATURES).astype(np.float32)
    return LanguageModel(x, [r.lang for r in found])


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few bytes and at most TEXTS rows."""
    for part in slices(batches):
        for at in range(0, part.num_rows, TEXTS):
            yield part.slice(at, TEXTS)


def identify(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _small(batches):
            texts = part.column("text").to_pylist()
            known = np.asarray([model is not None and has_letter(t) for t in texts], bool)
            names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if known.any():
                best, score = model.predict(profiles([t.encode() for t, k in zip(texts, known) if k]))
                names[known], scores[known] = np.asarray(model.langs, object)[best], score
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
