"""Ids of texts by a byte-level BPE tokenizer, word by word, with a memory of words.

The pre-tokenizer of such a vocabulary takes white space only at the front of a pre-token. So it also cuts before any
blank or line end, unless that stands between two other white characters, or after one at the end of the text. Texts
without such a place are cut there, and the pieces are looked up; the others, and texts that hold a special
string, are encoded whole. A piece of letters and closing signs is put together from its word and its signs, and a new
word, which is one pre-token, goes straight to the tokenizer's model. Cutting, telling pieces apart and joining their ids
run over whole batches in numpy and Arrow, so Python handles each distinct piece of a batch once.
"""

from __future__ import annotations

import gc
import re
import struct

import numpy as np
import pyarrow as pa

from .bpe_codec import byte_characters

#: Entries of the younger half of a memory; when it is full, it becomes the older half. Results do not depend on it.
REMEMBERED = 150_000
#: Pieces longer than this are not remembered.
LONG_PIECE = 100
_ODD = "\u180E\u200B\u2060\uFEFF"  # white space to some Unicode versions only
#: A blank or line end where a text cannot be cut.
_INSIDE = re.compile(rf"[\s{_ODD}][ \n](?:[\s{_ODD}]|\Z)")
#: By byte: may be white space or a part of it.
_WHITE = np.asarray([b >= 128 or chr(b).isspace() for b in range(256)])
_LETTERS = r"[A-Za-zÀ-ÖØ-öø-ɏ]+"
#: A word with the blank or line end before it, and the signs that close it.
_CLOSED = re.compile(rf"([ \n]?{_LETTERS})([.,;:!?]*)").fullmatch


def _flat(array: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Where each text begins, and the bytes of all texts end to end."""
    rows = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1)
    return rows, np.frombuffer(array.buffers()[2] or b"", np.uint8)[:rows[-1]]


class WordIds:
    """Ids (little-endian 32-bit integers) of texts; ``tokenizer`` cuts as the module says."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        self.shown = dict(enumerate(byte_characters()))
        self.packed = [struct.pack("<I", i) for i in range(tokenizer.get_vocab_size())]
        self.specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _encoded(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _new_words(self, words: set[str]) -> dict[str, bytes]:
        """Ids of words: a blank belongs to the word's pre-token, a line end is one of its own."""
        tokens, packed, shown, blank, found = self.tokenizer.model.tokenize, self.packed, self.shown, self.shown[32], {}
        end = self._encoded(["\n"])[0]
        for w in words:
            after = w[0] == "\n"
            plain = w[1:] if after else w
            if plain.isascii():
                characters = blank + plain[1:] if plain[0] == " " else plain
            else:
                characters = plain.encode().decode("latin-1").translate(shown)
            ids = b"".join([packed[t.id] for t in tokens(characters)])
            found[w] = end + ids if after else ids
        return found

    def _learn(self, pieces: set[str]) -> None:
        """Make the young memory hold all ``pieces``."""
        young, old = self.young, self.old
        new = pieces.difference(young)
        for p in new.intersection(old):
            young[p] = old[p]
        new.difference_update(old)
        words, closed, rest = set(), [], []
        for p in new:
            if m := _CLOSED(p):
                word, signs = m.groups()
                if signs:
                    closed.append((p, word, signs))
                else:
                    words.add(p)
            else:
                rest.append(p)
        words |= {w for _, w, _ in closed}.difference(words, young, old)
        young.update(self._new_words(words))
        signs = list({s for *_, s in closed})
        ending = dict(zip(signs, self._encoded(signs)))
        for p, word, sign in closed:
            young[p] = (young[word] if word in young else old[word]) + ending[sign]
        young.update(zip(rest, self._encoded(rest)))

    def ids(self, texts: list[str]) -> list[bytes]:
        if not any(texts):
            return [b""] * len(texts)
        collecting = gc.isenabled()
        gc.disable()  # many short strings come and go, none in a cycle
        try:
            return self._ids(texts)
        finally:
            if collecting:
                gc.enable()

    def _whole(self, texts: list[str], array: pa.LargeStringArray) -> list[int]:
        """Numbers of the texts that cannot be cut at every blank and line end, or hold a special string."""
        rows, flat = _flat(array)
        at = np.flatnonzero((flat == 32) | (flat == 10))
        limit = np.zeros(len(flat) + 1, bool)
        limit[rows] = True
        white = _WHITE[flat]
        at = at[white[at - 1]]
        at = at[limit[at + 1] | white[np.minimum(at + 1, len(flat) - 1)]]
        doubtful = np.unique(np.searchsorted(rows, at, "right") - 1).tolist()
        special = [k for k, t in enumerate(texts) if any(s in t for s in self.specials)]
        return sorted({k for k in doubtful if _INSIDE.search(texts[k])}.union(special))

    def _ids(self, texts: list[str]) -> list[bytes]:
        array = pa.array(texts, pa.large_string())
        whole = self._whole(texts, array)
        encoded = dict(zip(whole, self._encoded([texts[k] for k in whole])))
        if whole:
            array = pa.array(["" if k in encoded else t for k, t in enumerate(texts)], pa.large_string())
        rows, flat = _flat(array)
        opens = (flat == 32) | (flat == 10)
        opens[rows[:-1][rows[:-1] < rows[1:]]] = True
        starts = np.flatnonzero(opens)
        cut = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(flat))), array.buffers()[2])
        cut = cut.dictionary_encode()
        distinct = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        self._learn(set(distinct))
        ids = pa.array([self.young[p] for p in distinct], pa.large_binary()).take(cut.indices)
        ends, joined = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1), memoryview(ids.buffers()[2] or b"")
        ends = ends[np.searchsorted(starts, rows)].tolist()
        out = [bytes(joined[a:b]) for a, b in zip(ends, ends[1:])]
        for k, ids_of_text in encoded.items():
            out[k] = ids_of_text
        if len(self.young) > REMEMBERED:
            self.old = {p: found for p, found in self.young.items() if len(p) <= LONG_PIECE}
            self.young = {}
        return out
