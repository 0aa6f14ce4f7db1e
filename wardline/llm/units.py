"""Cutting texts where every byte-level BPE pre-tokenizer cuts too, and remembering what the pieces encode to.

Pre-tokens take white space only at their front and hold letters, digits or other signs. So a pre-token always
ends before a blank or line end that follows a sign, and between a Latin letter or digit and a plain sign. The
runs in between are units. A unit that ends in some rarer white space may go on in the next, and a special
string may span several; texts with either are handled whole. Encoding is then per distinct unit, not per text.
"""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Callable

import pyarrow as pa

#: Entries a worker's memory of units may hold before it starts anew; results do not depend on it.
REMEMBERED = 500_000
#: Text bytes whose distinct units are looked up together.
TEXT_BYTES = 4 << 20
#: Units longer than this are not remembered.
LONG_UNIT = 200
_WORD, _SIGN = r"[A-Za-z0-9\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]", r"[.,;:!?#*$%&|]"
_UNIT = re.compile(rf"[ \n]*{_WORD}+(?=[ \n]|{_SIGN}|$)|[ \n]*{_SIGN}+(?=[ \n]|{_WORD}|$)|[ \n]*[^ \n]+|[ \n]+")
#: Characters that some Unicode versions call white space and Python does not.
_DOUBTFUL = "\u180E\u200B\u2060\uFEFF"


#: Units that are one pre-token: letters or plain signs, with one space before them or none.
_ONE = re.compile(r" ?(?:[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F]+|[.,;:!?#*$%&|]+)").fullmatch


def byte_level_ids(tokenizer, characters: list[str]) -> Callable[[list[str]], list[list[int]]]:
    """Ids of strings by a byte-level BPE tokenizer; single pre-tokens go straight to its model."""
    shown, model = dict(enumerate(characters)), tokenizer.model.tokenize

    def encode(texts: list[str]) -> list[list[int]]:
        out: list = [[t.id for t in model(u.encode().decode("latin-1").translate(shown))] if _ONE(u) else None for u in texts]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, e in zip(rest, tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            out[i] = e.ids
        return out
    return encode


def worker_store() -> dict:
    """A dict that lives as long as the Python worker, across tasks."""
    return sys.modules.setdefault("_wardline_worker_store", types.ModuleType("_wardline_worker_store")).__dict__


def forget(keep: str | None = None) -> None:
    """Drop what earlier tasks of other operators left with this worker, all but the entry ``keep``, and Arrow's unused memory."""
    store = worker_store()
    for key in [k for k in store if not k.startswith("__") and k != keep]:
        del store[key]
    pa.default_memory_pool().release_unused()


def _open_ended(unit: str) -> bool:
    last = unit[-1]
    return last not in " \n" and (last.isspace() or last in _DOUBTFUL)


class UnitMemory:
    """Values of units by text; ``encode`` gets distinct strings and returns one value for each."""

    def __init__(self, encode: Callable[[list[str]], list], specials: tuple[str, ...] = ()):
        self.encode, self.specials, self.known = encode, specials, {}

    def _cut(self, text: str) -> list[str]:
        return [text] if any(s in text for s in self.specials) else _UNIT.findall(text)

    def values(self, texts: list[str]) -> list[list]:
        """For each text the values of its units in order."""
        cut = [self._cut(t) for t in texts]
        here = set().union(*cut)
        unsafe = {u for u in here.difference(self.known) if _open_ended(u)}
        if unsafe:
            cut = [[t] if unsafe.intersection(units) else units for t, units in zip(texts, cut)]
            here = set().union(*cut)
        new = list(here.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {u: self.known[u] for u in here.intersection(self.known)}
        self.known.update(zip(new, self.encode(new)))
        get = self.known.__getitem__
        out = [list(map(get, units)) for units in cut]
        for u in new:
            if len(u) > LONG_UNIT or _open_ended(u):
                del self.known[u]
        return out
