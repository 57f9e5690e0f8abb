"""Hashed word features, and their use by linear models."""

from __future__ import annotations

import re
from collections.abc import Iterable
from zlib import crc32

import numpy as np

#: Feature slots; a model of this size is what is sent to the executors.
SLOTS = 1 << 20
#: Length of the letter runs inside a word, its ends marked.
NGRAM = 5
#: Words whose slots a process remembers.
REMEMBERED = 200_000

_WORD = re.compile(r"[^\W\d_]+")
_slots_of: dict[str, bytes] = {}


def _remember(word: str) -> bytes:
    if len(_slots_of) >= REMEMBERED:
        _slots_of.clear()
    marked = f"<{word}>"
    parts = [marked, *(marked[i:i + NGRAM] for i in range(len(marked) - NGRAM + 1))]
    slots = np.fromiter((crc32(p.encode()) & (SLOTS - 1) for p in parts), np.int32, len(parts)).tobytes()
    if len(word) < 64:
        _slots_of[word] = slots
    return slots


def word_slots(text: str | None) -> np.ndarray:
    """Sorted distinct slots of a whole text: its words (runs of letters,
    lower-cased) and the letter runs inside them; none for a null or empty
    text."""
    known = _slots_of
    words = set(_WORD.findall((text or "").lower()))
    flat = b"".join([known.get(w) or _remember(w) for w in words])
    return np.unique(np.frombuffer(flat, np.int32))


class Rows:
    """Rows of slot numbers as one flat array."""

    def __init__(self, rows: Iterable[np.ndarray]):
        rows = list(rows)
        self.size = np.array([len(r) for r in rows], dtype=np.int64)
        self.slot = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.row = np.repeat(np.arange(len(rows)), self.size)

    def __len__(self) -> int:
        return len(self.size)

    def only(self, keep: np.ndarray) -> Rows:
        """The same rows with the slots marked in ``keep`` alone."""
        out = Rows([])
        kept = keep[self.slot]
        out.slot, out.row = self.slot[kept], self.row[kept]
        out.size = np.bincount(out.row, minlength=len(self))
        return out

    def margins(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.slot], len(self))

    def gradient(self, by_row: np.ndarray, slots: int) -> np.ndarray:
        return np.bincount(self.slot, by_row[self.row], slots)


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))
