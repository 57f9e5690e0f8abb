"""Elias-Fano sequences and flat images of named arrays.

An image is one run of bytes that is used in place: the arrays are views of
whatever buffer holds it, an Arrow value or a memory-mapped file.
"""

from __future__ import annotations

import json
import mmap

import numpy as np

#: Ones between two entries of the rank directory.
STRIDE = 256


def encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """Arrays of a non-decreasing sequence of non-negative integers: the low
    bits of each value side by side, the high bits in unary, and the place of
    every ``STRIDE``-th one."""
    v = values.astype(np.int64)
    n = len(v)
    top = int(v[-1]) if n else 0
    low = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
    width = -(-low // 8)
    raw = v.astype("<i8").view(np.uint8).reshape(n, 8)[:, :width]
    bits = np.unpackbits(raw, axis=1, count=low, bitorder="little") if low else raw
    ones = (v >> low) + np.arange(n)
    high = np.zeros((int(ones[-1]) + 1) if n else 0, np.uint8)
    high[ones] = 1
    return {"n": np.array([n, low], np.int64), "low": np.packbits(bits.ravel(), bitorder="little"),
            "high": np.packbits(high, bitorder="little"), "dir": ones[::STRIDE].astype(np.int64)}


class EliasFano:
    """Reads what :func:`encode` made, whole or at single places."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n, self.low = (int(x) for x in arrays["n"])
        self._low, self._high, self._dir = arrays["low"], arrays["high"], arrays["dir"]

    def values(self) -> np.ndarray:
        """The whole sequence."""
        ones = np.flatnonzero(np.unpackbits(self._high, bitorder="little"))
        out = (ones - np.arange(self.n)) << self.low
        if self.low:
            bits = np.unpackbits(self._low, bitorder="little", count=self.n * self.low).reshape(self.n, self.low)
            raw = np.packbits(bits, axis=1, bitorder="little")
            low = np.zeros((self.n, 8), np.uint8)
            low[:, :raw.shape[1]] = raw
            out |= low.view("<i8").ravel()
        return out

    def get(self, i: int) -> int:
        """Value ``i``; reads the unary part between two directory entries."""
        at = i // STRIDE
        start = int(self._dir[at])
        stop = int(self._dir[at + 1]) if at + 1 < len(self._dir) else 8 * len(self._high)
        window = np.unpackbits(self._high[start >> 3:(stop + 7) >> 3], bitorder="little")
        one = (start & ~7) + int(np.flatnonzero(window[start & 7:])[i % STRIDE]) + (start & 7)
        low, first = 0, i * self.low
        for b in range(self.low):
            low |= int(self._low[(first + b) >> 3] >> ((first + b) & 7) & 1) << b
        return (one - i) << self.low | low

    def successor(self, lo: int, hi: int, x: int) -> int:
        """The first place in ``lo..hi`` whose value is at least ``x``; ``hi`` if none."""
        while lo < hi:
            mid = (lo + hi) // 2
            if self.get(mid) < x:
                lo = mid + 1
            else:
                hi = mid
        return lo


def image(arrays: dict[str, np.ndarray]) -> bytes:
    """One run of bytes: a directory of names, then the arrays, each on a multiple of 8."""
    head, parts, at = {}, [], 0
    for name, a in arrays.items():
        raw = np.ascontiguousarray(a).tobytes()
        head[name] = (a.dtype.str, at, len(a))
        pad = -len(raw) % 8
        parts.append(raw + bytes(pad))
        at += len(raw) + pad
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return b"".join([len(text).to_bytes(8, "little"), text, *parts])


def views(buffer) -> dict[str, np.ndarray]:
    """The arrays of an :func:`image`, as views of ``buffer``."""
    size = int.from_bytes(bytes(buffer[:8]), "little")
    head = json.loads(bytes(buffer[8:8 + size]))
    return {name: np.frombuffer(buffer, np.dtype(t), n, 8 + size + at) for name, (t, at, n) in head.items()}


def mapped(path: str) -> dict[str, np.ndarray]:
    """The arrays of an image in a file, memory-mapped: only what is read is loaded."""
    with open(path, "rb") as f:
        return views(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
