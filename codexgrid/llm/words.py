"""Words as numbers: the lower-case words of texts (maximal runs of letters or digits), hashed without a string for each."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_POWER = 0x9E3779B97F4A7C15 | 1
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_AT_ONCE = 1 << 17  # characters; a longer text is handled alone


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """The lower-case form of each code point that is a letter or digit, 0 for the others."""
    low = (ord(x[0]) if len(x := chr(c).lower()) == 1 and unicodedata.category(chr(c))[0] in "LN" else 0 for c in range(0x110000))
    return np.fromiter(low, np.uint32, 0x110000)


_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of _POWER and of its inverse modulo 2**64, n of each at least."""
    if len(_tables.get("up", ())) < n:
        size = max(_AT_ONCE, 1 << (n - 1).bit_length())
        for name, base in (("up", _POWER), ("down", pow(_POWER, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
    return _tables["up"], _tables["down"]


def _hash(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    low = [t.lower() if "Σ" in t or "İ" in t else t for t in texts]  # whose lower-case forms depend on what is beside, or are two
    c = np.frombuffer("\n".join(["", *low, ""]).encode("utf-32-le", "replace"), np.uint32)
    c = np.take(_letters(), c)
    inside = c > 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1  # line breaks at both ends: every word begins and ends
    first, end = edge[::2], edge[1::2]
    up, down = _powers(len(c))
    total = np.empty(len(c) + 1, np.uint64)
    total[0] = 0
    np.cumsum(c * up[: len(c)], out=total[1:])
    h = mix((total[end] - total[first]) * down[first])
    bounds = np.cumsum(np.fromiter(map(len, low), np.int64, len(low)) + 1) + 1
    return h, np.diff(np.searchsorted(first, bounds), prepend=0)


def hashed(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hash of each word of the texts, in order, and the number of words of each text."""
    hs, ns = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > _AT_ONCE:
            for x, y in zip((hs, ns), _hash(part)):
                x.append(y)
            part, size = [], 0
        part.append(t)
        size += len(t) + 1
    if part:
        for x, y in zip((hs, ns), _hash(part)):
            x.append(y)
    return np.concatenate(hs), np.concatenate(ns)


def combined(h: np.ndarray, counts: np.ndarray, salt: int = 0) -> np.ndarray:
    """One hash of each text's words in order, from the words' hashes; other salts give independent ones."""
    end = np.cumsum(counts)
    first = end - counts
    up, down = _powers(len(h) + 1)
    total = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(mix(h + np.uint64(salt)) * up[: len(h)], out=total[1:])
    return mix((total[end] - total[first]) * down[first] + counts.astype(np.uint64))


def sequences(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of each sequence of ``k`` successive words of each text, in order."""
    m = len(h) - k + 1
    if m <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(k):
        out = (out ^ h[i : i + m]) * np.uint64(_POWER)
        out ^= out >> np.uint64(29)
    row = np.repeat(np.arange(len(counts)), counts)
    inside = row[:m] == row[k - 1 :]
    return row[:m][inside], mix(out[inside])


def batches(texts: list[str], size: int) -> Iterator[tuple[int, int]]:
    """Ranges of the list that hold about ``size`` characters each."""
    a = total = 0
    for i, t in enumerate(texts):
        total += len(t)
        if total >= size:
            yield a, i + 1
            a, total = i + 1, 0
    if a < len(texts):
        yield a, len(texts)
