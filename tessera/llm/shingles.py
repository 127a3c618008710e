"""Sets of hashed word shingles, computed on whole batches of texts with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE = 1 << 21
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_VALUES = _mix(np.arange(1, 257, dtype=_U) * _U(0xBF58476D1CE4E5B9))
_VALUES[65:91] = _VALUES[97:123]  # A-Z count as a-z
_SEPARATES = np.zeros(256, dtype=bool)
_SEPARATES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, PIECE + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, dtype=_U)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=_U)
    return _POWERS["up"], _POWERS["down"]


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of each run of non-separators; a polynomial from prefix sums, then mixed."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~_SEPARATES[raw], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=_U)
    np.cumsum(_VALUES[raw] * up[:len(raw)], dtype=_U, out=sums[1:])
    return starts, _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U) * _U(0xA0761D6478BD642F))


def _long_words(text: bytes) -> np.ndarray:
    """Word hashes of a text of any length, a bounded piece at a time (one word stays whole)."""
    out, first = [], 0
    while first < len(text):
        last = min(first + PIECE, len(text))
        if last < len(text):
            gaps = np.flatnonzero(_SEPARATES[np.frombuffer(text[first:last], np.uint8)])
            while not len(gaps) and last < len(text):
                begin, last = last, min(last + PIECE, len(text))
                gaps = begin - first + np.flatnonzero(_SEPARATES[np.frombuffer(text[begin:last], np.uint8)])
            if len(gaps):
                last = first + int(gaps[-1]) + 1
        out.append(hash_words(text[first:last])[1])
        first = last
    return np.concatenate(out) if out else np.zeros(0, _U)


def word_lists(texts: list[bytes]) -> Iterator[np.ndarray]:
    """Word hashes of each text, in order."""
    first = 0
    while first < len(texts):
        last, total = first, 0
        while last < len(texts) and total + len(texts[last]) + 1 <= PIECE:
            total += len(texts[last]) + 1
            last += 1
        if last == first:
            yield _long_words(texts[first])
            first += 1
            continue
        starts, hashes = hash_words(b" ".join(texts[first:last]))
        ends = np.cumsum([len(t) + 1 for t in texts[first:last]])
        yield from np.split(hashes, np.searchsorted(starts, ends[:-1]))
        first = last


def shingle_sets(texts: list[bytes], n: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text's ``n``-word shingles.

    A text of fewer words has its whole sequence as its one shingle; a text
    without words has none. Hashes have 64 bits; only a collision within a
    compared pair could change a result.
    """
    factors = _mix(np.arange(1, n + 1, dtype=_U) * _U(0xE7037ED1A0B428DB)) | _U(1)
    for words in word_lists(texts):
        m = len(words)
        k = min(m, n)
        if not k:
            yield np.zeros(0, _U)
            continue
        h = np.full(m - k + 1, k * 0x8EBC6AF09C88C6E3 % 2**64, dtype=_U)
        for j in range(k):
            h += words[j:m - k + 1 + j] * factors[j]
        yield np.unique(_mix(h))


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
