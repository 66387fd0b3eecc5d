"""Vectorised hashing of the words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)

#: Bytes of words: ASCII letters and everything that isn't ASCII.
LETTERS = np.array([0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80 for c in range(256)])

_POWERS = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd constant, modulo 2**64, and their inverses."""
    global _POWERS
    if len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        _POWERS = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, p)])) for p in (_P, inverse))
    return _POWERS[0][:n], _POWERS[1][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX
    return h ^ (h >> np.uint64(29))


def joined(texts) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts, A-Z in lower case, a blank before and after each,
    and where each text ends in them."""
    raw = [t.encode("utf-8", "replace").lower() if t else b"" for t in texts]
    size = np.fromiter(map(len, raw), np.int64, len(raw)) + 1
    return np.frombuffer(b" " + b"".join(r + b" " for r in raw), np.uint8), np.cumsum(size)


def words(texts, kind: np.ndarray = LETTERS):
    """(doc, hash, start, end) of all words, in order: the text's number, a
    64-bit hash of the word's bytes, A-Z in lower case, and its place in ``joined``."""
    b, ends = joined(texts)
    mark = np.diff(kind[b].astype(np.int8))
    start, end = np.flatnonzero(mark == 1) + 1, np.flatnonzero(mark == -1) + 1
    power, inverse = _powers(len(b))
    prefix = np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power)
    h = (prefix[end - 1] - prefix[start - 1]) * inverse[start]
    return np.searchsorted(ends, start, "right"), mixed(h ^ (end - start).astype(np.uint64)), start, end


def slices(texts, chars: int = 1 << 18):
    """Runs of texts of about ``chars`` characters, so that memory follows the
    longest text rather than the batch."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t) if t else 0
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run
