"""Vectorised hashing of words and of all windows of bytes, for whole batches of texts."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
#: A random value per byte, an odd base, and its inverse modulo 2 ** 64.
BYTE = _RANDOM.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = int(_RANDOM.integers(1 << 40, 1 << 62)) * 2 + 1
_POWERS = {"n": 0}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i < n."""
    if _POWERS["n"] < n:
        size = max(n, 1 << 16)
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base & (2 ** 64 - 1), np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
        _POWERS["n"] = size
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sums(raw: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span`` turns two of them into the hash of the bytes between."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE[raw] * powers(len(raw))[0], out=out[1:])
    return out


def span(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of raw[start:end]; equal bytes have equal hashes wherever they stand."""
    return mixed((total[end] - total[start]) * powers(len(total))[1][start])


def word_ends(raw: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes for which the table ``is_word`` is true."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = is_word[raw]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def chunks(texts: list[bytes], limit: int = 1 << 20):
    """(first, last + 1) of stretches of texts of about ``limit`` bytes; a longer text stands alone."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        if i > first and held + len(t) > limit:
            yield first, i
            first, held = i, 0
        held += len(t) + 1
    if first < len(texts):
        yield first, len(texts)
