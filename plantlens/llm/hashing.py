"""Vectorised hashes of words, word runs and byte runs, used inside tasks."""

from __future__ import annotations

import numpy as np

#: Texts are hashed in slabs of this many bytes, which bounds the memory of very long ones.
SLAB = 1 << 20
_RNG = np.random.Generator(np.random.PCG64(20240607))
#: One odd 64-bit value for each byte, and odd multipliers for positions.
BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE2 = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x + np.uint64(seed)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    """BASE to the powers 0 to n - 1."""
    out = np.full(n, BASE)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWERS = powers(4096)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words between ASCII white space."""
    if not data:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = SPACE[np.frombuffer(data, np.uint8)]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).view(np.int8)))
    return edge[::2], edge[1::2]


def word_hashes(data: bytes, byte: np.ndarray = BYTE) -> np.ndarray:
    """A 64-bit hash of each word between ASCII white space, in order."""
    global _POWERS
    out, at = [], 0
    while at < len(data):
        end = min(len(data), at + SLAB)
        while end < len(data) and not SPACE[data[end]]:
            end += 1
        part = data[at:end]
        starts, ends = word_spans(part)
        at = end
        if not len(starts):
            continue
        size = ends - starts
        if size.max() > len(_POWERS):
            _POWERS = powers(int(size.max()) * 2)
        # positions inside words, white space left out
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        inside = np.arange(int(size.sum())) - np.repeat(first, size)
        values = np.frombuffer(part, np.uint8)[np.repeat(starts, size) + inside]
        out.append(np.add.reduceat(byte[values] * _POWERS[inside], first))
    return mix(np.concatenate(out)) if out else np.zeros(0, np.uint64)


def shingles(words: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of ``width`` consecutive words; fewer words are one shingle."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    if n < width:
        return mix(np.sum(words * STEP[:n], keepdims=True, dtype=np.uint64), n)
    total = words[: n - width + 1] * STEP[0]
    for j in range(1, width):
        total += words[j : n - width + 1 + j] * STEP[j]
    return np.unique(mix(total))
