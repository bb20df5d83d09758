"""Words of a text as hashes, by array operations over its bytes."""

from __future__ import annotations

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)

# Word bytes: a-z, 0-9 and everything beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse modulo 2**64."""
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        n = 1 << n.bit_length()
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        steps = np.full(n, _BASE), np.full(n, inverse)
        for step in steps:
            step[0] = 1
        _POWERS, _INVERSE = (np.multiply.accumulate(s) for s in steps)
    return _POWERS[:n], _INVERSE[:n]


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash for each word of the lower-case text, in order."""
    raw = (text or "").lower().encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = _WORD[data]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    begins, ends = edge[::2], edge[1::2]
    powers, inverse = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    h = (sums[ends] - sums[begins]) * inverse[begins]
    h ^= h >> np.uint64(29)
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """One hash for each run of ``n`` words."""
    count = max(0, len(words) - n + 1)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out = out * _BASE + words[i : i + count]
    return out ^ (out >> np.uint64(31))
