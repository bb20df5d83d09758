"""Golomb-Rice codes of sorted integers, on whole arrays.

Gaps between neighbours are cut into a remainder of ``k`` bits and a quotient
in unary. Remainders and quotients are two streams, so that both ways are a
few array operations.
"""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray) -> tuple[int, bytes, bytes]:
    """``k``, quotients and remainders of ascending ``uint64`` values."""
    if not len(values):
        return 0, b"", b""
    gaps = np.diff(values, prepend=np.uint64(0))
    mean = float(gaps.mean())
    k = max(0, int(np.floor(np.log2(mean * np.log(2))))) if mean > 1.5 else 0
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    shifts = np.arange(k, dtype=np.uint64)[::-1]
    low = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes(), np.packbits(low.ravel()).tobytes()


def decode(n: int, k: int, quotients: bytes, remainders: bytes) -> np.ndarray:
    """The ``n`` values that were encoded."""
    if not n:
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(quotients, np.uint8)))[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(k)
    bits = np.unpackbits(np.frombuffer(remainders, np.uint8), count=n * k)
    low = np.zeros(n, np.uint64)
    for column in bits.reshape(n, k).T if k else ():
        low = (low << np.uint64(1)) | column
    return np.cumsum(gaps + low, dtype=np.uint64)
