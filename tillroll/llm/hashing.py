"""64-bit hashes of spans of an array, by prefix sums."""
from __future__ import annotations

import numpy as np

_C1, _C2, _R = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), 0xD6E8FEB86659FD93
MIX1, MIX2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """R**i and R**-i modulo 2**64 for i < n."""
    if not _POWERS or len(_POWERS["up"]) < n:
        size = max(1 << 16, 1 << n.bit_length())
        for name, base in (("up", _R), ("down", pow(_R, -1, 1 << 64))):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _POWERS[name] = np.multiply.accumulate(a)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def span_keys(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit keys of the spans: differences of prefix hashes, moved to position 0."""
    v = (symbols.astype(np.uint64) + np.uint64(1)) * _C1
    v ^= v >> np.uint64(29)
    v *= _C2
    up, down = powers(len(v) + 1)
    total = np.zeros(len(v) + 1, np.uint64)
    np.cumsum(v * up[:-1], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


def mix(v: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    v = v ^ (v >> np.uint64(33))
    v = v * MIX1
    v = v ^ (v >> np.uint64(29))
    v = v * MIX2
    return v ^ (v >> np.uint64(32))
