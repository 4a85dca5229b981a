"""64-bit hashes of byte spans as numpy passes over a whole buffer."""

from __future__ import annotations

import numpy as np

_HASH_CHUNK = 1 << 20
_B = np.uint64(0x9E3779B97F4A7C15 | 1)
_B_INV = np.uint64(pow(int(_B), -1, 1 << 64))
_U = np.uint64
_bytes = np.arange(256)
FOLD = np.where((_bytes >= 65) & (_bytes <= 90), _bytes + 32, _bytes).astype(np.uint8)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser (public domain constants)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(n: int, cache: dict = {}) -> tuple[np.ndarray, np.ndarray]:  # noqa: B006
    if n > len(cache.get("p", ())):
        ones = np.full(n, _B)
        ones[0] = 1
        inv = np.full(n, _B_INV)
        inv[0] = 1
        p, q = np.cumprod(ones), np.cumprod(inv)
        if n > 2 * _HASH_CHUNK:
            return p, q
        cache["p"], cache["q"] = p, q
    return cache["p"][:n], cache["q"][:n]


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               fold: bool = True, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each span's bytes (A-Z folded to a-z if ``fold``).

    Sorted, non-overlapping spans. Prefix sums of byte * B^i modulo 2^64 give every span's
    polynomial in one pass; long buffers go in pieces that end between spans.
    """
    out = np.empty(len(starts), _U)
    lo = 0
    while lo < len(starts):
        hi = int(np.searchsorted(ends, starts[lo] + _HASH_CHUNK, side="right"))
        hi = max(hi, lo + 1)
        a, b = int(starts[lo]), int(ends[hi - 1])
        part = FOLD[data[a:b]] if fold else data[a:b]
        p, q = _powers(b - a)
        s = np.zeros(b - a + 1, _U)
        np.cumsum((part.astype(_U) + _U(1)) * p, out=s[1:])
        i, j = starts[lo:hi] - a, ends[lo:hi] - a
        out[lo:hi] = (s[j] - s[i]) * q[i]
        lo = hi
    return mix64(out ^ _U(seed))
