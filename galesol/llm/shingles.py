"""64-bit hashes of word shingles and of strings within a run of bytes."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd multipliers, one per place in a shingle.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The distinct numbers of `x`, sorted. Sorts in place, which is several times faster than np.unique's hash table."""
    x.sort()
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def shingle_set(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes of a text: A-Z lower-cased, words parted by ASCII white space.

    A text of fewer than `size` words has its whole sequence as one shingle; one without words has none."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, dtype=np.uint64)
    digest = xxhash.xxh3_64_intdigest
    if len(words) < size:
        return np.array([digest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    known: dict[bytes, int] = {}
    h = np.fromiter([known[w] if w in known else known.setdefault(w, digest(w)) for w in words], dtype=np.uint64, count=len(words))
    n = len(h) - size + 1
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += h[k : k + n] * _PLACES[k]
    return distinct(mix64(total))


BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Hasher:
    """Names of all strings of one length in a run of bytes."""

    def __init__(self, n: int):
        self.up = _powers(BASE, n + 1)
        self.down = _powers(pow(BASE, -1, 1 << 64), n + 1)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_TABLE[data] * self.up[: len(data)], out=out[1:])
        return out

    def names(self, sums: np.ndarray, starts: np.ndarray | slice, ends: np.ndarray | slice, at: np.ndarray | slice) -> np.ndarray:
        return mix64((sums[ends] - sums[starts]) * self.down[at])
