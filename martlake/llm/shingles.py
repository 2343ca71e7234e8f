"""Sets of hashed word shingles."""

from __future__ import annotations

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: A random number for each byte at each of 64 places of a word (tabulation hashing).
_TABLE = np.random.default_rng(20).integers(0, 1 << 64, (64, 256), np.uint64).ravel()
_FAR = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of the texts (A-Z in lower case, split at spaces and the characters 9 to 13), and
    the number of its text."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    b = _LOWER[np.frombuffer(b"\n".join(raw), np.uint8)]
    inside = ~_SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
    start, size = edge[::2], edge[1::2] - edge[::2]
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = np.searchsorted(np.cumsum([len(r) + 1 for r in raw]), start, "right")
    b = b[inside]
    first = np.cumsum(size) - size
    place = np.arange(len(b)) - np.repeat(first, size)
    value = _TABLE[(place & 63) << 8 | b]
    if size.max() > 64:
        value = mix(value + (place >> 6).astype(np.uint64) * _FAR)
    return np.add.reduceat(value, first), text


def shingle_sets(texts: list[str | None], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the sorted set of hashes of k consecutive words (the whole sequence if there are fewer, nothing
    without words), one behind the other, and where each begins (and the last ends)."""
    w, text = word_hashes(texts)
    ends = np.searchsorted(text, np.arange(len(texts) + 1))
    size = np.diff(ends)
    span = np.minimum(size, k)  # words of a shingle of each text
    n = size - span + (size > 0)
    offsets = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(offsets[-1]) + np.repeat(ends[:-1] - offsets[:-1], n)
    words = np.repeat(span, n)
    x = np.zeros(len(at), np.uint64)
    for j in range(k):
        more = mix(x * _FAR + w[np.minimum(at + j, len(w) - 1)] + words.astype(np.uint64)) if len(w) else x
        x = more if not len(words) or words.min() > j else np.where(words > j, more, x)
    for a, z in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        x[a:z].sort()
    new = np.ones(len(x), bool)
    new[1:] = x[1:] != x[:-1]
    new[offsets[:-1][n > 0]] = True
    return x[new], np.concatenate([[0], np.cumsum(new)])[offsets]


def minhashes(sets: np.ndarray, offsets: np.ndarray, n: int, seed: int = 6) -> np.ndarray:
    """A row of n independent minima for each set; zeros for an empty one."""
    rng = np.random.default_rng(seed)
    odd, flip = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 64, n, np.uint64)
    out, full = np.zeros((len(offsets) - 1, n), np.uint64), np.diff(offsets) > 0
    if full.any():
        for i in range(n):
            h = (sets ^ flip[i]) * odd[i]
            h ^= h >> np.uint64(32)
            out[full, i] = np.minimum.reduceat(h, offsets[:-1][full])
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0
