"""Words of whole texts as 64-bit hashes, computed on Arrow buffers.

A word is a maximal run of bytes other than space and ``\\x09-\\x0D``. On UTF-8
that equals ``[^\\x20\\x09-\\x0D]+`` on code points, since those six bytes never
occur inside a multi-byte character. ``A-Z`` are lower-cased, nothing else.

A word's hash is a position-weighted sum of random per-byte values, mixed at
the end: a whole buffer is hashed by a few array operations, and two words
collide with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
CHUNK_BYTES = 1 << 16  # temporaries stay in cache

_rng = np.random.default_rng(20240607)
_BYTE_VALUE = _rng.integers(1, 2**64, size=256, dtype=np.uint64)
_LOWER_VALUE = _BYTE_VALUE.copy()
_LOWER_VALUE[65:91] = _BYTE_VALUE[97:123]
_IS_SPACE = np.zeros(256, dtype=bool)
for _b in SPACES:
    _IS_SPACE[_b] = True
    _BYTE_VALUE[_b] = _LOWER_VALUE[_b] = 0
_ODD = [np.uint64(x | 1) for x in _rng.integers(2**62, 2**63, size=64, dtype=np.uint64).tolist()]
_WEIGHT = _rng.integers(1, 2**63, size=1 << 12, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _weights(n: int) -> np.ndarray:
    """At least n position weights (odd, the same in every process)."""
    global _WEIGHT
    while len(_WEIGHT) < n:
        _WEIGHT = np.concatenate([_WEIGHT, (mix(_WEIGHT + np.uint64(len(_WEIGHT)))) | np.uint64(1)])
    return _WEIGHT


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (array in, new array out)."""
    h = (h ^ (h >> np.uint64(32))) * _ODD[0]
    h ^= h >> np.uint64(29)
    h *= _ODD[1]
    h ^= h >> np.uint64(32)
    return h


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts (null: empty) and the n + 1 offsets into them."""
    texts = pa.array(texts).fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, byte where it starts, words before each text: n + 1)."""
    value = _LOWER_VALUE if lower else _BYTE_VALUE
    hashes, starts = [], []
    lo, inner = 0, offsets[1:-1]
    while lo < len(data):
        hi = min(len(data), lo + CHUNK_BYTES)
        while hi < len(data) and not _IS_SPACE[data[hi]]:  # end a chunk at white space
            step = _IS_SPACE[data[hi : hi + 4096]]
            hi += int(step.argmax()) if step.any() else len(step)
        part = data[lo:hi]
        space = _IS_SPACE[part]
        begins = ~space
        begins[1:] &= space[:-1]
        at = inner[np.searchsorted(inner, lo) : np.searchsorted(inner, hi)] - lo
        begins[at] = ~space[at]  # a text's first byte starts a word
        first = np.flatnonzero(begins)
        if len(first):
            place = np.arange(first[0], len(part)) - np.repeat(first, np.diff(np.append(first, len(part))))
            longest = int(place.max()) + 1
            weight = _weights(min(longest, CHUNK_BYTES))
            if longest > len(weight):  # white space only, worth 0
                np.minimum(place, len(weight) - 1, out=place)
            hashes.append(mix(np.add.reduceat(value[part[first[0] :]] * weight[place], first - first[0])))
            starts.append(first + lo)
        lo = hi
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    s = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return h, s, np.searchsorted(s, offsets)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` neighbouring word hashes (across texts)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = hashes[:n] * _ODD[2]
    for j in range(1, width):
        h ^= h >> np.uint64(31)
        h += hashes[j : j + n]
        h *= _ODD[2 + j % 60]
    return mix(h)


def whole_sequence(hashes: np.ndarray) -> np.uint64:
    """One hash for a text's whole word sequence (used below ``width`` words)."""
    return windows(hashes, len(hashes))[0] if len(hashes) else np.uint64(0)


def slices(offsets: np.ndarray, most_bytes: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``most_bytes`` each (one text at least)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most_bytes, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)
