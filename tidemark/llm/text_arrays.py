"""Words of an Arrow batch of texts and their hashes, as numpy arrays.

Words are maximal runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage
return; those bytes never occur inside a UTF-8 sequence, so the split equals one by code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2^64
_SEGMENT = 1 << 21
_LONG_WORD = 64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def slices(texts: pa.Array, most_bytes: int = 4 << 20) -> Iterator[tuple[int, pa.Array]]:
    """(first row, slice) pieces of about `most_bytes`; one longer text is a piece of its own. Nulls become ''."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield first, texts.slice(first, last - first)
        first = last


def bytes_of(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and the n + 1 offsets into them; `lower` maps A-Z to a-z."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return _LOWER[data] if lower else data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each text's first word (n + 1 entries).

    `blank` tells of each of the 256 bytes whether it stands between words.
    """
    inside = ~blank[data]
    starts, ends = inside.copy(), inside.copy()
    if len(data):
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        edges = offsets[1:-1]
        at = edges[edges < len(data)]
        starts[at] = inside[at]
        at = edges[edges > 0] - 1
        ends[at] = inside[at]
    start_at = np.flatnonzero(starts)
    return start_at, np.flatnonzero(ends) + 1, np.searchsorted(start_at, offsets)


def _powers_of(base: int, length: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < length:
        have = np.full(max(length, _SEGMENT + (1 << 16)), base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:length]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word: a polynomial over its bytes by prefix sums, then mixed.

    Polynomials modulo 2^64 agree on some pairs of long words whatever their base, so words beyond 64 bytes get the XXH3
    hash of their bytes.
    """
    hashes = np.empty(len(starts), dtype=np.uint64)
    inverse = pow(_BASE, -1, 1 << 64)
    first = 0
    while first < len(starts):
        low = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, low + _SEGMENT, side="right")))
        high = ends[last - 1]
        sums = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * _powers_of(_BASE, high - low), out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        hashes[first:last] = (sums[e] - sums[s]) * _powers_of(inverse, high - low)[s]
        first = last
    hashes = mix(hashes)
    for i in np.flatnonzero(ends - starts > _LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return hashes


def sequence_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of `length` neighbours, in order; empty if there are fewer."""
    count = len(hashes) - length + 1
    if count <= 0:
        return hashes[:0]
    total = np.full(count, length, dtype=np.uint64)
    for i in range(length):
        total = (total ^ hashes[i : i + count]) * np.uint64(0x9FB21C651E98DF25)
        total ^= total >> np.uint64(29)
    return mix(total)
