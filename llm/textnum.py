"""Vectorised text primitives over an Arrow batch: words, their hashes, shingles, byte anchors.

Hashes are polynomial prefix sums modulo 2**64 over a fixed pseudo-random byte table, mixed at the end,
so equal byte strings get equal hashes wherever they stand and on whichever machine.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LOWER_VALUE = BYTE_VALUE[_LOWER]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
ODD = _RANDOM.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """BASE**i (or its inverse) modulo 2**64 for i < n at least, kept between batches."""
    key = "inverse" if inverse else "base"
    have = _powers.get(key)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), INVERSE if inverse else BASE, dtype=np.uint64)
        steps[0] = 1
        have = _powers[key] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string or binary array, and the n+1 offsets of its texts; null counts as empty."""
    import pyarrow as pa

    column = column.cast(pa.large_binary()).fill_null(b"")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1] if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(raw: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each maximal run of bytes outside ``between`` in one text, and the first word of each text."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~between[raw]
    before = np.empty_like(solid)
    before[0], before[1:] = False, solid[:-1]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[edges] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1], after[:-1] = False, solid[1:]
    after[edges[1:] - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word, with A-Z taken as a-z if ``lower``."""
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((LOWER_VALUE if lower else BYTE_VALUE)[raw] * powers(len(raw)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(len(raw) + 1, inverse=True)[starts] + (ends - starts).astype(np.uint64) * ODD[63])


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word windows of each text (all its words where it has fewer, none without words), and the
    first window of each text. ``first`` has the first word of each text and the number of words at its end."""
    counts = np.diff(first)
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(made)])
    if not at[-1]:
        return np.zeros(0, np.uint64), at
    begin = np.repeat(first[:-1] - at[:-1], made) + np.arange(at[-1])
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    out = np.zeros(at[-1], np.uint64)
    short = np.repeat(np.where(counts < n, counts, n), made)
    for j in range(n):
        out += np.where(j < short, padded[begin + j], np.uint64(0)) * ODD[j]
    return mix(out + short.astype(np.uint64) * ODD[62]), at


def sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """The least (or greatest) of each window of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    pick = np.minimum if least else np.maximum
    out, span = values, 1
    while span < width:  # windows of twice the width, as far as that goes, then two that overlap
        step = min(span, width - span)
        out = pick(out[:-step], out[step:])
        span += step
    return out


def anchors(raw: np.ndarray, offsets: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the k-byte strings that are least by hash in some ``length``-byte string of one text.

    Equal strings of that length have the same anchors at the same distance from their start, wherever they stand.
    """
    if len(raw) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUE[raw] * powers(len(raw)), out=sums[1:])
    hashes = mix((sums[k:] - sums[:-k]) * powers(len(raw) + 1, inverse=True)[:len(raw) - k + 1])
    least = sliding(hashes, length - k + 1, True)
    inside = np.zeros(len(least), bool)
    for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if hi - lo >= length:
            inside[lo:hi - length + 1] = True
    least[~inside] = 0
    edge = np.zeros(length - k, np.uint64)
    chosen = sliding(np.concatenate([edge, least, edge]), length - k + 1, False) == hashes
    places = np.flatnonzero(chosen)
    return places, hashes[places]
