"""An n-gram trie in Elias-Fano levels: packed, read in place from a buffer or a memory-mapped file.

Level 1 has words, level 2 the words before them, level 3 those before these. A level stores its keys relative to
their parents, made monotone by adding the parent's number times the key range, as one Elias-Fano sequence; the
ranges of children are a second one, of pointers; and smoothed log probabilities are quantised to 16-bit steps.
"""

from __future__ import annotations

import numpy as np

AT_ONCE = 1 << 15  # numbers that are cut into bits together; of whole bytes, so that their bits follow on each other
STEPS, LOWEST = 65535, -16.0  # log10 probabilities from -16 to 0: steps of 0.00025


class EliasFano:
    """A non-decreasing sequence of n numbers below ``universe``: low bits packed, high bits in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values, n = values.astype(np.uint64), len(values)
        bits = max(0, (max(1, universe) // max(1, n)).bit_length() - 1)
        flags = np.zeros(n + (int(values[-1]) >> bits if n else 0) + 1, np.uint8)
        flags[(values >> np.uint64(bits)).astype(np.int64) + np.arange(n)] = 1
        low, at = [np.zeros(0, np.uint8)], np.arange(bits, dtype=np.uint64)
        for lo in range(0, n, AT_ONCE):
            some = (values[lo:lo + AT_ONCE, None] >> at[None, :]) & np.uint64(1)
            low.append(np.packbits(some.astype(np.uint8).ravel(), bitorder="little"))
        return cls(n, bits, np.concatenate(low), np.packbits(flags, bitorder="little"))

    def low_at(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        at = np.asarray(i, np.int64) * self.low_bits
        out = np.zeros(len(at), np.uint64)
        for k in range((self.low_bits + 14) // 8):
            part = self.low[np.minimum((at >> 3) + k, len(self.low) - 1)].astype(np.uint64)
            shift = 8 * k - (at & 7)
            out |= np.where(shift >= 0, part << np.maximum(shift, 0).astype(np.uint64), part >> np.maximum(-shift, 0).astype(np.uint64))
        return (out & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def decode(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        return (ones - np.arange(self.n)) << self.low_bits | self.low_at(np.arange(self.n))

    def next_geq(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each wanted number the first place with a value not below it (n if none), and whether it is equal."""
        values = self.decode()
        at = np.searchsorted(values, wanted)
        if not self.n:
            return at, np.zeros(len(at), bool)
        return at, values[np.minimum(at, self.n - 1)] == wanted

    def parts(self) -> list[np.ndarray]:
        return [np.array([self.n, self.low_bits], np.int64), self.low, self.high]


def quantise(log10p: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(log10p, LOWEST, 0.0) * (-STEPS / -LOWEST)).astype(np.uint16)


def restored(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) * (LOWEST / STEPS)


class Trie:
    """words: sorted word hashes; keys[k], pointers[k]: of level k + 2; codes[k]: quantised log10 probabilities of level k + 1."""

    def __init__(self, words: np.ndarray, keys: list[EliasFano], pointers: list[EliasFano], codes: list[np.ndarray]):
        self.words, self.keys, self.pointers, self.codes = words, keys, pointers, codes

    @classmethod
    def build(cls, words: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], log10p: list[np.ndarray], key_range: int) -> Trie:
        """levels: (parent's number, key) of each node of levels 2, 3, ..., sorted."""
        keys, pointers, n = [], [], len(words)
        for parent, key in levels:
            keys.append(EliasFano.of(parent.astype(np.int64) * key_range + key, max(1, n * key_range)))
            pointers.append(EliasFano.of(np.searchsorted(parent, np.arange(n + 1)), len(parent) + 1))
            n = len(parent)
        return cls(words, keys, pointers, [quantise(x) for x in log10p])

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The range of nodes of ``level`` below each node of the level above."""
        ends = self.pointers[level - 2].decode()
        return ends[node], ends[node + 1]

    def find(self, level: int, parent: np.ndarray, key: np.ndarray, key_range: int) -> np.ndarray:
        """The node of ``level`` under each parent with the key, -1 if there is none or no parent."""
        at, same = self.keys[level - 2].next_geq(np.maximum(parent, 0).astype(np.int64) * key_range + key)
        return np.where(same & (parent >= 0), at, -1)

    def log10p(self, level: int, node: np.ndarray) -> np.ndarray:
        codes = self.codes[level - 1]
        return restored(codes[np.maximum(node, 0)]) if len(codes) else np.zeros(len(node))

    def to_bytes(self) -> bytes:
        arrays = [self.words, *[p for e in (*self.keys, *self.pointers) for p in e.parts()], *self.codes]
        head = np.array([len(self.keys), *[a.nbytes for a in arrays]], np.int64)
        return b"".join([np.array([len(head)], np.int64).tobytes(), head.tobytes(), *[a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays]])

    @classmethod
    def from_buffer(cls, data) -> Trie:
        """A trie that reads ``data`` in place: bytes, or what np.memmap(path, np.uint8, "r") gives."""
        raw = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
        size = int(raw[:8].view(np.int64)[0])
        head = raw[8:8 + 8 * size].view(np.int64)
        at, views = 8 + 8 * size, []
        for n in head[1:].tolist():
            views.append(raw[at:at + n])
            at += n + -n % 8
        levels = int(head[0])
        sequences = []
        for k in range(2 * levels):
            shape, low, high = views[1 + 3 * k:4 + 3 * k]
            n, bits = shape.view(np.int64).tolist()
            sequences.append(EliasFano(n, bits, low, high))
        return cls(views[0].view(np.uint64), sequences[:levels], sequences[levels:], [v.view(np.uint16) for v in views[1 + 6 * levels:]])
