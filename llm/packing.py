"""Harmonic packing of tokenised documents into sequences of fixed length.

Lengths fall into reciprocal-capacity classes: class j has those in (C / (j+1), C / j], the last class all shorter ones,
and a bin of class j takes exactly j documents, so a worker fills its bins without knowing any other worker's. What a
full bin leaves free is a gap; as soon as the gaps together hold the next document, it is cut to fill them, oldest gap
first. At most one bin for each class is open at a time. Documents of open bins at the end of a partition fill the last
gaps and then whole sequences; the last remainder is cut into sequences whose lengths are powers of two.
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textnum as tn
from llm.base import releasing, ship, slices

KEPT_WORDS = 300_000  # of a worker's memory of encoded words; then it forgets those it met once, which changes no result
AT_ONCE = 4096
WORD_END = "</w>"
# How the tokenizer cuts a word, for words of Latin letters that lower-casing does not cut further.
# Words of ASCII and Western European letters, without apostrophes or marks of special tokens, are cut the same way below.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
LATIN = regex.compile(r"[\x21-\x7E\u00A1-\u012F\u0131-\u024F]+")
LETTER, DIGIT, SYMBOL, SPECIAL = 1, 2, 3, 4
KIND = np.array([LETTER if c.isalpha() else DIGIT if c.isdigit() else SPECIAL if c == "'" else SYMBOL if "!" <= c <= "~" else SPECIAL
                 for c in map(chr, range(128))] + [SPECIAL] * 128, np.uint8)
_encoders: dict[str, WordEncoder] = {}


def pieces(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each unit, the first unit of each text, and whether a unit is one piece to the tokenizer.

    A word of ASCII and the letters U+00C0 to U+00FF is cut into its runs of letters, its single digits and its runs of symbols, so that case and
    punctuation do not make a word new; any other word is a unit.
    """
    starts, ends, first = tn.words(raw, offsets)
    if not len(starts):
        return starts, ends, first, np.zeros(0, bool)
    kind = KIND[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)
    lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]  # the signs of multiplication and division
    kind[lead] = kind[lead + 1] = LETTER
    kind[np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))] = SPECIAL
    special = np.concatenate([[0], np.cumsum(kind == SPECIAL)])
    plain = special[ends] == special[starts]
    cut = np.zeros(len(raw), bool)
    cut[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    inside = np.zeros(len(raw) + 1, np.int8)  # 1 within plain words only
    inside[starts[plain]] += 1
    inside[ends[plain]] -= 1
    cut &= np.cumsum(inside[:-1], dtype=np.int8) > 0
    cut[starts] = True
    begins = np.flatnonzero(cut)
    word = np.searchsorted(starts, begins, side="right") - 1
    stops = np.minimum(np.append(begins[1:], len(raw)), ends[word])
    return begins, stops, np.searchsorted(begins, offsets), plain[word]


class WordEncoder:
    """Token ids of texts by a tokenizer that never joins across white space: each distinct unit is encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.is_end = np.zeros(max(vocabulary.values()) + 3, bool)
        self.is_end[[i for t, i in vocabulary.items() if t.endswith(WORD_END)]] = True
        self.known: dict[int, int] = {}
        self.begin, self.count, self.met, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    @classmethod
    def of(cls, path: str) -> WordEncoder:
        """The encoder of this worker, which keeps its words from task to task."""
        if path not in _encoders:
            _encoders[path] = cls(path)
        return _encoders[path]

    def forget(self) -> None:
        keep = self.met > 1
        keep &= np.cumsum(keep) <= KEPT_WORDS // 2
        number = np.cumsum(keep) - 1
        self.known = {h: int(number[k]) for h, k in self.known.items() if keep[k]}
        begin, count = self.begin[keep], self.count[keep]
        stops = np.concatenate([[0], np.cumsum(count)])
        self.ids = self.ids[np.repeat(begin - stops[:-1], count) + np.arange(stops[-1])]
        self.begin, self.count, self.met = stops[:-1], count, self.met[keep]

    def _together(self, found: list[str], cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number for each unit: units are encoded in one text and told apart by the ends of their pieces."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(found)], add_special_tokens=False)[0].ids, np.uint32)
        ends = np.flatnonzero(self.is_end[ids]) + 1
        stops = np.cumsum(cuts)
        if not len(ends) or len(ends) != stops[-1]:
            return self._apart(found)
        return ids, np.diff(ends[stops - 1], prepend=0)

    def _whole(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._together(found, np.ones(len(found), np.int64))

    def _latin(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return self._together(found, np.array([len(PIECES.findall(w.lower())) for w in found], np.int64))

    def _apart(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        made = [np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32) for w in found]
        return np.concatenate(made), np.array([len(x) for x in made], np.int64)

    def learn(self, hashes: list[int], found: list[str], whole: list[bool]) -> None:
        """Encode units that are new; ``whole`` tells those that are one piece."""
        ways: dict = {self._whole: [], self._latin: [], self._apart: []}
        for k, w in enumerate(found):
            ways[self._whole if whole[k] else self._latin if "<|" not in w and LATIN.fullmatch(w) else self._apart].append(k)
        for way, order in ways.items():
            for i in range(0, len(order), AT_ONCE):
                some = order[i:i + AT_ONCE]
                ids, counts = way([found[k] for k in some])
                base = len(self.count)
                self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(counts) - counts])
                self.count, self.ids = np.concatenate([self.count, counts]), np.concatenate([self.ids, ids])
                self.known.update(zip([hashes[k] for k in some], range(base, base + len(some)), strict=True))
        self.met = np.concatenate([self.met, np.zeros(len(self.count) - len(self.met), np.int64)])

    def encode(self, column, last: int) -> Iterator[np.ndarray]:
        """The ids of each text, then ``last``."""
        raw, offsets = tn.text_bytes(column)
        starts, ends, first, whole = pieces(raw, offsets)
        hashes = tn.word_hashes(raw, starts, ends, lower=False)
        low = np.flatnonzero(whole)
        hashes[low] = tn.word_hashes(raw, starts[low], ends[low])
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > KEPT_WORDS:
            self.forget()
        names = distinct.tolist()
        word = np.array([self.known.get(h, -1) for h in names], np.int64)
        new = np.flatnonzero(word < 0)
        if len(new):
            data = raw.tobytes()
            spans = zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)
            self.learn(distinct[new].tolist(), [data[a:b].decode() for a, b in spans], whole[at[new]].tolist())
            word[new] = [self.known[h] for h in distinct[new].tolist()]
        self.met += np.bincount(word, np.bincount(inverse, minlength=len(word)), len(self.met)).astype(np.int64)
        word = word[inverse]
        counts = self.count[word]
        stops = np.concatenate([[0], np.cumsum(counts)])
        ids = self.ids[np.repeat(self.begin[word] - stops[:-1], counts) + np.arange(stops[-1])]
        cut = stops[first]
        tail = np.array([last], np.uint32)
        for i in range(len(offsets) - 1):
            yield np.concatenate([ids[cut[i]:cut[i + 1]], tail])


class HarmonicPacker:
    """One worker's bins. ``pieces`` collects (document, start, ids, document's tokens, sequence, offset)."""

    def __init__(self, capacity: int, n_classes: int, first_sequence: int):
        self.capacity, self.n_classes, self.sequence = capacity, n_classes, first_sequence
        self.open: dict[int, list] = {}
        self.gaps: deque = deque()
        self.free = 0
        self.pieces: list = []

    def _new(self) -> int:
        self.sequence += 1
        return self.sequence - 1

    def _fill(self, doc, ids: np.ndarray, start: int, stop: int) -> int:
        """Put ids into gaps until either ends; the next start."""
        while start < stop and self.gaps:
            sequence, offset, room = self.gaps[0]
            take = min(room, stop - start)
            self.pieces.append((doc, start, ids[start:start + take], len(ids), sequence, offset))
            start, self.free = start + take, self.free - take
            if take == room:
                self.gaps.popleft()
            else:
                self.gaps[0] = (sequence, offset + take, room - take)
        return start

    def add(self, doc, ids: np.ndarray) -> None:
        start, stop = 0, len(ids)
        while stop - start >= self.capacity:
            self.pieces.append((doc, start, ids[start:start + self.capacity], stop, self._new(), 0))
            start += self.capacity
        if start == stop:
            return
        if self.free >= stop - start:
            self._fill(doc, ids, start, stop)
            return
        j = min(self.capacity // (stop - start), self.n_classes)
        held = self.open.setdefault(j, [])
        held.append((doc, start, ids))
        if len(held) == j:
            sequence, offset = self._new(), 0
            for doc_, start_, ids_ in self.open.pop(j):
                self.pieces.append((doc_, start_, ids_[start_:], len(ids_), sequence, offset))
                offset += len(ids_) - start_
            if offset < self.capacity:
                self.gaps.append((sequence, offset, self.capacity - offset))
                self.free += self.capacity - offset

    def finish(self) -> None:
        left = [x for j in sorted(self.open) for x in self.open[j]]
        self.open = {}
        rest = sum(len(ids) - start for _, start, ids in left)
        for doc, start, ids in left:
            while start < len(ids):
                if not self.gaps:
                    rest_here = rest
                    room = self.capacity if rest_here >= self.capacity else 1 << (rest_here.bit_length() - 1)
                    self.gaps.append((self._new(), 0, room))
                    self.free += room
                stop = self._fill(doc, ids, start, len(ids))
                rest, start = rest - (stop - start), stop


def harmonic_pack(documents: DataFrame, tokenizer_path: str, capacity: int = 4096, last_id: int = 2, n_classes: int = 32) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of documents (doc_id long, text).

    ids: the piece's token ids as little-endian unsigned 32-bit numbers. A document is its text's ids, special tokens not
    added, then ``last_id``. Every id is in one piece and pieces fill each sequence from 0 without holes. A sequence id has
    the partition's number in its upper bits, so workers need no shuffle and a lost task is done again by itself.

    Null and empty texts are documents of ``last_id`` alone; a text longer than a sequence is cut. Every row is packed,
    also repeated ones and those whose doc_id is null. An empty table gives no piece; other columns are ignored.
    """
    ship(documents.sparkSession)

    def pack(batches):
        encoder = WordEncoder.of(tokenizer_path)
        packer = HarmonicPacker(capacity, n_classes, TaskContext.get().partitionId() << 40)

        def taken():
            rows, packer.pieces = packer.pieces, []
            ids = [x[2] for x in rows]
            ends = np.concatenate([[0], np.cumsum([4 * len(x) for x in ids])]).astype(np.int64)
            data = np.concatenate(ids).astype("<u4") if ids else np.zeros(0, "<u4")
            return pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in rows], pa.int64()), pa.array([x[1] for x in rows], pa.int64()), pa.array(np.diff(ends) // 4, pa.int64()),
                pa.array([x[3] for x in rows], pa.int64()), pa.array([x[4] for x in rows], pa.int64()), pa.array([x[5] for x in rows], pa.int64()),
                pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends), pa.py_buffer(data)]).cast(pa.binary())],
                ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            for piece in slices(batch, "text"):
                for doc, ids in zip(piece.column("doc_id").to_pylist(), encoder.encode(piece.column("text"), last_id), strict=True):
                    packer.add(doc, ids)
                yield taken()
        packer.finish()
        yield taken()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        releasing(pack), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")


def piece_digests(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
