"""Removal of long repeats with run-length indexes of a repetitive corpus.

A string of ``length`` bytes that two documents share has the same anchors in both, the least k-byte hashes among its own.
1. Anchors that two documents or more have are found by a shuffle on their hash; each gets a route, made from the
   smallest document that has it. Neighbouring anchors of a copied passage mostly have one route.
2. Stretches of a document around anchors of one route go to the index of that route, so strings that are equal meet.
3. An index sorts the suffixes of its distinct stretches, keeps their Burrows-Wheeler transform as runs with the
   sampled ends of each run, and gives for every place the matching statistic up to ``length`` and, from the samples of the
   runs in its interval, the smallest document that has the match.
4. Each document takes the bytes under matches with smaller documents out of its text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textnum as tn
from llm.base import by_bucket, even_keys, releasing, ship, shuffle_partitions, slices

K = 16
HOT = 256  # an anchor of more documents has a route of its own
NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id: larger than all others
AT_ONCE = 16 << 20
PIECE = 1 << 17  # hashes of a piece stay in a core's cache
INDEX_BYTES = 1 << 16  # what sorts of an index need stays in a core's cache, and its ranks fit 16 bits
TABLE = 1 << 18  # distinct stretches are numbered by a table of this size, or four times the index
INDEX_PLACES = 1 << 20  # of rows whose marks are found at once


def _ids(column) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def _shard(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


def _chunk(ids: np.ndarray, n: int) -> np.ndarray:
    return (tn.mix(ids.astype(np.uint64) ^ tn.ODD[7]) % np.uint64(n)).astype(np.int64)


def _low(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _batch(rows: list, kinds: list, names: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)


def _shared_anchors(documents: DataFrame, length: int, n: int, keys: list[int]) -> DataFrame:
    """(chunk, docs, counts, low, route): by chunk of documents, the anchors they share with others."""

    def deal(batches):
        held, size = [], 0

        def packed():
            hashes, docs = (np.concatenate([h[k] for h in held]) for k in (0, 1))
            order = np.argsort(hashes, kind="stable")  # those of a row stay together
            hashes, docs = hashes[order], docs[order]
            new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])])
            hashes, docs = hashes[new], docs[new]
            cut = np.searchsorted(_shard(hashes, n), np.arange(n + 1))
            rows = []
            for s in np.flatnonzero(np.diff(cut)).tolist():
                table, at = np.unique(docs[cut[s]:cut[s + 1]], return_inverse=True)
                at = at.astype(np.uint16 if len(table) <= 65536 else np.uint32)
                rows.append((keys[s], table.tobytes(), at.tobytes(), _low(hashes[cut[s]:cut[s + 1]]).tobytes()))
            return _batch(rows, [pa.int64(), *[pa.binary()] * 3], ["shard", "docs", "at", "low"])

        for batch in batches:
            for piece in slices(batch, "text", PIECE):
                raw, offsets = tn.text_bytes(piece.column("text"))
                places, hashes = tn.anchors(raw, offsets, length, K)
                if not len(places):
                    continue
                held.append((hashes, _ids(piece.column("doc_id"))[np.searchsorted(offsets, places, side="right") - 1]))
                size += len(raw)
                if size >= AT_ONCE:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    def meet(batches):
        low, docs = [], []
        for batch in batches:
            for d, a, x in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True):
                low.append(np.frombuffer(x, np.uint32))
                docs.append(np.frombuffer(d, np.int64)[np.frombuffer(a, np.uint16 if len(a) == 2 * len(low[-1]) else np.uint32)])
        if not low:
            return
        low, docs = np.concatenate(low), np.concatenate(docs)
        order = np.argsort(low)
        low, docs = low[order], docs[order]
        start = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        least, most, count = np.minimum.reduceat(docs, start), np.maximum.reduceat(docs, start), np.diff(np.append(start, len(low)))
        route = _low(tn.mix(least.astype(np.uint64)))
        own = _low(tn.mix(low[start].astype(np.uint64) + tn.mix(least.astype(np.uint64))))
        route = np.repeat(np.where(count > HOT, own, route), count)
        pick = np.repeat(least < most, count)
        low, docs, route = low[pick], docs[pick], route[pick]
        by_doc = np.argsort(docs)
        order, cut = by_bucket(_chunk(docs[by_doc], n), n)
        order, rows = by_doc[order], []
        low, docs, route = low[order], docs[order], route[order]
        for c in np.flatnonzero(np.diff(cut)).tolist():
            table, counts = np.unique(docs[cut[c]:cut[c + 1]], return_counts=True)
            rows.append((keys[c], table.tobytes(), counts.astype(np.int32).tobytes(), low[cut[c]:cut[c + 1]].tobytes(), route[cut[c]:cut[c + 1]].tobytes()))
        yield _batch(rows, [pa.int64(), *[pa.binary()] * 4], ["chunk", "docs", "counts", "low", "route"])

    dealt = documents.select("doc_id", "text").mapInArrow(releasing(deal), "shard long, docs binary, at binary, low binary").repartition(n, "shard")
    return dealt.mapInArrow(releasing(meet), "chunk long, docs binary, counts binary, low binary, route binary")


def _key(ids: np.ndarray, low: np.ndarray) -> np.ndarray:
    return tn.mix(tn.mix(ids.astype(np.uint64)) + low.astype(np.uint64))


def _row_keys(raw: np.ndarray, offsets: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """A hash of each row's text and doc_id: equal rows have equal marks."""
    sums = np.empty(len(raw) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(tn.BYTE_VALUE[raw] * tn.powers(len(raw)), out=sums[1:])
    lo, hi = offsets[:-1], offsets[1:]
    return tn.mix(tn.mix((sums[hi] - sums[lo]) * tn.powers(len(raw) + 1, inverse=True)[lo] + (hi - lo).astype(np.uint64)) ^ tn.mix(ids.astype(np.uint64)))


_STRETCH = np.dtype([("key", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("size", "<i4"), ("route", "<u4")])


def stretches(ids: np.ndarray, raw: np.ndarray, offsets: np.ndarray, keys: np.ndarray, routes: np.ndarray, length: int):
    """The stretches of texts around their shared anchors, one for neighbours of one route: (table, bytes)."""
    places, hashes = tn.anchors(raw, offsets, length, K)
    if not len(places) or not len(keys):
        return np.zeros(0, _STRETCH), []
    doc = np.searchsorted(offsets, places, side="right") - 1
    wanted = _key(ids[doc], _low(hashes))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    places, doc, route = places[hit], doc[hit], routes[at[hit]]
    if not len(places):
        return np.zeros(0, _STRETCH), []
    lo, hi = np.maximum(places - (length - K), offsets[doc]), np.minimum(places + length, offsets[doc + 1])
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (route[1:] != route[:-1]) | (lo[1:] > hi[:-1])])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(places)) - 1
    table = np.empty(len(first), _STRETCH)
    table["key"], table["doc"] = _row_keys(raw, offsets, ids)[doc[first]], ids[doc[first]]
    table["route"] = route[first]
    table["start"], table["size"] = lo[first] - offsets[doc[first]], hi[last] - lo[first]
    data = raw.tobytes()
    return table, [data[a:b] for a, b in zip(lo[first].tolist(), hi[last].tolist(), strict=True)]


class RunIndex:
    """Suffixes of texts, ordered by their first ``length`` bytes, as runs of the Burrows-Wheeler transform."""

    def __init__(self, texts: list[bytes], owners: np.ndarray, length: int):
        """owners: the smallest document that has each text."""
        sizes = np.array([len(t) for t in texts], np.int64)
        self.length, self.begin = length, np.concatenate([[0], np.cumsum(sizes + 1)])
        symbols = np.zeros(self.begin[-1] + length, np.uint64)  # 0 ends a text
        inside = np.repeat(np.arange(len(texts)), sizes) + np.arange(sizes.sum())
        symbols[inside] = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1)
        n = int(self.begin[-1])
        rank, radix = self._numbered(symbols, 257)
        depth, reach = 1, 0
        while reach < length:
            # Ranks of neighbouring stretches make one key: few distinct ones are numbered in a table, others sorted.
            parts = next((p for p in (3, 2) if radix ** p <= max(4 * len(symbols), TABLE) and p * depth < length), 0)
            by_table = parts > 0
            if not by_table:
                parts = min(-(-length // depth), next(p for p in range(64, 0, -1) if radix ** p <= 1 << 64))
            reach = min(parts * depth, length)
            key = rank.copy()
            for j in range(1, parts):
                step = min(j * depth, reach - depth)
                key *= np.uint64(radix)
                key[:len(rank) - step] += rank[step:]
            if by_table:
                rank, radix = self._numbered(key, radix ** parts)
            else:
                rank, order = self._ranked(key)
                radix = max(2, int(rank.max()) + 1)
            depth = reach
        rank = rank[:n].astype(np.int64)
        self.order = order[order < n]  # the suffix array to this depth
        owner = np.repeat(owners, sizes + 1)[self.order]
        before = np.concatenate([symbols[n - 1:n], symbols[:n - 1]])[self.order]  # the transform
        rank = rank[self.order]
        deep = np.concatenate([[True], rank[1:] != rank[:-1]]) if n else np.zeros(0, bool)  # matching statistic below length
        head = np.flatnonzero(deep | np.concatenate([[True], before[1:] != before[:-1]])) if n else np.zeros(0, np.int64)
        self.run_symbol, self.run_start = before[head], head
        self.run_ends = self.order[np.append(head[1:], n) - 1] if n else head  # sampled: the last suffix of each run
        self.run_least = np.minimum.reduceat(owner, head) if n else owner
        # The interval of a match is a row of whole runs; its smallest document comes from their samples.
        first = np.flatnonzero(deep[head]) if n else head
        self.least = np.minimum.reduceat(self.run_least, first) if n else owner
        interval = np.cumsum(deep) - 1 if n else head
        self.interval = np.empty(n, np.int64)
        self.interval[self.order] = interval

    @staticmethod
    def _numbered(key: np.ndarray, size: int) -> tuple[np.ndarray, int]:
        """The number of each key (below ``size``) among the distinct ones, and a bound of the numbers, 2 at least."""
        there = np.zeros(size, bool)
        there[key] = True
        number = np.cumsum(there, dtype=np.uint64)
        return (number - np.uint64(1))[key], max(2, int(number[-1]))

    @staticmethod
    def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each key among the distinct ones, and the order of the keys."""
        order = np.argsort(key)
        ordered = key[order]
        number = np.zeros(len(key), np.uint64)
        number[order[1:]] = np.cumsum(ordered[1:] != ordered[:-1]).astype(np.uint64)
        return number, order

    def all_matches(self) -> np.ndarray:
        """For every place of all texts, the smallest document that has the string there; its string must be whole."""
        return self.least[self.interval]

    def matches(self, text: int, size: int) -> np.ndarray:
        """Streaming over a text's places where a whole string starts: the smallest document that has it."""
        count = max(0, size - self.length + 1)
        return self.least[self.interval[self.begin[text]:self.begin[text] + count]]


def _indexes(table: np.ndarray) -> list[np.ndarray]:
    """The stretches of each index. Strings of different routes need not meet: an index takes the routes of about INDEX_BYTES at a time."""
    order = np.argsort(table["route"], kind="stable")
    route, before = table["route"][order], np.cumsum(table["size"][order], dtype=np.int64) - table["size"][order]
    first = np.flatnonzero(np.concatenate([[True], route[1:] != route[:-1]]))
    part = before[first] // INDEX_BYTES
    return np.split(order, first[np.flatnonzero(np.diff(part)) + 1])


def _marks(table: np.ndarray, texts: list[bytes], length: int):
    """(row key, document, start, end) of the bytes under strings that a smaller document has."""
    distinct: dict[bytes, int] = {}
    which = np.array([distinct.setdefault(t, len(distinct)) for t in texts], np.int64)
    owners = np.full(len(distinct), NO_ID)
    np.minimum.at(owners, which, table["doc"])
    index = RunIndex(list(distinct), owners, length)
    found = index.all_matches()
    count = np.maximum(0, table["size"].astype(np.int64) - length + 1)
    rows, out = np.flatnonzero(count > 0), []
    part = (np.cumsum(count[rows]) - count[rows]) // INDEX_PLACES
    for pick in np.split(rows, np.flatnonzero(np.diff(part)) + 1):
        # Places of all rows one after the other, each row with a place that is no match after it.
        width = count[pick] + 1
        ends = np.cumsum(width)
        row = np.repeat(np.arange(len(pick)), width)
        place = np.arange(len(row)) - (ends - width)[row]
        hit = found[index.begin[which[pick]][row] + place] < table["doc"][pick][row]
        hit[ends - 1] = False
        edges = np.flatnonzero(np.diff(hit, prepend=False))
        start, end = edges[::2], edges[1::2]
        of = pick[row[start]]
        out.append((table["key"][of], table["doc"][of], place[start] + table["start"][of], place[end] + length - 1 + table["start"][of]))
    return [np.concatenate([x[k] for x in out]) for k in range(4)]


def remove_repeats(documents: DataFrame, length: int = 50) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per row of ``documents`` (doc_id long, text); kept holds the bytes left.

    A byte goes if it is covered by a string of ``length`` bytes, inside the text, that a document with a smaller doc_id
    also has in its text. Null text counts as empty; texts shorter than ``length`` stay. Rows that repeat a doc_id do not
    remove from each other; a null doc_id counts as larger than all others. An empty table gives an empty result; other columns are ignored.
    """
    spark = documents.sparkSession
    ship(spark)
    n = shuffle_partitions(spark)
    keys = even_keys(spark, n)
    held = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = _shared_anchors(held, length, n, keys)

    def place(batches):
        for batch in batches:
            chunk = _chunk(_ids(batch.column("doc_id")), n)
            yield pa.RecordBatch.from_arrays([pa.array(np.array(keys)[chunk]), batch.column("doc_id"), batch.column("text")], ["chunk", "doc_id", "text"])

    placed = held.mapInArrow(releasing(place), "chunk long, doc_id long, text string")

    def cut(texts: pa.Table, anchors: pa.Table) -> pa.Table:
        known, routes = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint32)]
        for d, c, low, route in zip(*(anchors.column(k).to_pylist() for k in ("docs", "counts", "low", "route")), strict=True):
            known.append(_key(np.repeat(np.frombuffer(d, np.int64), np.frombuffer(c, np.int32)), np.frombuffer(low, np.uint32)))
            routes.append(np.frombuffer(route, np.uint32))
        known, routes = np.concatenate(known), np.concatenate(routes)
        order = np.argsort(known)
        known, routes = known[order], routes[order]
        tables, data, places = [], [], []
        for batch in texts.to_batches():
            for piece in slices(batch, "text", PIECE):
                raw, offsets = tn.text_bytes(piece.column("text"))
                table, parts = stretches(_ids(piece.column("doc_id")), raw, offsets, known, routes, length)
                tables.append(table)
                data += parts
                places.append((tn.mix(table["route"].astype(np.uint64)) % np.uint64(n)).astype(np.int64))
        rows = []
        if tables:
            table, shard = np.concatenate(tables), np.concatenate(places)
            order = np.argsort(shard, kind="stable")
            ends = np.searchsorted(shard[order], np.arange(n + 1))
            for s in np.flatnonzero(np.diff(ends)).tolist():
                pick = order[ends[s]:ends[s + 1]]
                rows.append((keys[s], table[pick].tobytes(), b"".join(data[i] for i in pick.tolist())))
        return pa.Table.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["shard", "stretches", "data"])

    def index(batches):
        tables, texts = [], []
        for batch in batches:
            for t, data in zip(batch.column("stretches").to_pylist(), batch.column("data").to_pylist(), strict=True):
                tables.append(np.frombuffer(t, _STRETCH))
                ends = np.cumsum(tables[-1]["size"]).tolist()
                texts += [data[e - s:e] for e, s in zip(ends, tables[-1]["size"].tolist(), strict=True)]
        if not tables:
            return
        table = np.concatenate(tables)
        found = [_marks(table[pick], [texts[i] for i in pick.tolist()], length) for pick in _indexes(table)]
        key, doc, start, end = (np.concatenate([f[k] for f in found]) for k in range(4))
        chunk = _chunk(doc, n)
        rows = []
        for c in np.unique(chunk).tolist():
            pick = chunk == c
            rows.append((keys[c], key[pick].tobytes(), start[pick].astype(np.int32).tobytes(), end[pick].astype(np.int32).tobytes()))
        yield _batch(rows, [pa.int64(), *[pa.binary()] * 3], ["chunk", "key", "start", "end"])

    def take_out(texts: pa.Table, marks: pa.Table) -> pa.Table:
        key, start, end = (np.concatenate([np.zeros(0, t), *[np.frombuffer(x, t) for x in marks.column(name).to_pylist()]]) for name, t in (("key", np.uint64), ("start", np.int32), ("end", np.int32)))
        order = np.lexsort((start, key))
        key, start, end = key[order], start[order].astype(np.int64), end[order].astype(np.int64)
        out = []
        for batch in texts.to_batches():
            for piece in slices(batch, "text"):
                raw, offsets = tn.text_bytes(piece.column("text"))
                rows = _row_keys(raw, offsets, _ids(piece.column("doc_id")))
                lo, hi = np.searchsorted(key, rows, "left"), np.searchsorted(key, rows, "right")
                change = np.zeros(len(raw) + 1, np.int64)
                for i in np.flatnonzero(hi > lo).tolist():
                    np.add.at(change, offsets[i] + start[lo[i]:hi[i]], 1)
                    np.add.at(change, offsets[i] + end[lo[i]:hi[i]], -1)
                gone = np.cumsum(change[:-1]) > 0
                run = gone.copy()
                run[1:] &= ~gone[:-1]
                firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
                run[firsts] = gone[firsts]
                total, spans = np.concatenate([[0], np.cumsum(gone)]), np.concatenate([[0], np.cumsum(run)])
                kept = offsets - total[offsets]
                left = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(piece), [None, pa.py_buffer(kept.astype(np.int64)), pa.py_buffer(raw[~gone])])
                out.append(pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.int64()), pa.array(np.diff(offsets)), pa.array(np.diff(total[offsets])), pa.array(np.diff(spans[offsets])), left.cast(pa.binary())],
                                                      ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]))
        schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
        return pa.Table.from_batches(out, schema)

    by_chunk = placed.groupBy("chunk")
    cuts = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(cut, "shard long, stretches binary, data binary")
    marks = cuts.repartition(n, "shard").mapInArrow(releasing(index), "chunk long, key binary, start binary, end binary")
    return placed.groupBy("chunk").cogroup(marks.groupBy("chunk")).applyInArrow(take_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
