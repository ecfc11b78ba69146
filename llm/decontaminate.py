"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item are compared where they share a seed, ``min_match`` tokens in a row. Tiles are found by
running Karp-Rabin: for a falling search length, windows of unmarked tokens are looked up by their hash, matches are
extended while both sides agree and are unmarked, and the longest are marked first. Tiles may stand in any order, so a
passage whose sentences were moved is covered all the same. An item whose covered share reaches the threshold is leaked.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textnum as tn
from llm.base import releasing, ship, slices

BLOCK_TOKENS = 2_000_000  # benchmark tokens handed to all workers at once; a larger benchmark takes several passes
NOT_WORD = np.array([not (chr(b).isalnum() and b < 128) and b < 128 for b in range(256)])


def _tokens(column):
    """Token hashes of each text, lower-cased runs of letters and digits, and the first token of each text."""
    raw, offsets = tn.text_bytes(pc.utf8_lower(column.cast(pa.large_string()).fill_null("")))
    starts, ends, first = tn.words(raw, offsets, NOT_WORD)
    return tn.word_hashes(raw, starts, ends), first


def greedy_tiles(item: list[int], text: list[int], min_match: int) -> list[tuple[int, int, int]]:
    """Non-overlapping tiles (start in item, start in text, length), longest first, of at least ``min_match`` tokens."""
    free_item, free_text = [True] * len(item), [True] * len(text)
    tiles, search = [], max(min_match, 1 << max(0, min(len(item), len(text)).bit_length() - 1))

    def windows(tokens, free, size):
        run = 0
        for i, ok in enumerate(free):
            run = run + 1 if ok else 0
            if run >= size:
                yield i - size + 1, hash(tuple(tokens[i - size + 1:i + 1]))

    while True:
        places = defaultdict(list)
        for i, h in windows(text, free_text, search):
            places[h].append(i)
        found, longest = [], 0
        for p, h in windows(item, free_item, search):
            for t in places.get(h, ()):
                size = 0
                while p + size < len(item) and t + size < len(text) and item[p + size] == text[t + size] and free_item[p + size] and free_text[t + size]:
                    size += 1
                if size >= search:
                    found.append((-size, p, t))
                    longest = max(longest, size)
        if longest > 2 * search:
            search = longest
            continue
        for size, p, t in sorted(found):
            size = -size
            if all(free_item[p:p + size]) and all(free_text[t:t + size]):
                free_item[p:p + size] = free_text[t:t + size] = [False] * size
                tiles.append((p, t, size))
        if search > min_match:
            search = max(min_match, search // 2)
        elif not found:
            return tiles


def _blocks(benchmark: DataFrame):
    """The benchmark's items in blocks of bounded size, as (item_id, text) lists."""
    block, size = [], 0
    for row in benchmark.toLocalIterator():
        block.append((row["item_id"], row["text"] or ""))
        size += len(block[-1][1]) // 2 + 1
        if size >= BLOCK_TOKENS:
            yield block
            block, size = [], 0
    if block:
        yield block


def leaks(documents: DataFrame, benchmark: DataFrame, min_match: int = 5, threshold: float = 0.5) -> DataFrame:
    """(doc_id, item_id, n_covered, n_item, coverage) where tiles cover ``threshold`` of the item's tokens or more.

    Tokens are runs of letters and digits, lower-cased. An item of fewer than ``min_match`` tokens is leaked only by a
    document that has all of them in a row. Null and empty texts and items match nothing. Repeated document rows, and
    repeated items, give a row each; rows with null ids are compared like others. Empty tables give an empty result; other
    columns are ignored. The benchmark is sent to the workers in blocks of bounded size, each with a pass over the documents.
    """
    spark = documents.sparkSession
    ship(spark)
    schema = "doc_id long, item_id long, n_covered long, n_item long, coverage double"
    held = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], schema)
    for block in _blocks(benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))):
        hashes, first = _tokens(pa.array([t for _, t in block], pa.string()))
        items = [hashes[first[i]:first[i + 1]].tolist() for i in range(len(block))]
        seeds = defaultdict(set)
        for size in {min(min_match, len(x)) for x in items if x}:
            for k, x in enumerate(items):
                if x and min(min_match, len(x)) == size:
                    for i in range(len(x) - size + 1):
                        seeds[int(_combined(np.array(x[i:i + size], np.uint64), size)[0])].add(k)
        sent = spark.sparkContext.broadcast((items, [i for i, _ in block], {k: sorted(v) for k, v in seeds.items()}))

        def compare(batches, sent=sent):
            items, names, seeds = sent.value
            keys = np.sort(np.array(list(seeds), np.uint64))
            sizes = sorted({min(min_match, len(x)) for x in items if x})
            for batch in batches:
                for piece in slices(batch, "text"):
                    tokens, first = _tokens(piece.column("text"))
                    ids, rows = piece.column("doc_id").to_pylist(), []
                    hit: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
                    for size in sizes:
                        if len(tokens) < size or not len(keys):
                            continue
                        made = _combined(tokens, size)
                        at = np.searchsorted(keys, made)
                        for i in np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == made).tolist():
                            doc = int(np.searchsorted(first, i, side="right")) - 1
                            if i + size <= first[doc + 1]:
                                for k in seeds[int(made[i])]:
                                    hit[doc][k].append((i - int(first[doc]), size))
                    for doc, matched in hit.items():
                        for k, places in matched.items():
                            item = items[k]
                            # Tiles lie on seeds: the other tokens of the document are left out, with breaks between.
                            text, end = [], -1
                            for i, size in sorted(places):
                                if i > end >= 0:
                                    text.append(None)
                                begin = int(first[doc]) + max(i, end)
                                text += tokens[begin:int(first[doc]) + i + size].tolist()
                                end = max(end, i + size)
                            covered = sum(t[2] for t in greedy_tiles(item, text, min(min_match, len(item))))
                            if covered >= threshold * len(item):
                                rows.append((ids[doc], names[k], covered, len(item), covered / len(item)))
                    if rows:
                        yield pa.RecordBatch.from_pylist([dict(zip(("doc_id", "item_id", "n_covered", "n_item", "coverage"), r, strict=True)) for r in rows],
                                                         pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_covered", pa.int64()), ("n_item", pa.int64()), ("coverage", pa.float64())]))

        out = out.union(held.mapInArrow(releasing(compare), schema))
    return out


def _combined(tokens: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the windows of ``size`` tokens."""
    total = np.zeros(len(tokens) - size + 1, np.uint64)
    for j in range(size):
        total += tokens[j:len(tokens) - size + 1 + j] * tn.ODD[j]
    return tn.mix(total + np.uint64(size))
