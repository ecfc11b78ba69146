"""Periodic runs of words, found with a dictionary of basic factors.

For every power of two, stretches of that many words get a number, equal numbers for equal words: a stretch's number
comes from those of its two halves. Successive places of one number that lie within that length of each other form
arithmetic progressions; their step is a period. Neighbouring places with the same step are one run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.base import ship, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _repeated(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names as numbers from 0, the next place (in the given order) of the same name or -1, and whether a name recurs."""
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    same = ranked[1:] == ranked[:-1]
    number = np.empty(len(names), np.int64)
    number[order] = np.concatenate([[0], np.cumsum(~same)]) if len(names) else []
    after = np.full(len(names), -1, np.int64)
    after[order[:-1][same]] = order[1:][same]
    recurs = after >= 0
    recurs[order[1:][same]] = True
    return number, after, recurs


def word_runs(ids: np.ndarray, first: np.ndarray, min_length: int = 6, min_exponent: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of the maximal runs in several texts' words, ordered by start, then period.

    ``ids`` are numbers of the words, different ones in different texts; ``first`` has each text's first place and the
    end. A run has a smallest period q, at least ``min_exponent`` * q and ``min_length`` words, and no neighbour that
    continues it.

    Level k has the factors of L = 2**k words and takes the steps q with L/2 < q <= L. Within a run of period q every
    factor of L >= q words recurs q places on and not before, so its places with step q are one unbroken stretch; its
    bounds are those of the run. Conversely a stretch of at least three periods has no smaller period, which would make
    its factors recur sooner, and cannot be extended.
    """
    if min_exponent < 3:
        raise ValueError("min_exponent must be 3 or more")
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    longest = int(np.diff(first).max()) if len(first) > 1 else 0
    places, names, size = np.arange(len(ids)), ids, 1
    numbered = np.full(len(ids) + 1, -1, np.int64)
    while len(places) and size < 2 * (longest // min_exponent):
        number, after, recurs = _repeated(names)
        step = np.where(after >= 0, places[after] - places, 0)
        here = np.flatnonzero((step <= size) & (2 * step > size))
        if len(here):
            at, q = places[here], step[here]
            opens = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(q) != 0)]))
            closes = np.concatenate([opens[1:], [len(at)]]) - 1
            start, period = at[opens], q[opens]
            length = at[closes] - start + size + period
            keep = length >= np.maximum(min_length, min_exponent * period)
            found.append((start[keep], length[keep], period[keep]))
        # A factor twice as long recurs only where both of its halves do.
        numbered[places] = np.where(recurs, number, -1)
        behind = places[recurs]
        behind = behind[behind + size < len(ids)]
        left, right = numbered[behind], numbered[behind + size]
        numbered[places] = -1
        places, names = behind[right >= 0], (left * (len(ids) + 1) + right)[right >= 0]
        size *= 2
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    start, length, period = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _numbered(texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """The words of each text, their numbers and where each text starts. A number belongs to one text."""
    split, ids, known = [], [], 0
    for text in texts:
        words = WORD.findall(text or "")
        seen: dict[str, int] = {}
        ids.extend([seen.setdefault(w, known + len(seen)) for w in words])
        known += len(seen)
        split.append(words)
    return split, np.array(ids, np.int64), np.array([0, *accumulate(map(len, split))], np.int64)


def _collapsed(texts: list[str | None], min_length: int, min_exponent: int) -> Iterator[tuple[int, list[dict], str]]:
    """For each text its number of words, its runs and what is left of it."""
    split, ids, first = _numbered(texts)
    start, length, period = word_runs(ids, first, min_length, min_exponent)
    depth = np.zeros(len(ids) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    kept = np.cumsum(depth)[:-1] == 0
    of = np.searchsorted(start, first)
    for k, words in enumerate(split):
        a, b = of[k], of[k + 1]
        if a == b:
            yield len(words), [], " ".join(words)
            continue
        keep = kept[first[k]:first[k + 1]].tolist()
        runs = [{"start": s, "length": n, "period": q} for s, n, q in
                zip((start[a:b] - first[k]).tolist(), length[a:b].tolist(), period[a:b].tolist(), strict=True)]
        yield len(words), runs, " ".join([w for w, ok in zip(words, keep, strict=True) if ok])


RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(documents: DataFrame, min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of ``documents`` (doc_id, text).

    Words are what stands between white space, numbered from 0. ``runs`` are the maximal periodic runs (start, length,
    period) of at least ``min_exponent`` (3 or more) periods and ``min_length`` words, by start, then period.
    ``collapsed`` has the words outside all runs and the first period of each run that no other run covers beyond its own first
    period, joined by a space.

    Null and empty texts, and those of white space, have no words, no runs and an empty ``collapsed``. Every row is
    answered by itself, also repeated rows and those without doc_id; other columns are ignored; an empty table gives an
    empty result. Texts are whole and of any length: a text of n words takes memory in proportion to n, and time in
    proportion to n log n for each power of two up to its longest recurring stretch. Nothing is shuffled.
    """
    ship(documents.sparkSession)

    def collapse(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                n, runs, left = zip(*_collapsed(piece.column("text").to_pylist(), min_length, min_exponent), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(runs, RUNS), pa.array(left, pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        collapse, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def with_repeated_ends(documents: DataFrame) -> DataFrame:
    """(doc_id, text) where every tenth document, by a hash of its id, goes on from some word with a part repeated.

    The repeated part follows at least twice more (where the text is long enough), so a corpus without periodic texts
    gets some. Rows without doc_id and texts without words stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all(F.col("text").cast("string"), F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    n, g = F.size(words).cast("long"), F.floor(h / 10)
    a = g % n
    p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
    part = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(part, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")
    return documents.select("doc_id", F.when((h % 10 == 0) & (n > 0), made).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """For each row of :func:`periodic_runs` its number of runs, the one of most periods, and digests of runs and text."""
    # More periods first, then the smaller start and period; products of whole numbers compare the shares exactly.
    shares = lambda x, y: (x["length"].cast("decimal(19,0)") * y["period"].cast("decimal(19,0)"))
    before = lambda x, y: (
        F.when(shares(x, y) != shares(y, x), shares(x, y) > shares(y, x))
        .otherwise(F.struct(x["start"], x["period"]) < F.struct(y["start"], y["period"])))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda top, run: F.when(before(run, top), run).otherwise(top))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(listed, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
