"""Languages of a text as a mixture: shares by expectation-maximisation, the set of languages by penalised likelihood.

A text is a bag of letter trigrams; each trigram comes from one of the text's languages. Shares that make the bag most
likely are found by expectation-maximisation. Languages are added one at a time while the likelihood rises by more than
each further language costs.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textnum as tn
from llm.base import ship, slices, summed_counts

BITS = 16
NONE = "und"
#: Part of each language's distribution that is that of all languages together, for trigrams it was never seen with.
COMMON = 0.02
#: Each letter is part of three trigrams, so likelihoods count everything about three times.
OVERLAP = 3.0
ITERATIONS = 200
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    """Whether each code point is a letter; worked out once in a worker."""
    if not _letters:
        _letters.append(np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the letter trigrams of all texts, and where each text's begin.

    Letters are lower-cased; whatever stands between them counts as one blank, also at both ends. A trigram has a letter in its middle.
    """
    letter = _is_letter()
    points, first = [], [0]
    for text in texts:
        own = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
        own = np.where(letter[own], own, 0)
        points.append(np.concatenate([[0], own[(own > 0) | (np.concatenate([[1], own[:-1]]) > 0)], [0]]).astype(np.uint64))
        first.append(first[-1] + len(points[-1]))
    every = np.concatenate([*points, [0, 0]]).astype(np.uint64)
    middle = np.flatnonzero(every[1:-1]) + 1
    slots = tn.mix(every[middle - 1] * tn.ODD[0] + every[middle] * tn.ODD[1] + every[middle + 1] * tn.ODD[2]) >> np.uint64(64 - BITS)
    return slots.astype(np.int64), np.searchsorted(middle, first)


@dataclass(frozen=True)
class LanguageModel:
    """Languages in order of their names, and for each the probabilities of all slots."""

    languages: list[str]
    chances: np.ndarray


def learn_languages(training: DataFrame) -> LanguageModel:
    """The trigram distributions of the languages in ``training`` (text, lang).

    Counts are over all rows; those with null text or lang add nothing, and a language without letters is not learnt.
    What reaches the driver are 65,536 counts for each language, and the names of the languages.
    """
    ship(training.sparkSession)
    rows = training.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("text is not null and lang is not null")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    number = {name: k for k, name in enumerate(languages)}

    def numbers(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                slots, first = trigrams(piece.column("text").to_pylist())
                of = np.array([number[x] for x in piece.column("lang").to_pylist()], np.int64)
                yield np.repeat(of, np.diff(first)) * (1 << BITS) + slots

    if not languages:
        return LanguageModel([], np.zeros((0, 1 << BITS)))
    counts = summed_counts(rows, numbers, len(languages) << BITS).reshape(len(languages), -1).astype(float)
    seen = np.flatnonzero(counts.sum(axis=1))
    counts, languages = counts[seen], [languages[k] for k in seen]
    if not languages:
        return LanguageModel([], np.zeros((0, 1 << BITS)))
    together = counts.sum(axis=0) + 0.5
    common = together / together.sum()
    return LanguageModel(languages, (1 - COMMON) * counts / counts.sum(axis=1)[:, None] + COMMON * common)


def cost(n: np.ndarray) -> np.ndarray:
    """What a further language must add to the log likelihood of n trigrams: half a logarithm of n, as often as letters overlap."""
    return OVERLAP * 0.5 * np.log(np.maximum(n, 2.0))


class Bags:
    """The distinct trigrams of several texts with their counts, and their chances in every language."""

    def __init__(self, slots: np.ndarray, first: np.ndarray, chances: np.ndarray):
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        pairs, count = np.unique((text << BITS) | slots, return_counts=True)
        text = pairs >> BITS
        self.count = count.astype(float)
        self.total = np.bincount(text, self.count, len(first) - 1)
        self.texts = np.flatnonzero(self.total)
        self.begin = np.searchsorted(text, self.texts)
        self.chance = chances[:, pairs & ((1 << BITS) - 1)]
        self.total = self.total[self.texts]

    def part(self, chosen: np.ndarray) -> Bags:
        """Only the texts at these places."""
        ends = np.append(self.begin[1:], len(self.count))
        sizes = (ends - self.begin)[chosen]
        out = object.__new__(Bags)
        out.begin = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        at = np.repeat(self.begin[chosen] - out.begin, sizes) + np.arange(int(sizes.sum()))
        out.count, out.chance, out.total, out.texts = self.count[at], self.chance[:, at], self.total[chosen], self.texts[chosen]
        return out

    def sums(self, values: np.ndarray) -> np.ndarray:
        """For each text the sum over its trigrams."""
        return np.add.reduceat(values, self.begin, axis=-1) if len(self.begin) else np.zeros((*values.shape[:-1], 0))

    def mixed(self, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log likelihood under each text's shares, and for each language the rate at which its share would grow.

        The rate is the mean of chance / mixture over the text's trigrams; multiplied by it, shares take one step of expectation-maximisation.
        No shares have a log likelihood more than total * log(greatest rate) above this one.
        """
        sizes = np.diff(np.append(self.begin, len(self.count)))
        mixture = np.einsum("le,le->e", np.repeat(shares, sizes, axis=1), self.chance)
        return self.sums(self.count * np.log(mixture)), self.sums(self.count / mixture * self.chance) / self.total


def _refit(bags: Bags, shares: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares by expectation-maximisation among the languages that have one, and their log likelihood.

    A text is done when nothing more than 0.01 can be gained, or when what can be gained does not reach ``target``; its
    likelihood is then below the target too.
    """
    out, likelihood = shares.copy(), np.full(len(bags.total), -np.inf)
    going = np.arange(len(bags.total))
    for _ in range(ITERATIONS):
        at, rate = bags.mixed(out[:, going])
        likelihood[going] = at
        could = bags.total * np.log(np.maximum(np.where(out[:, going] > 0, rate, 0.0).max(axis=0), 1.0))
        more = (could > 0.01) & (at + could > target[going])
        out[:, going] *= np.where(more, rate, 1.0)
        if not more.all():
            if not more.any():
                break
            bags, going = bags.part(np.flatnonzero(more)), going[more]
    return out / out.sum(axis=0), likelihood


def mixtures(bags: Bags) -> tuple[np.ndarray, np.ndarray]:
    """The chosen shares of every text (0: not in its set), and how surely its likeliest single language is that.

    The set starts with the likeliest single language and takes in the one whose share would grow fastest, while that
    raises the likelihood by more than its cost. It ends as well where no shares of all languages could.
    """
    alone = bags.sums(bags.count * np.log(bags.chance))
    best = alone.argmax(axis=0)
    sure = 1 / np.exp((alone - alone.max(axis=0)) / OVERLAP).sum(axis=0)
    shares = np.zeros_like(alone)
    shares[best, np.arange(len(best))] = 1.0
    going, rest, price = np.arange(len(best)), bags, cost(bags.total)
    while len(going):
        at, rate = rest.mixed(shares[:, going])
        outside = np.where(shares[:, going] > 0, 0.0, rate)
        could = (outside.max(axis=0) > 1) & (rest.total * np.log(np.maximum(rate.max(axis=0), 1.0)) > price[going])
        keep = np.flatnonzero(could)
        if not len(keep):
            break
        going, rest, at = going[keep], rest.part(keep), at[keep]
        tried = shares[:, going] * 0.8
        tried[outside[:, keep].argmax(axis=0), np.arange(len(going))] = 0.2
        tried, likelihood = _refit(rest, tried, at + price[going])
        better = np.flatnonzero(likelihood > at + price[going])
        going, rest = going[better], rest.part(better)
        shares[:, going] = tried[:, better]
    return shares, sure


SCHEMA = "doc_id long, lang_pred string, score double, n_trigrams long, languages array<struct<lang: string, share: double>>"
LANGUAGES = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


def _answers(texts: list[str | None], model: LanguageModel) -> Iterator[tuple[str, float, int, list[dict]]]:
    slots, first = trigrams(texts)
    n = np.diff(first)
    shares, sure, place = np.zeros((len(model.languages), 0)), np.zeros(0), np.full(len(texts), -1)
    if len(slots) and model.languages:
        bags = Bags(slots, first, model.chances)
        shares, sure = mixtures(bags)
        place[bags.texts] = np.arange(len(bags.texts))
    for k in range(len(texts)):
        if (at := place[k]) < 0:
            yield NONE, 0.0, int(n[k]), []
            continue
        own = shares[:, at]
        order = sorted(np.flatnonzero(own > 0).tolist(), key=lambda i: (-own[i], i))
        score = float(own[order[0]]) if len(order) > 1 else float(sure[at])
        yield model.languages[order[0]], min(1.0, score), int(n[k]), [{"lang": model.languages[i], "share": float(own[i])} for i in order]


def identify_languages(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score, n_trigrams, languages) per row of ``documents`` (doc_id, text).

    ``languages`` are the text's languages with their shares, the greatest first, equal ones by name; ``lang_pred`` is the
    first. ``score`` is its share or, where it is alone, its probability among all languages that the text could be in.

    Null texts and those without a letter are ``und`` with score 0 and no languages, as is every text when no language
    was learnt. Whole texts of any length are read. Every row is answered by itself, also repeated rows and those without
    doc_id; other columns are ignored; an empty table gives an empty result. Nothing is shuffled.
    """
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def identify(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                lang, score, n, found = zip(*_answers(piece.column("text").to_pylist(), sent.value), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64()), pa.array(found, LANGUAGES)],
                    ["doc_id", "lang_pred", "score", "n_trigrams", "languages"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(identify, SCHEMA)
