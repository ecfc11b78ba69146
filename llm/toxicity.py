"""Toxicity by multiple-instance learning.

A document is a bag of sentences and is toxic if at least one of them is. Each sentence has a logistic score over its
words; a document's score is their noisy-or, 1 - prod(1 - p). Only documents are labelled: the gradient of the
noisy-or shares a document's label out among its sentences, so the trained scores also tell which sentences offend.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textnum as tn
from llm.base import ship, slices

BITS = 18  # word features are hashed into so many slots
BEGINNINGS = (4, 5)  # bytes of a word that count as features too, for inflected and compound words
LEAST_DOCUMENTS = 5  # of the training rows that have a word
NOT_WORD = np.array([not (chr(b).isalnum() and b < 128) and b < 128 for b in range(256)])
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n"]] = True


def _instances(raw: np.ndarray, offsets: np.ndarray):
    """The distinct words and word beginnings of each sentence as slots: (slot, sentence) pairs, each sentence's text, start and end byte."""
    starts, ends, first = tn.words(raw, offsets, NOT_WORD)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    stops = np.cumsum(ENDS[raw])[starts]  # sentence ends before a word
    new = np.concatenate([[True], (stops[1:] != stops[:-1]) | (doc[1:] != doc[:-1])])
    sentence = np.cumsum(new) - 1
    begin = np.flatnonzero(new)
    parts = [tn.word_hashes(raw, starts, ends)]
    for size in BEGINNINGS:
        parts.append(tn.mix(tn.word_hashes(raw, starts, np.minimum(ends, starts + size)) + np.uint64(size)))
    slot = (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int64)
    pairs = np.unique(np.tile(sentence, len(parts)) << BITS | slot)
    return pairs & ((1 << BITS) - 1), pairs >> BITS, doc[begin], starts[begin], ends[np.concatenate([begin[1:] - 1, [len(starts) - 1]])]


def _train(texts: pa.Array, labels: np.ndarray, weights: np.ndarray, rounds: int, decay: float) -> tuple[np.ndarray, float]:
    """Word weights and the bias, by Adam on the weighted log loss of documents."""
    raw, offsets = tn.text_bytes(texts)
    slot, sentence, doc, _, _ = _instances(raw, offsets)
    n_docs, n_sentences = len(labels), len(doc)
    # A word that few documents have would only learn their labels by heart.
    of_docs = np.unique(doc[sentence] << BITS | slot) & ((1 << BITS) - 1)
    keep = np.bincount(of_docs, minlength=1 << BITS)[slot] >= LEAST_DOCUMENTS
    slot, sentence = slot[keep], sentence[keep]
    used, slot = np.unique(slot, return_inverse=True)
    # Start from how much oftener toxic documents have a word than others; what is learnt is which sentences count.
    in_docs = np.unique(doc[sentence] * len(used) + slot) if len(used) else np.zeros(0, np.int64)
    toxic = labels[in_docs // max(1, len(used))] == 1
    have = [np.bincount(in_docs[k] % len(used), weights[in_docs[k] // len(used)], len(used)) if len(used) else np.zeros(0) for k in (toxic, ~toxic)]
    of = [max(weights[labels == k].sum(), 1.0) for k in (1, 0)]
    w = np.maximum(0.0, np.log((have[0] + 0.5) / of[0]) - np.log((have[1] + 0.5) / of[1]) - 1.0) * have[0] / (have[0] + 5)
    b, total = -6.0, weights.sum()
    state = [[np.zeros(len(used)), np.zeros(len(used))], [0.0, 0.0]]
    for step in range(1, rounds + 1):
        s = np.bincount(sentence, w[slot], n_sentences) + b
        p = 1 / (1 + np.exp(-np.clip(s, -30, 30)))
        none = np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), n_docs)  # log of "no sentence is toxic"
        bag = np.clip(-np.expm1(none), 1e-9, 1 - 1e-9)
        # d loss / d s: p (1 - bag) / bag * -label + p * (1 - label)
        pull = p * np.where(labels == 1, -(1 - bag) / bag, 1.0)[doc] * weights[doc] / total
        grads = (np.bincount(slot, pull[sentence], len(used)) + decay * np.sign(w), pull.sum())
        for k, g in enumerate(grads):
            state[k][0] = 0.9 * state[k][0] + 0.1 * g
            state[k][1] = 0.999 * state[k][1] + 0.001 * g * g
            move = 0.1 * (state[k][0] / (1 - 0.9**step)) / (np.sqrt(state[k][1] / (1 - 0.999**step)) + 1e-9)
            if k:
                b -= move
            else:
                w -= move
    full = np.zeros(1 << BITS)
    full[used] = w
    return full, float(b)


def train(documents: DataFrame, labels: DataFrame, most_per_label: int = 1500, rounds: int = 100, decay: float = 3e-5) -> tuple[np.ndarray, float]:
    """Word weights and bias from labelled rows, at most ``most_per_label`` documents of each label, picked by a hash.

    Documents of a label are weighted up to all the labelled ones, so scores follow the share of toxic documents.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    picked = None
    for label in counts:
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_per_label)
        picked = part if picked is None else picked.union(part)
    if picked is None:
        return np.zeros(1 << BITS), -6.0
    ids = documents.sparkSession.sparkContext.broadcast({r["doc_id"]: r["toxic"] for r in picked.collect()})

    def take(batches):
        for batch in batches:
            keep = pa.array([x in ids.value for x in batch.column("doc_id").to_pylist()], pa.bool_())
            yield batch.filter(keep)

    rows = documents.select("doc_id", "text").mapInArrow(take, "doc_id long, text string").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    if not rows.num_rows:
        return np.zeros(1 << BITS), -6.0
    y = np.array([ids.value[x] for x in rows.column("doc_id").to_pylist()])
    share = {label: counts[label] / max(1, (y == label).sum()) for label in counts}
    return _train(rows.column("text"), y, np.array([share[x] for x in y], float), rounds, decay)


def score_toxicity(documents: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """(doc_id, score, n_sentences, worst, worst_score, worst_text) per row of ``documents`` (doc_id long, text).

    score: the noisy-or of the sentence scores, from 0 to 1. worst: the number, from 0, of the sentence with the highest
    score, the first of equals; null, as its score and text, without sentences. Sentences end at full stops, exclamation and question
    marks and line feeds and have a word. Null and empty texts score 0. Every row is scored, also repeated ones and those
    whose doc_id is null. An empty table gives an empty result; other columns are ignored.
    """
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        w, b = sent.value
        for batch in batches:
            for piece in slices(batch, "text"):
                raw, offsets = tn.text_bytes(piece.column("text"))
                slot, sentence, doc, begin, end = _instances(raw, offsets)
                n = len(piece)
                p = 1 / (1 + np.exp(-np.clip(np.bincount(sentence, w[slot], len(doc)) + b, -30, 30)))
                bag = -np.expm1(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-9)), n)) if len(doc) else np.zeros(n)
                count = np.bincount(doc, minlength=n) if len(doc) else np.zeros(n, np.int64)
                first = np.concatenate([[0], np.cumsum(count)])
                order = np.lexsort((np.arange(len(doc)), -p, doc))
                top = order[first[:-1][count > 0]]
                worst, value, text = np.full(n, None, object), np.full(n, None, object), np.full(n, None, object)
                for i, k in zip(np.flatnonzero(count), top, strict=True):
                    worst[i], value[i], text[i] = int(k - first[i]), float(p[k]), raw[begin[k]:end[k]].tobytes().decode("utf-8", "replace")
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(np.clip(bag, 0.0, 1.0)), pa.array(count.astype(np.int64)), pa.array(list(worst), pa.int64()), pa.array(list(value), pa.float64()), pa.array(list(text), pa.string())],
                                                 ["doc_id", "score", "n_sentences", "worst", "worst_score", "worst_text"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        score, "doc_id long, score double, n_sentences long, worst long, worst_score double, worst_text string")
