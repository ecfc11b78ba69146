"""Language-model scoring with an n-gram trie that is sharded by the context of the predicted word.

Every word is a context of bigrams and every pair of words one of trigrams. An n-gram is dealt by the word before the
predicted one, so its shard has its count and the totals of its contexts; the training counts of the predicted
words are summed by word and joined to the shards that ask for them. A shard holds an Elias-Fano trie of
its n-grams and scores the occurrences that are dealt to it. What returns is a sum for each document and shard.
The most frequent words (at most FREQUENT) are known to all tasks with their counts and travel as their number among
these; all others travel as hashes.

Probabilities: absolute discounting for words, with all unseen words as one more word that gets the discounted mass;
bigrams and trigrams are smoothed towards the shorter context with a fixed prior weight. N-grams seen once back off.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textnum as tn
from llm.base import even_keys, releasing, ship, shuffle_partitions, slices, written
from llm.trie import Trie

END = np.uint64(0x5BD1E995DEADBEEF)
START, NONE = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x94D049BB5851F42D)  # the context of a first word, and its lack of one before
TOKENS_AT_ONCE = 1_500_000
SCORED_AT_ONCE = 1 << 18  # occurrences of a shard whose keys are worked out together; bounds memory and changes no result
LEAST_COUNT = 2
FREQUENT = 1 << 18  # bounds what the driver and each task hold; how a word travels changes no result
NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id
_SUMS = np.dtype([("doc", "<i8"), ("n_tokens", "<i4"), ("n_known", "<i4"), ("base", "<f8"), ("score", "<f8")])
PRIOR = (None, None, 60.0, 30.0)  # weight of the shorter context, by order


def _tokens(batches):
    """(doc_id, train, hashes of all tokens, first token of each text) of pieces of the input; each text ends in END."""
    for batch in batches:
        for piece in slices(batch, "text"):
            raw, offsets = tn.text_bytes(piece.column("text"))
            starts, ends, first = tn.words(raw, offsets)
            hashes = tn.word_hashes(raw, starts, ends)
            yield piece.column("doc_id"), piece.column("train").to_numpy(zero_copy_only=False), np.insert(hashes, first[1:], END), first + np.arange(len(first))


def _chunks(batches):
    """Lists of what ``_tokens`` yields, of about TOKENS_AT_ONCE tokens."""
    held, size = [], 0
    for piece in _tokens(batches):
        held.append(piece)
        size += len(piece[2])
        if size >= TOKENS_AT_ONCE:
            yield held
            held, size = [], 0
    if size:
        yield held


def _lookup(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Places in a sorted table, -1 where absent."""
    if not len(table):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(table, hashes), len(table) - 1)
    return np.where(table[at] == hashes, at, -1)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order and how often each comes; sorts ``keys`` itself."""
    keys.sort()
    starts = np.flatnonzero(np.concatenate([[len(keys) > 0], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[starts], np.diff(starts, append=len(keys))


def _shard(hashes: np.ndarray, n_parts: int) -> np.ndarray:
    return (tn.mix(hashes) % np.uint64(n_parts)).astype(np.int64)


def _planes(values: np.ndarray) -> bytes:
    """The first bytes of all values, then the second ones and so on: equal bytes stand together for the shuffle's compression."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes() if len(values) else b""


def _values(data: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).reshape(-1)


def _narrow(places: np.ndarray, size: int) -> bytes:
    """Places below ``size`` by planes of as few bytes as they need."""
    return _planes(places.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :_width(size)])


def _wide(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // _width(size), 4), np.uint8)
    out[:, :_width(size)] = np.frombuffer(data, np.uint8).reshape(_width(size), -1).T
    return out.view("<u4").reshape(-1)


def _width(size: int) -> int:
    return 2 if size <= 1 << 16 else 3 if size <= 1 << 24 else 4


def _steps(hashes: np.ndarray) -> bytes:
    """Ascending hashes by their differences."""
    return _planes(np.diff(hashes, prepend=np.uint64(0)))


def _summed(data: bytes) -> np.ndarray:
    return np.cumsum(_values(data, np.uint64))


def _word_totals(documents: DataFrame) -> DataFrame:
    """(n, types, once, twice, words, counts): a row per shard of words with its sum, its counts of types and its share of the most frequent words."""
    n_parts = shuffle_partitions(documents.sparkSession)
    keys, share = even_keys(documents.sparkSession, n_parts), FREQUENT // n_parts

    def deal(batches):
        known, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for _, train, hashes, first in _tokens(batches):
            own = hashes[np.repeat(train, np.diff(first))]
            found, n = np.unique(own, return_counts=True)
            both, at = np.unique(np.concatenate([known, found]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(both)).astype(np.int64)
            known = both
        shard = _shard(known, n_parts)
        for s in np.unique(shard).tolist():
            pick = shard == s
            yield pa.RecordBatch.from_arrays([pa.array([keys[s]], pa.int64()), pa.array([_steps(known[pick])], pa.binary()), pa.array([_planes(counts[pick])], pa.binary())], ["shard", "words", "counts"])

    def add(batches):
        words, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for batch in batches:
            words += [_summed(x) for x in batch.column("words").to_pylist()]
            counts += [_values(x, np.int64) for x in batch.column("counts").to_pylist()]
        found, at = np.unique(np.concatenate(words), return_inverse=True)
        n = np.bincount(at, np.concatenate(counts), len(found)).astype(np.int64)
        most = np.argsort(n, kind="stable")[max(0, len(n) - share):]
        yield pa.RecordBatch.from_arrays([*(pa.array([int(x)], pa.int64()) for x in (n.sum(), len(found), (n == 1).sum(), (n == 2).sum())), pa.array([found[most].tobytes()], pa.binary()), pa.array([n[most].tobytes()], pa.binary())],
                                         ["n", "types", "once", "twice", "words", "counts"])

    dealt = documents.mapInArrow(releasing(deal), "shard long, words binary, counts binary").repartition(n_parts, "shard")
    return dealt.mapInArrow(releasing(add), "n long, types long, once long, twice long, words binary, counts binary")


class Totals:
    """What all shards need: the number of training tokens and of their types, the discount, and the most frequent words
    (sorted hashes) with their training counts."""

    def __init__(self, documents: DataFrame):
        shards = written(_word_totals(documents), "lm-totals").collect()  # a row for each shard
        self.tokens, self.types, once, twice = (sum(r[c] for r in shards) for c in ("n", "types", "once", "twice"))
        self.discount = once / (once + 2 * twice) if once else 0.5
        words, counts = (np.frombuffer(b"".join(bytes(r[c]) for r in shards), t) for c, t in (("words", np.uint64), ("counts", np.int64)))
        order = np.argsort(words)
        self.words, self.counts = words[order], counts[order]


def previous(words: np.ndarray, first: np.ndarray, start=START, none=NONE) -> tuple[np.ndarray, np.ndarray]:
    """For each token the word before it, ``start`` for the first of a text, and the one before that, ``none`` for the first."""
    starts = first[:-1][first[:-1] < first[1:]]
    before = np.roll(words, 1)
    before[starts] = start
    earlier = np.roll(before, 1)
    earlier[starts] = none
    return before, earlier


class Shard:
    """Occurrences of one shard as places in ``vocabulary`` (sorted hashes), with the training count of each predicted word."""

    def __init__(self, vocabulary, count, word, before, earlier, doc, train, documents):
        self.vocabulary, self.count, self.size = vocabulary, count, len(vocabulary)
        self.word, self.before, self.earlier, self.doc, self.train, self.documents = word, before, earlier, doc, train, documents
        self.none = _lookup(vocabulary, np.array([NONE]))[0]
        self.totals = np.zeros(self.size, np.int64)
        keys, n = np.empty(len(train), np.int64), 0
        for lo, hi in self.cuts():
            own, after = (x[lo:hi][train[lo:hi]] for x in (before, earlier))
            self.totals += np.bincount(own, minlength=self.size)
            some = after != self.none
            found = self.pair(own[some], after[some])
            keys[n:n + len(found)] = found
            n += len(found)
        self.pairs, self.pair_totals = _counted(keys[:n])

    def cuts(self) -> list[tuple[int, int]]:
        """The occurrences in slices: a shard that holds a very common context has many."""
        return [(lo, min(lo + SCORED_AT_ONCE, len(self.word))) for lo in range(0, len(self.word), SCORED_AT_ONCE)]

    def pair(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        return before.astype(np.int64) * self.size + after

    def pair_total(self, before: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        """How often training has the two words as a context."""
        at = _lookup(self.pairs, self.pair(before, earlier))
        return np.where(at >= 0, self.pair_totals[at], 0) if len(self.pairs) else np.zeros(len(at), np.int64)

    def trie(self, model: Totals) -> Trie:
        """The trie of the training occurrences; keys below level 1 are places in ``vocabulary``."""
        predicted = np.zeros(self.size, bool)
        predicted[self.word] = True
        seen = np.flatnonzero(predicted & (self.count > 0))
        number = np.full(self.size, -1)
        number[seen] = np.arange(len(seen))
        p1 = (self.count[seen] - model.discount) / max(model.tokens, 1)
        keys, n = np.empty(len(self.train), np.int64), 0
        for lo, hi in self.cuts():
            pick = self.train[lo:hi]
            found = self.pair(number[self.word[lo:hi][pick]], self.before[lo:hi][pick])
            keys[n:n + len(found)] = found
            n += len(found)
        two, n2 = _counted(keys[:n])
        two, n2 = two[n2 >= LEAST_COUNT], n2[n2 >= LEAST_COUNT]
        p2 = (n2 + PRIOR[2] * p1[two // self.size]) / (self.totals[two % self.size] + PRIOR[2])
        # A trigram that is counted twice has its bigram counted twice, so those without a parent would go anyway.
        n = 0
        for lo, hi in self.cuts():
            pick = self.train[lo:hi] & (self.earlier[lo:hi] != self.none)
            parent = _lookup(two, self.pair(number[self.word[lo:hi][pick]], self.before[lo:hi][pick]))
            found = self.pair(parent[parent >= 0], self.earlier[lo:hi][pick][parent >= 0])
            keys[n:n + len(found)] = found
            n += len(found)
        three, n3 = _counted(keys[:n])
        del keys
        three, n3 = three[n3 >= LEAST_COUNT], n3[n3 >= LEAST_COUNT]
        parent = three // self.size
        p3 = (n3 + PRIOR[3] * p2[parent]) / (self.pair_total(two[parent] % self.size, three % self.size) + PRIOR[3])
        levels = [(two // self.size, two % self.size), (parent, three % self.size)]
        return Trie.build(self.vocabulary[seen], levels, [np.log10(np.maximum(p, 1e-300)) for p in (p1, p2, p3)], self.size)

    def scores(self, model: Totals, trie: Trie) -> np.ndarray:
        """log10 probability of each occurrence: the longest context the trie has, with back-off weights."""
        out = np.empty(len(self.word))
        for lo, hi in self.cuts():
            out[lo:hi] = self._scores(model, trie, slice(lo, hi))
        return out

    def _scores(self, model: Totals, trie: Trie, some: slice) -> np.ndarray:
        two, at_two = np.unique(self.pair(self.word[some], self.before[some]), return_inverse=True)
        distinct, at = np.unique(self.pair(at_two, self.earlier[some]), return_inverse=True)
        word, before, earlier = two[distinct // self.size] // self.size, two[distinct // self.size] % self.size, distinct % self.size
        one = _lookup(trie.words, self.vocabulary[word])
        unseen = np.log10(max(model.discount * model.types, 0.5) / max(model.tokens, 1))
        out = np.where(one >= 0, trie.log10p(1, one), unseen)
        found = trie.find(2, one, before, self.size)
        out = np.where(found >= 0, trie.log10p(2, found), out + np.log10(PRIOR[2] / (self.totals[before] + PRIOR[2])))
        has = earlier != self.none
        longer = trie.find(3, np.where(has, found, -1), earlier, self.size)
        weight = np.log10(PRIOR[3] / (self.pair_total(before, earlier) + PRIOR[3]))
        return np.where(longer >= 0, trie.log10p(3, longer), np.where(has, out + weight, out))[at]


def _asked(documents: DataFrame, n_parts: int, keys: list[int], sent) -> DataFrame:
    """(shard, vocabulary, n): for each shard of contexts the words it predicts and their training counts, without the most
    frequent words of the model that is ``sent`` to all tasks."""

    def ask(batches):
        for held in _chunks(batches):
            hashes = np.concatenate([x[2] for x in held])
            train = np.concatenate([np.repeat(x[1], np.diff(x[3])) for x in held])
            wanted = _shard(np.concatenate([previous(x[2], x[3])[0] for x in held]), n_parts)
            words, at = np.unique(hashes, return_inverse=True)
            rare = _lookup(sent.value.words, words) < 0
            pick = rare[at]
            words, at, train, wanted = words[rare], (np.cumsum(rare) - 1)[at[pick]], train[pick], wanted[pick]
            if not len(words):
                continue
            count = np.bincount(at[train], minlength=len(words))
            pairs = np.unique(at * n_parts + wanted)
            owner = _shard(words, n_parts)
            order = np.argsort(owner, kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            pairs = np.sort(rank[pairs // n_parts] * n_parts + pairs % n_parts)
            cut = np.searchsorted(owner[order], np.arange(n_parts + 1))
            ends = np.searchsorted(pairs // n_parts, np.arange(len(words) + 1))
            rows = []
            for s in np.flatnonzero(np.diff(cut)).tolist():
                lo, hi = cut[s], cut[s + 1]
                rows.append((keys[s], _steps(words[order[lo:hi]]), _planes(count[order[lo:hi]].astype(np.int32)), _planes(np.diff(ends[lo:hi + 1]).astype(np.int32)), _narrow(pairs[ends[lo]:ends[hi]] % n_parts, n_parts)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64(), *[pa.binary()] * 4], strict=True)], ["owner", "words", "n", "n_wanted", "wanted"])

    def answer(batches):
        parts = [(_summed(row[0]), _values(row[1], np.int32), _values(row[2], np.int32), _wide(row[3], n_parts))
                 for batch in batches for row in zip(*(batch.column(k).to_pylist() for k in range(1, 5)), strict=True)]
        if not parts:
            return
        words, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        count = np.bincount(at, np.concatenate([p[1] for p in parts]), len(words)).astype(np.int64)
        pairs = np.unique(np.concatenate([p[3] for p in parts]).astype(np.int64) * len(words) + np.repeat(at, np.concatenate([p[2] for p in parts])))
        cut = np.searchsorted(pairs, np.arange(n_parts + 1) * len(words))
        for s in np.flatnonzero(np.diff(cut)).tolist():
            pick = pairs[cut[s]:cut[s + 1]] % len(words)
            yield pa.RecordBatch.from_arrays([pa.array([keys[s]], pa.int64()), pa.array([_steps(words[pick])], pa.binary()), pa.array([_planes(count[pick])], pa.binary())], ["shard", "vocabulary", "n"])

    asked = documents.mapInArrow(releasing(ask), "owner long, words binary, n binary, n_wanted binary, wanted binary").repartition(n_parts, "owner")
    return asked.mapInArrow(releasing(answer), "shard long, vocabulary binary, n binary")


def _dealt(documents: DataFrame, n_parts: int, sent) -> DataFrame:
    """Occurrences packed by shard of the word before (documents, the hashes in use, the contexts and for each its
    occurrences), and beside them the counts of the predicted words, whose ids are null. Words are places among the
    most frequent ones of the model that is ``sent`` to all tasks, followed by the hashes in use."""
    keys = even_keys(documents.sparkSession, n_parts)
    kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 7]
    names = ["shard", "ids", "train", "vocabulary", "heads", "n", "word", "earlier", "doc"]

    def pack(held):
        ids = pa.concat_arrays([x[0] for x in held]).to_pylist()
        train = np.concatenate([x[1] for x in held])
        doc = np.repeat(np.arange(len(train), dtype=np.int32), np.concatenate([np.diff(x[3]) for x in held]))
        vocabulary, at = np.unique(np.concatenate([[START, NONE], *(x[2] for x in held)]), return_inverse=True)
        place = _lookup(sent.value.words, vocabulary)
        n_frequent, rare = len(sent.value.words), vocabulary[place < 0]
        number = np.where(place < 0, n_frequent - 1 + np.cumsum(place < 0), place).astype(np.int32)
        (start, none), pieces = number[at[:2]], np.split(number[at[2:]], np.cumsum([len(x[2]) for x in held])[:-1])
        around = [previous(p, x[3], start, none) for p, x in zip(pieces, held, strict=True)]
        columns = [np.concatenate(pieces), *(np.concatenate([x[k] for x in around]) for k in (0, 1))]
        of = np.empty(n_frequent + len(rare), np.int32)
        of[number] = _shard(vocabulary, n_parts)
        shard = of[columns[1]]
        order = np.lexsort((doc, columns[1], shard))
        cut = np.searchsorted(shard[order], np.arange(n_parts + 1))
        for s in np.flatnonzero(np.diff(cut)).tolist():
            pick = order[cut[s]:cut[s + 1]]
            found = [c[pick] for c in columns]
            used = np.unique(np.concatenate([x[x >= n_frequent] for x in found]))
            size = n_frequent + len(used)
            word, before, earlier = (np.where(x < n_frequent, x, n_frequent + np.searchsorted(used, x)) for x in found)
            heads, n = np.unique(before, return_counts=True)
            docs, of_doc = np.unique(doc[pick], return_inverse=True)
            yield (keys[s], [ids[d] for d in docs], train[docs].tobytes(), _steps(rare[used - n_frequent]), _narrow(heads, size), _planes(n.astype(np.int32)),
                   _narrow(word, size), _narrow(earlier, size), _narrow(of_doc, len(docs)))

    def deal(batches):
        for held in _chunks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pack(held), strict=True), kinds, strict=True)], names)

    occurrences = documents.mapInArrow(releasing(deal), "shard long, ids array<long>, train binary, " + ", ".join(f"{x} binary" for x in names[3:]))
    return occurrences.unionByName(_asked(documents, n_parts, keys, sent), allowMissingColumns=True).repartition(n_parts, "shard")


def _gathered(batches, model: Totals) -> Shard | None:
    """The occurrences of one shard; contexts in a block are in ascending order of their places."""
    n_frequent = len(model.words)
    parts, held, documents, counted, size, n_hashes = [], [model.words], [], [], 0, n_frequent

    def placed(places: np.ndarray) -> np.ndarray:
        return np.where(places < n_frequent, places, places.astype(np.int32) + (n_hashes - n_frequent)).astype(np.int32)

    for batch in batches:
        for row in range(len(batch)):
            own, n = (_values(batch.column(k)[row].as_buffer(), t) for k, t in ((3, np.uint64), (5, np.int64 if not batch.column(1)[row].is_valid else np.int32)))
            own = np.cumsum(own)
            if not batch.column(1)[row].is_valid:
                counted.append((own, n))
                continue
            ids = batch.column(1)[row].values
            train, heads, word, earlier, doc = (batch.column(k)[row].as_buffer() for k in (2, 4, 6, 7, 8))
            at, most = _wide(doc, len(ids)), n_frequent + len(own)
            before = np.repeat(placed(_wide(heads, most)), n)
            parts.append((placed(_wide(word, most)), before, placed(_wide(earlier, most)), at.astype(np.int32) + size, np.frombuffer(train, bool)[at]))
            held.append(own)
            documents.append(ids.fill_null(NO_ID).to_numpy())
            size += len(ids)
            n_hashes += len(own)
    if not parts:
        return None
    columns = [list(x) for x in zip(*parts, strict=True)]
    parts.clear()
    word, before, earlier, doc, train = (np.concatenate(columns.pop(0)) for _ in range(5))
    used = np.zeros(n_hashes, bool)
    for places in (word, before, earlier):
        used[places] = True
    vocabulary, at = np.unique(np.concatenate(held)[used], return_inverse=True)
    which = np.zeros(n_hashes, np.int32)
    which[used] = at
    count = np.zeros(len(vocabulary), np.int64)
    for words, n in [(model.words[used[:n_frequent]], model.counts[used[:n_frequent]]), *counted]:
        count[_lookup(vocabulary, words)] = n
    for places in (word, before, earlier):
        np.take(which, places, out=places)
    return Shard(vocabulary, count, word, before, earlier, doc, train, np.concatenate(documents))


def train_model(documents: DataFrame) -> DataFrame:
    """(shard, trie, contexts): the shards of the model of ``documents`` (text) as bytes for :meth:`Trie.from_buffer`, and the
    sorted hashes that keys of the trie are places in."""
    ship(documents.sparkSession)
    held = documents.select(F.lit(None).cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(True).alias("train"))
    sent = documents.sparkSession.sparkContext.broadcast(Totals(held))

    def build(batches):
        got = _gathered(batches, sent.value)
        if got:
            yield pa.RecordBatch.from_arrays([pa.array([int(tn.mix(got.vocabulary[got.before[:1]])[0] >> np.uint64(1))], pa.int64()), pa.array([got.trie(sent.value).to_bytes()], pa.binary()), pa.array([got.vocabulary.tobytes()], pa.binary())], ["shard", "trie", "contexts"])

    return _dealt(held, shuffle_partitions(documents.sparkSession), sent).mapInArrow(releasing(build), "shard long, trie binary, contexts binary")


def lm_scores(documents: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) per doc_id of ``documents`` (doc_id long, text, train boolean).

    The model learns from rows with ``train``. Tokens are words with A-Z lower-cased and one end for each text. score is the
    model's log10 probability of the text. base_score: that of the words alone, one added to each count. n_known: tokens
    that training has. Null and empty texts are an end alone; a null ``train`` is false. Rows that repeat a doc_id, or are without one, are summed
    together. An empty table gives an empty result; without training rows all words are unseen. Other columns are ignored.
    """
    spark = documents.sparkSession
    ship(spark)
    held = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.coalesce("train", F.lit(False)).alias("train"))
    model = Totals(held)
    sent = spark.sparkContext.broadcast(model)

    def score(batches):
        got = _gathered(batches, sent.value)
        if not got:
            return
        trie = Trie.from_buffer(got.trie(sent.value).to_bytes())
        made, count, word, doc, n = got.scores(sent.value, trie), got.count, got.word, got.doc, len(got.documents)
        names, of = np.unique(got.documents, return_inverse=True)
        del got, trie
        sums = np.empty(len(names), _SUMS)
        sums["doc"] = names
        for field, values in (("n_tokens", np.bincount(doc, minlength=n)), ("n_known", np.bincount(doc, (count > 0)[word], n)), ("base", np.bincount(doc, np.log10(count + 1.0)[word], n)), ("score", np.bincount(doc, made, n))):
            sums[field] = np.bincount(of, values, len(names))
        chunk = (tn.mix(sums["doc"].astype(np.uint64)) % np.uint64(n_parts)).astype(np.int64)
        order = np.argsort(chunk, kind="stable")
        ends = np.searchsorted(chunk[order], np.arange(n_parts + 1))
        full = np.flatnonzero(np.diff(ends)).tolist()
        yield pa.RecordBatch.from_arrays([pa.array([keys[c] for c in full], pa.int64()), pa.array([_planes(sums[order[ends[c]:ends[c + 1]]]) for c in full], pa.binary())], ["chunk", "sums"])

    def add(batches):
        parts = [_values(x, _SUMS) for batch in batches for x in batch.column("sums").to_pylist()]
        if not parts:
            return
        names, of = np.unique(np.concatenate([p["doc"] for p in parts]), return_inverse=True)
        made = [np.bincount(of, np.concatenate([p[f] for p in parts]), len(names)) for f in ("n_tokens", "n_known", "base", "score")]
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64(), mask=names == NO_ID), *[pa.array(x.astype(np.int64)) for x in made[:2]], *[pa.array(x) for x in made[2:]]], ["doc_id", "n_tokens", "n_known", "base", "score"])

    n_parts = shuffle_partitions(spark)
    keys = even_keys(spark, n_parts)
    partial = _dealt(held, n_parts, sent).mapInArrow(releasing(score), "chunk long, sums binary").repartition(n_parts, "chunk")
    out = partial.mapInArrow(releasing(add), "doc_id long, n_tokens long, n_known long, base double, score double")
    below = float(np.log10(model.tokens + model.types + 1))
    return out.select("doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * below).alias("base_score"), "score")
