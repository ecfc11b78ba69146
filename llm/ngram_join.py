"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Rows with the same n-grams are one class. The columns are put into one global order, rare ones first, by a count
sketch over all documents. Two sets can reach the similarity only if they share a column among the first
``n - ceil(t n) + 1`` of each, so a first product over these columns, dealt out in blocks of columns, accumulates partial
overlaps and discards pairs whose sizes or remaining columns rule out the bound. A second product accumulates the
exact overlaps of the surviving pairs, block by block, and discards those below the bound.

Pairs inside one group of near copies are not all formed: early rounds pair the members of a column with one member
per range of sizes, then with some of the column's largest component, and join what links. Long columns are cut into
parts for that, so no task gets a whole one. The last round takes every pair that shares a column and is still in
different components: short columns are multiplied as before; documents of long ones meet in blocks of rows by
blocks of rows, each with its whole prefix, so a block knows all columns that a pair shares and passes on only pairs
within the bounds. No link between components is lost, because such a pair shares a column and is tested in that round.
"""

from __future__ import annotations

from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm import textnum as tn
from llm.base import Scratch, by_bucket, components, marked, releasing, ship, shuffle_partitions, slices, summed_counts

SKETCH_BITS = 20  # 4 MB of counts, whatever the input; it only orders columns, so a coarse count costs time, not links
FILTER_BITS = 24  # of the set of candidate documents: 2 MB, whatever their number; false hits are removed by a join
COLUMN_BLOCKS = 4
PAIRS_AT_ONCE = 1 << 18
EARLY_ROUNDS = 3
# These three decide where a pair is tested and not whether: the members of a part of a column in the early rounds, the
# members from which a column is multiplied by blocks in the last one, and the bytes of prefixes in a block of rows.
PART = 256
LONG = 64
BLOCK_BYTES = 1 << 19


def _sets(batch: pa.RecordBatch, n: int):
    """Per text the sorted distinct n-gram hashes."""
    for piece in slices(batch, "text"):
        raw, offsets = tn.text_bytes(piece.column("text"))
        starts, ends, first = tn.words(raw, offsets)
        grams, at = tn.shingles(tn.word_hashes(raw, starts, ends), first, n)
        yield piece, [np.unique(grams[at[i]:at[i + 1]]) for i in range(len(piece))]


def _sketch(documents: DataFrame, n: int) -> np.ndarray:
    """How many texts have an n-gram of each hash slot: partial sums by task, summed by slice of slots."""
    def numbers(batches):
        for batch in batches:
            for _, sets in _sets(batch, n):
                if sets:
                    yield (np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)

    return summed_counts(documents.select("text"), numbers, 1 << SKETCH_BITS)


def _prefixes(documents: DataFrame, n: int, share: Fraction) -> DataFrame:
    """Per row: doc_id, the class key (two hashes of the set and its size) and the prefix columns, rarest first."""
    sketch = documents.sparkSession.sparkContext.broadcast(_sketch(documents, n))
    p, q = share.numerator, share.denominator

    def make(batches):
        for batch in batches:
            for piece, sets in _sets(batch, n):
                keys, others, sizes, columns = [], [], [], []
                for s in sets:
                    size = len(s)
                    keys.append(int(s.sum(dtype=np.uint64).view(np.int64)) if size else 0)
                    others.append(int(tn.mix(s ^ tn.ODD[5]).sum(dtype=np.uint64).view(np.int64)) if size else 0)
                    sizes.append(size)
                    keep = size - -(-p * size // q) + 1 if size else 0
                    rank = sketch.value[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    if keep < size:
                        some = np.flatnonzero(rank <= np.partition(rank, keep - 1)[keep - 1])
                        some = some[np.lexsort((s[some], rank[some]))[:keep]]
                    else:
                        some = np.lexsort((s, rank))
                    columns.append(s[some].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id").cast(pa.int64()), pa.array(keys, pa.int64()), pa.array(others, pa.int64()), pa.array(sizes, pa.int64()), pa.array(columns, pa.binary())],
                    ["doc_id", "key", "other", "n_shingles", "columns"])

    return documents.select("doc_id", "text").mapInArrow(releasing(make), "doc_id long, key long, other long, n_shingles long, columns binary")


_POSTING = np.dtype([("gram", "<u8"), ("doc", "<i8"), ("size", "<i4"), ("pos", "<i4")])
_ROW = "gram long, doc long, size int, pos int, n int"


def _postings(classes: DataFrame) -> DataFrame:
    """(gram, doc, size, pos, n) of every prefix column that n classes (rep, n_shingles, columns) have, two at least.

    Most columns have one member and are gone after this step. Rows travel packed by block of columns.
    """
    n_parts = shuffle_partitions(classes.sparkSession)
    n_blocks = min(16 * max(64, n_parts), 65536)

    def deal(batches):
        for batch in batches:
            held = [np.frombuffer(c, np.uint64) for c in batch.column("columns").to_pylist()]
            if not held:
                continue
            lengths = np.array([len(h) for h in held])
            rows = np.empty(lengths.sum(), _POSTING)
            rows["gram"] = np.concatenate(held)
            rows["doc"] = np.repeat(batch.column("rep").to_numpy(), lengths)
            rows["size"] = np.repeat(batch.column("n_shingles").to_numpy(), lengths)
            rows["pos"] = np.arange(len(rows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            order, at = by_bucket((tn.mix(rows["gram"]) % np.uint64(n_blocks)).astype(np.int64), n_blocks)
            rows = rows[order]
            full = np.flatnonzero(np.diff(at))
            yield pa.RecordBatch.from_arrays([pa.array(full), pa.array([rows[at[k]:at[k + 1]].tobytes() for k in full], pa.binary())], ["block", "postings"])

    def shared(batches):
        held = [np.frombuffer(b, _POSTING) for batch in batches for b in batch.column("postings").to_pylist()]
        if not held:
            return
        rows = np.concatenate(held)
        held.clear()
        grams, counts = np.unique(rows["gram"], return_counts=True)
        n = counts[np.searchsorted(grams, rows["gram"])].astype(np.int32)
        rows, n = rows[n > 1], n[n > 1]
        yield pa.RecordBatch.from_arrays([pa.array(rows["gram"].view(np.int64)), *(pa.array(rows[k]) for k in ("doc", "size", "pos")), pa.array(n)], ["gram", "doc", "size", "pos", "n"])

    packed = classes.select("rep", "n_shingles", "columns").mapInArrow(releasing(deal), "block long, postings binary")
    return packed.repartition(n_parts, "block").mapInArrow(releasing(shared), _ROW)


def _in_components(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    """``rows`` with comp, the component of doc; a document without links is its own."""
    if roots is None:
        return rows.withColumn("comp", F.col("doc"))
    return rows.join(roots.toDF("doc", "root"), "doc", "left").select(*rows.columns, F.coalesce("root", "doc").alias("comp"))


def _candidates(postings: DataFrame, roots: DataFrame | None, share: Fraction, turn: int | None) -> DataFrame:
    """Pairs (a, b, na, nb) of class ids that pass the bounds after the product over the prefix columns.

    turn 0: the members of a part of a column are paired with the first of their range of sizes. 1, 2, ...: members
    outside the part's largest component are paired with 8, 64, ... of its members. None: all pairs in different
    components that share a column of at most LONG members.
    """
    t, p, q = float(share), share.numerator, share.denominator
    if turn is None:
        postings = postings.where(F.col("n") <= LONG)
    part = F.pmod(F.xxhash64("doc", F.lit(turn or 0)), F.ceil(F.col("n") / PART)).cast("int")
    labelled = _in_components(postings.select("gram", part.alias("part"), "doc", "size", "pos"), roots)

    def emit(rows, left, right):
        a, b = rows[np.concatenate(left)], rows[np.concatenate(right)]
        swap = a["doc"] > b["doc"]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        good = (a["doc"] != b["doc"]) & (q * np.minimum(a["size"], b["size"]).astype(np.int64) >= p * np.maximum(a["size"], b["size"]))
        # Columns before the shared one and columns after it bound the overlap.
        most = 1 + np.minimum(a["pos"], b["pos"]) + np.minimum(a["size"] - a["pos"], b["size"] - b["pos"]) - 1
        good &= (p + q) * most.astype(np.int64) >= p * (a["size"].astype(np.int64) + b["size"])
        a, b = a[good], b[good]
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (a["doc"], b["doc"], a["size"], b["size"], a["pos"], b["pos"])], ["a", "b", "na", "nb", "pa", "pb"])

    def tries(docs, sizes, comps):
        if turn:
            names, counts = np.unique(comps, return_counts=True)
            largest = comps == names[np.argmax(counts)]
            own, other = np.flatnonzero(largest), np.flatnonzero(~largest)
            chance = tn.mix(docs[own].astype(np.uint64) ^ tn.ODD[turn % len(tn.ODD)])
            yield from ((x, other) for x in own[np.argsort(chance)[:8 ** turn]])
            return
        ends = np.searchsorted(sizes, (sizes / t).astype(np.int64) + 1, side="right")
        at = 0
        while at < len(docs) - 1:
            yield at, at + 1 + np.flatnonzero(comps[at + 1:ends[at]] != comps[at])
            at = at + 1 if turn is None else max(int(ends[at]), at + 1)

    def multiply(batches):
        held = list(batches)
        if not held:
            return
        rows = {k: np.concatenate([b.column(k).to_numpy() for b in held]) for k in ("gram", "part", "doc", "size", "pos", "comp")}
        held.clear()
        rows = np.rec.fromarrays(list(rows.values()), names=list(rows))
        rows = rows[np.lexsort((rows["doc"], rows["size"], rows["part"], rows["gram"]))]
        cut = np.concatenate([[0], np.flatnonzero((rows["gram"][1:] != rows["gram"][:-1]) | (rows["part"][1:] != rows["part"][:-1])) + 1, [len(rows)]])
        left, right, waiting = [], [], 0
        for k in np.flatnonzero(np.diff(cut) > 1):
            lo, hi = int(cut[k]), int(cut[k + 1])
            for x, other in tries(rows["doc"][lo:hi], rows["size"][lo:hi], rows["comp"][lo:hi]):
                if len(other):
                    right.append(lo + other)
                    left.append(np.full(len(other), lo + x))
                    waiting += len(other)
                if waiting >= PAIRS_AT_ONCE:
                    yield emit(rows, left, right)
                    left, right, waiting = [], [], 0
        if waiting:
            yield emit(rows, left, right)

    dealt = labelled.repartition(shuffle_partitions(postings.sparkSession), "gram", "part")
    partial = dealt.mapInArrow(releasing(multiply), "a long, b long, na long, nb long, pa long, pb long")
    summed = partial.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("shared"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    # Before the last round the columns a pair shares elsewhere are not all known: a pair that fails here is tried again there.
    rest = F.least(F.col("na") - 1 - F.col("pa"), F.col("nb") - 1 - F.col("pb"))
    summed = summed.where((p + q) * (F.col("shared") + rest) >= p * (F.col("na") + F.col("nb")))
    return summed.select("a", "b", "na", "nb")


def _block_candidates(postings: DataFrame, classes: DataFrame, roots: DataFrame, share: Fraction) -> DataFrame:
    """Pairs (a, b, na, nb) in different components that share a column of more than LONG members and pass the bounds.

    Such a column belongs to the group of its largest component. The group's outer documents, those of other
    components, meet each other and its inner ones in blocks of rows by blocks of rows.
    """
    p, q = share.numerator, share.denominator
    long = _in_components(postings.where(F.col("n") > LONG).select("gram", "doc"), roots)
    counted = long.groupBy("gram", "comp").agg(F.count(F.lit(1)).alias("n"))
    groups = counted.groupBy("gram").agg(F.max(F.struct("n", "comp"))["comp"].alias("group"), F.count(F.lit(1)).alias("n_comps")).where("n_comps > 1").select("gram", "group")
    members = long.join(groups, "gram").select("group", "doc", "comp", (F.col("comp") != F.col("group")).alias("outer")).distinct()
    prefixes = classes.select(F.col("rep").alias("doc"), "n_shingles", "columns")
    members = members.join(prefixes.select("doc", F.length("columns").alias("bytes")).groupBy("doc").agg(F.sum("bytes").alias("bytes")), "doc")
    blocks = members.groupBy("group").agg(*(F.ceil(F.coalesce(F.sum(F.when(side, F.col("bytes"))), F.lit(0)) / BLOCK_BYTES).cast("int").alias(name) for side, name in ((F.col("outer"), "n_outer"), (~F.col("outer"), "n_inner"))))
    placed = members.join(blocks, "group").withColumn("block", F.when(F.col("outer"), F.pmod(F.xxhash64("doc"), F.col("n_outer"))).otherwise(F.col("n_outer") + F.pmod(F.xxhash64("doc"), F.col("n_inner"))).cast("int"))
    others = F.when(F.col("outer"), F.sequence(F.lit(0), F.col("n_outer") + F.col("n_inner") - 1)).otherwise(F.sequence(F.lit(0), F.col("n_outer") - 1))
    met = placed.select("group", "doc", "comp", "block", F.explode(others).alias("other"))
    met = met.select("group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "doc", "comp", (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right"))

    def product(table: pa.Table) -> pa.Table:
        docs, sizes, comps = (table.column(k).to_numpy().astype(np.int64) for k in ("doc", "n_shingles", "comp"))
        held = [np.frombuffer(c, np.uint64) for c in table.column("columns").to_pylist()]
        left, right = (np.flatnonzero(table.column(k).to_numpy(zero_copy_only=False)) for k in ("left", "right"))
        whose = np.repeat(right, [len(held[k]) for k in right])
        grams = np.concatenate([held[k] for k in right]) if len(right) else np.zeros(0, np.uint64)
        places = np.concatenate([np.arange(len(held[k])) for k in right]) if len(right) else np.zeros(0, np.int64)
        order = np.argsort(grams, kind="stable")
        whose, places, grams = whose[order], places[order], grams[order]
        shared, last, own = (np.zeros(len(docs), np.int64) for _ in range(3))
        found = []
        for k in left:
            lo, hi = (np.searchsorted(grams, held[k], side=s) for s in ("left", "right"))
            lengths = hi - lo
            at = np.repeat(lo - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            hit = whose[at]
            np.add.at(shared, hit, 1)
            np.maximum.at(last, hit, places[at])
            np.maximum.at(own, hit, np.repeat(np.arange(len(lengths)), lengths))
            seen = np.unique(hit)
            rest = np.minimum(sizes[k] - own[seen], sizes[seen] - last[seen]) - 1
            good = (comps[seen] != comps[k]) & (docs[seen] != docs[k]) & (q * np.minimum(sizes[seen], sizes[k]) >= p * np.maximum(sizes[seen], sizes[k]))
            good &= (p + q) * (shared[seen] + rest) >= p * (sizes[seen] + sizes[k])
            found += [(min(docs[k], docs[x]), max(docs[k], docs[x]), *((sizes[k], sizes[x]) if docs[k] < docs[x] else (sizes[x], sizes[k]))) for x in seen[good]]
            shared[seen] = last[seen] = own[seen] = 0
        made = np.array(found, np.int64).reshape(-1, 4)
        return pa.table([pa.array(made[:, k]) for k in range(4)], ["a", "b", "na", "nb"])

    # Few documents are in a group: the prefixes of the others stay where they are.
    prefixes = marked(prefixes, "doc", members.select("doc")).where("hit").drop("hit")
    tested = met.join(prefixes, "doc").groupBy("group", "low", "high").applyInArrow(product, "a long, b long, na long, nb long")
    return tested.distinct()


def _links(documents: DataFrame, pairs: DataFrame, n: int, share: Fraction, scratch: Scratch) -> DataFrame:
    """The pairs (a, b), as a written table, whose exact overlap, accumulated over blocks of columns, reaches the similarity."""
    spark = documents.sparkSession
    p, q = share.numerator, share.denominator
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    bits = wanted.select(slot.alias("slot")).groupBy(F.expr("slot div 32").alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 32 as int)))").alias("bits")).collect()
    mask = np.zeros(1 << (FILTER_BITS - 5), np.int64)
    for row in bits:
        mask[row["at"]] = row["bits"]
    filled = spark.sparkContext.broadcast(mask)

    def make(batches):
        for batch in batches:
            at = batch.column("slot").to_numpy()
            hit = np.flatnonzero((filled.value[at >> 5] >> (at & 31)) & 1)
            if not len(hit):
                continue
            for piece, sets in _sets(batch.take(pa.array(hit)), n):
                ids = piece.column("doc_id").to_pylist()
                out = [(i, k, part) for i, s in zip(ids, sets, strict=True) for k in range(COLUMN_BLOCKS) if len(part := s[s % np.uint64(COLUMN_BLOCKS) == k])]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2].view(np.int64) for x in out], pa.list_(pa.int64()))], ["doc_id", "block", "grams"])

    sets = documents.where("doc_id is not null").select("doc_id", "text", slot.alias("slot")).mapInArrow(releasing(make), "doc_id long, block int, grams array<long>")
    sets = scratch.written(sets, "ngram-sets")
    # Repeated rows of an id are rare and their sets are tried one by one.
    spread = pairs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(COLUMN_BLOCKS - 1))))
    met = (spread.join(sets.select(F.col("doc_id").alias("a"), "block", F.col("grams").alias("ga")), ["a", "block"])
           .join(sets.select(F.col("doc_id").alias("b"), "block", F.col("grams").alias("gb")), ["b", "block"])
           .select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("long").alias("part")))
    links = scratch.written(met.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("shared")).where(
        q * F.col("shared") >= p * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b"), "ngram-links")
    scratch.drop(sets)
    return links


def ngram_jaccard_join(documents: DataFrame, n: int = 4, share: Fraction = Fraction(85, 100)) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``documents`` (doc_id long, text).

    A row's set are its distinct n-word shingles, words being runs of other than white space with A-Z lower-cased; all
    words as one shingle where there are fewer than n. Rows link when the Jaccard similarity of their sets is ``share``
    or more. component_id is the smallest doc_id reachable over links.

    Null text counts as empty; an empty set links with nothing, so its row is its own component. Rows that repeat a
    doc_id are one document with the links of all of them; n_shingles is each row's own. A null doc_id gets the
    component of its class of equal sets, null where the class has no other row. An empty table gives an empty result;
    other columns are ignored. Sets are compared by 64-bit hashes of their n-grams.
    """
    ship(documents.sparkSession)
    scratch = Scratch()
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = scratch.written(_prefixes(documents, n, share), "ngram-rows")
    filled = rows.where("n_shingles > 0 and doc_id is not null")
    classes = scratch.written(filled.groupBy("key", "other", "n_shingles").agg(F.min("doc_id").alias("rep"), F.first("columns").alias("columns")), "ngram-classes")
    members = rows.select("doc_id", "key", "other", "n_shingles").join(classes.select("key", "other", "n_shingles", "rep"), ["key", "other", "n_shingles"], "left")
    members = scratch.written(members, "ngram-members")
    scratch.drop(rows)
    owned = members.where("rep is not null and doc_id is not null")
    repeated = owned.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1 and a < b").select("doc_id", "a")
    repeated = owned.join(repeated, "doc_id").select("a", F.col("rep").alias("b"))

    postings = scratch.written(_postings(classes), "ngram-postings")
    links, tried, roots = [scratch.written(repeated, "ngram-links")], [], None
    for turn in (*range(EARLY_ROUNDS), None):
        if turn is None or turn:
            scratch.drop(roots)
            roots = components(_all(links), scratch=scratch)
        pairs = _candidates(postings, roots, share, turn)
        if turn is None:
            pairs = pairs.union(_block_candidates(postings, classes, roots, share)).distinct()
        if tried:
            pairs = pairs.join(_all(tried).select("a", "b"), ["a", "b"], "left_anti")
        tried.append(scratch.written(pairs, "ngram-pairs"))
        links.append(_links(documents, tried[-1], n, share, scratch))
    scratch.drop(classes, postings, roots, *tried)
    roots = components(_all(links), scratch=scratch)
    scratch.drop(*links)
    return (members.join(roots, members["rep"] == roots["node"], "left")
            .select("doc_id", "n_shingles", F.coalesce("root", "rep", "doc_id").alias("component_id")))


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, frames)
