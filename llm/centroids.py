"""Clustering round centroids, the nearest found by equal-average equal-variance search.

Vectors are whole numbers, so distances, means and ties are exact and do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.base import ship

#: Squared distances and sums of up to LONG_PARTS components of this size fit 64 bits; others use Python's whole numbers.
LONG_COMPONENT, LONG_PARTS = 1 << 23, 128
PIECE = 4096


class Centroids:
    """Centroids in ascending order of the sum of their components, ready to be searched."""

    def __init__(self, centroids: np.ndarray):
        self.long = _fits(centroids)
        vectors = centroids.astype(np.int64) if self.long else centroids.astype(object)
        self.parts = vectors.shape[1]
        sums = vectors.sum(axis=1)
        order = np.argsort(sums, kind="stable")
        self.number, self.vectors, self.sums = order, vectors[order], sums[order]
        self.spread = _spread(self.vectors, self.sums)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid's number, the smaller of equals, and the exact squared distance of each vector.

        With k components, sums S and spreads V (the root of the summed squared deviations from the mean):
        distance >= (S - S')**2 / k, and distance >= (S - S')**2 / k + (V - V')**2. Each vector looks at centroids by
        growing difference of sums and ends at the first beyond the best distance so far; on the way those that the second
        bound rejects are passed over. Sums are compared exactly, spreads with a margin for rounding, and only what
        is certainly farther is passed over.
        """
        if not (self.long and _fits(vectors)):
            return self._nearest(vectors.astype(object), self.vectors.astype(object), self.sums.astype(object))
        return self._nearest(vectors, self.vectors, self.sums)

    def _nearest(self, x: np.ndarray, centroids: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, last = len(x), len(centroids)
        own = x.sum(axis=1)
        spread = _spread(x, own)
        best, which = np.zeros(n, x.dtype), np.full(n, -1, np.int64)
        above = np.searchsorted(sums, own)  # the next centroid to look at with a sum that is not smaller
        below = above - 1
        going = np.arange(n)
        while len(going):
            up, down = above[going], below[going]
            over = sums[np.minimum(up, last - 1)] - own[going]
            under = own[going] - sums[np.maximum(down, 0)]
            rise = (down < 0) | ((up < last) & (over <= under))
            at, gap = np.where(rise, up, down), np.where(rise, over, under)
            fresh = which[going] < 0
            far = ~fresh & (gap * gap > self.parts * best[going]).astype(bool)
            going, at, gap, rise, fresh = going[~far], at[~far], gap[~far], rise[~far], fresh[~far]
            margin = np.maximum(np.abs(spread[going] - self.spread[at]) - 1e-6 * (1 + spread[going] + self.spread[at]), 0)
            bound = gap.astype(float) ** 2 / self.parts * (1 - 1e-9) + margin**2
            look = fresh | (bound * (1 - 1e-9) <= best[going].astype(float))
            some, c = going[look], at[look]
            apart = x[some] - centroids[c]
            distance = (apart * apart).sum(axis=1)
            better = fresh[look] | (distance < best[some]).astype(bool) | ((distance == best[some]).astype(bool) & (self.number[c] < which[some]))
            best[some[better]], which[some[better]] = distance[better], self.number[c[better]]
            above[going] += rise
            below[going] -= ~rise
            going = going[(below[going] >= 0) | (above[going] < last)]
        return which, best


def _fits(vectors: np.ndarray) -> bool:
    return vectors.shape[1] <= LONG_PARTS and (not vectors.size or int(np.abs(vectors).max()) <= LONG_COMPONENT)


def _spread(vectors: np.ndarray, sums: np.ndarray) -> np.ndarray:
    apart = vectors.astype(float) - (sums.astype(float) / vectors.shape[1])[:, None]
    return np.sqrt((apart * apart).sum(axis=1))


def whole_vectors(column, parts: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of an Arrow list column with ``parts`` finite components, and floor(``scale`` * component) of these."""
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(valid & (np.diff(offsets) == parts))
    values = column.values.fill_null(np.nan).to_numpy(zero_copy_only=False)
    values = values[offsets[rows][:, None] + np.arange(parts)] if len(rows) else np.zeros((0, parts))
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    finite = np.isfinite(scaled).all(axis=1)
    rows, scaled = rows[finite], scaled[finite]
    if scaled.size and np.abs(scaled).max() > LONG_COMPONENT:
        return rows, np.array([[int(v) for v in row] for row in scaled.tolist()], object)
    return rows, scaled.astype(np.int64)


def _pieces(batches, parts: int, scale: int):
    for batch in batches:
        for start in range(0, len(batch), PIECE):
            piece = batch.slice(start, PIECE)
            rows, vectors = whole_vectors(piece.column("embedding"), parts, scale)
            yield piece.column("vec_id").take(pa.array(rows)), vectors


def _text(numbers) -> str:
    return ",".join(map(str, numbers))


def _numbers(text: str) -> np.ndarray:
    return np.array([int(v) for v in text.split(",")], object)


def _start(rows: DataFrame, k: int, parts: int, scale: int, seed: str) -> np.ndarray:
    """The k vectors whose hashed ids come first; ids in decimal after the seed and a colon, equal ids by their components."""
    def numbered(batches):
        first: list[tuple[str, str]] = []  # of this task: no more than k are needed of it
        for ids, vectors in _pieces(batches, parts, scale):
            named = ids.is_valid().to_numpy(zero_copy_only=False)
            keys = [hashlib.sha256(f"{seed}:{i}".encode()).hexdigest() for i in ids.filter(pa.array(named)).to_pylist()]
            places = np.flatnonzero(named)
            limit = first[-1][0] if len(first) == k else "~"
            first = sorted([*first, *[(key, _text(vectors[at].tolist())) for key, at in zip(keys, places, strict=True) if key <= limit]])[:k]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in first], pa.string()), pa.array([x[1] for x in first], pa.string())], ["key", "numbers"])

    first = rows.mapInArrow(numbered, "key string, numbers string").orderBy("key", "numbers").limit(k).collect()
    return np.array([_numbers(r["numbers"]) for r in first], object).reshape(len(first), parts)


def _means(rows: DataFrame, centroids: np.ndarray, parts: int, scale: int) -> np.ndarray:
    """Each centroid replaced by the floor of the mean of its vectors.

    Every task sends one row of sums for each of its clusters; these are added up in two steps, so the driver gets one
    row for each cluster whatever the number of tasks.
    """
    context = rows.sparkSession.sparkContext
    sent = context.broadcast(Centroids(centroids))
    k = len(centroids)

    def table(totals: dict[int, list]):
        return pa.RecordBatch.from_arrays([pa.array(list(totals), pa.int32()), pa.array([v[0] for v in totals.values()], pa.int64()), pa.array([_text(v[1]) for v in totals.values()], pa.string())], ["cluster", "n", "sums"])

    def partial(batches):
        totals: dict[int, list] = {}
        for _, vectors in _pieces(batches, parts, scale):
            which, _ = sent.value.nearest(vectors)
            for c in np.unique(which).tolist():
                own = vectors[which == c]
                n, sums = totals.setdefault(c, [0, np.zeros(parts, object)])
                totals[c] = [n + len(own), sums + own.sum(axis=0)]
        yield table(totals)

    def add(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            for c, n, text in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                have = totals.setdefault(c, [0, np.zeros(parts, object)])
                totals[c] = [have[0] + n, have[1] + _numbers(text)]
        yield table(totals)

    kind = "cluster int, n long, sums string"
    sums = rows.mapInArrow(partial, kind)
    for salts in (16, 1):
        dealt = sums.withColumn("salt", F.pmod(F.hash("sums"), F.lit(salts)))
        sums = dealt.repartition(F.col("cluster"), F.col("salt")).select("cluster", "n", "sums").mapInArrow(add, kind)
    out = centroids.astype(object)
    for c, n, text in sums.collect():
        if not 0 <= c < k:
            raise ValueError(f"no cluster {c}")
        out[c] = [v // n for v in _numbers(text)]
    sent.unpersist()
    return out


def cluster_vectors(embeddings: DataFrame, k: int = 40, rounds: int = 5, parts: int = 64, scale: int = 256, seed: str = "2") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) per row of ``embeddings`` (vec_id, embedding) that is kept.

    Kept are vectors of exactly ``parts`` components that are neither null nor non-finite (also not after scaling); component x
    becomes floor(scale * x). The centroids start as the k vectors whose hashed ids come first. Each round assigns all
    vectors to the nearest centroid by squared Euclidean distance, the smaller number of equals, and replaces each that
    has vectors by the floor of their mean; then vectors are assigned once more. ``inertia`` is the sum of distances.

    Null and empty vectors are left out. Rows without vec_id are clustered, but none of them is a first centroid.
    Repeated rows are vectors of their own; repeated ids among the first are ordered by their components. With fewer
    than k vectors there are as many centroids; an empty table gives an empty result. Sums or distances beyond 64 bits
    are null. Other columns are ignored. The table is read once for each step: pass a written one.
    """
    spark = embeddings.sparkSession
    ship(spark)
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    centroids = _start(rows, k, parts, scale, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _means(rows, centroids, parts, scale)
    schema = "vec_id long, cluster int, distance decimal(38,0)"
    if not len(centroids):
        assigned = spark.createDataFrame([], schema)
    else:
        sent = spark.sparkContext.broadcast(Centroids(centroids))

        def assign(batches):
            for ids, vectors in _pieces(batches, parts, scale):
                which, distance = sent.value.nearest(vectors)
                exact = pa.array(distance) if distance.dtype != object else pa.array([d if d < 10**37 else None for d in distance.tolist()], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays([ids, pa.array(which, pa.int32()), exact.cast(pa.decimal128(38, 0))], ["vec_id", "cluster", "distance"])

        assigned = rows.mapInArrow(assign, schema)
    long = lambda c: F.col(c).try_cast("long").alias(c)
    sums = {r["cluster"]: r["total"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    whole = None if None in sums.values() else sum(sums.values())
    # One row for each of the k centroids.
    known = spark.createDataFrame([(c, total, whole, [str(v) for v in centroids[c]]) for c, total in sorted(sums.items())],
                                  "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid array<string>")
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", long("distance"), long("cluster_inertia"), long("inertia"), "centroid")
