"""Approximate nearest neighbours by collision counting.

Every vector is projected on LINES random lines; the index of a shard is one sorted array per line. Largest inner product is
nearest distance after scaling all vectors by the largest norm and completing them to unit length with one more coordinate;
the similarity of two vectors is then their inner product.

A query counts on the CHOSEN lines where it stands farthest from 0. Where it stands at z, a vector of similarity s is at
s * z, with deviation sqrt(1 - s**2), and one that has nothing to do with the query at 0: the outer parts of these lines hold
few vectors but the near ones. The window of s runs from the line's end to a little beyond s * z; as s falls (STEPS) it grows
(virtual rehashing), each step adding only the new part. A vector inside the windows of enough lines is verified with its
exact inner product. The search ends at the first s that enough verified vectors reach: nearer vectors would have collided
often enough with high probability. The last window is the whole line, which verifies what is left. Nothing else bounds the
candidates. A search begins at the step at which few of SAMPLE of the shard's own vectors have ended, so most take two or three.

Rows are dealt to shards by a hash of the identifier. A shard's rows come first in its task's stream, its arrays are
built once, and the queries stream past them in batches, so a task holds a shard and a batch whatever the number of
queries; the shards' lists are merged. Of the k nearest a shard holds its share by chance, so it looks no farther than for the
number that it exceeds once in a thousand times; all that it verifies counts. Equal vectors of a shard are indexed once, with
as many of their least ids as an answer can hold. Rows of other copies than these are not read again: base rows are shuffled
once, queries once a shard.

Vectors that are null, zero, or hold null or non-finite components take no part; a vector shorter than the longest
counts as filled up with zeros, which leaves every inner product as it is. Null ids take no part. Ties go to the smaller
id. A row repeated with one id and vector counts once; of different vectors with one id each is a candidate, the id is listed
once with its best score, and as a query it has the best of its vectors' answers. A null condition asks nothing. Empty
tables give empty results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb, erfc, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import concurrency
from .vec import ragged

LINES, CHOSEN = 1024, 64
#: Similarities of the windows; the last one, the whole line, follows.
STEPS = (0.9, 0.8, 0.7, 0.65, 0.6, 0.55, *(x / 1000 for x in range(525, 0, -25)))
#: How far beyond the expected place a window begins, in deviations and in parts of the way to the query's own place, at most;
#: and the standard deviations by which the threshold lies below the expected collisions.
BEYOND, WAY, SLACK = 1.0, 0.7, 1.5
#: Cells of a line in a unit, and of half a line: windows begin at a cell.
FINE, HALF = 64, 64 * 8
#: Own vectors of a shard that are searched for the first step, and the part of them that have ended by it.
SAMPLE, EARLY = 64, 0.25
#: Rows of a shard, at most, and at least where there are fewer than tasks; queries searched at once.
SHARD, SMALL_SHARD, QUERIES = 1 << 16, 1 << 14, 64


def share(k: int, shards: int) -> int:
    """How many of k rows dealt at random a shard exceeds less than once in a thousand times."""
    p, left = 1 / shards, 1.0
    for j in range(k):
        left -= comb(k, j) * p**j * (1 - p) ** (k - j)
        if left <= 1e-3:
            return max(1, j)
    return k


def cells(places: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(places * FINE) + HALF, 0, 2 * HALF - 1).astype(np.uint16)


class Shard:
    """Sorted projection arrays of some vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float, k: int, sought: int | None = None):
        vectors = np.ascontiguousarray(vectors)
        rows = vectors.view([("", vectors.dtype)] * vectors.shape[1]).ravel()
        _, first, same = np.unique(rows, return_index=True, return_inverse=True)
        self.vectors = vectors[first].astype(np.float64)
        n, by = len(first), np.lexsort((ids, same))
        same, ids = same[by], ids[by]
        kept = np.append(True, (np.diff(same) != 0) | (np.diff(ids) != 0))
        same, ids = same[kept], ids[kept]
        kept = np.arange(len(same)) - np.searchsorted(same, same) <= k
        self.ids, self.cuts = ids[kept], np.searchsorted(same[kept], np.arange(n + 1))
        self.plain = len(np.unique(self.ids)) == n == len(self.ids)
        unit = self.vectors / largest
        whole = np.column_stack([unit, np.sqrt(np.maximum(0, 1 - (unit**2).sum(axis=1)))]).astype(np.float32).T
        self.lines = np.random.Generator(np.random.PCG64(7)).standard_normal((LINES, len(whole))).astype(np.float32)
        self.order, self.before = [], np.zeros((LINES, 2 * HALF + 1), np.int64)
        for i in range(0, LINES, 32):
            for line, at in enumerate(cells(self.lines[i : i + 32] @ whole), i):
                self.order.append(np.argsort(at, kind="stable").astype(np.uint16 if n <= 1 << 16 else np.int32))
                self.before[line, 1:] = np.cumsum(np.bincount(at, minlength=2 * HALF))
        self.k, self.sought, self.largest = k, sought or k, largest
        sample = self.vectors[:: max(1, n // SAMPLE)][:SAMPLE]
        self.begin = int(np.quantile([end for end, _, _ in self._walk(sample, 0)], EARLY, method="lower"))

    def search(self, query_ids: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query ids, ids and scores of the queries' lists."""
        queries = queries.astype(np.float64)
        found = [self._best(own, q, near, scores) for own, q, (_, near, scores) in zip(query_ids, queries, self._walk(queries, self.begin), strict=True)]
        return np.repeat(query_ids, [len(x) for x, _ in found]), np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])

    def _walk(self, queries: np.ndarray, begin: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """For each query: the step at which its search ends, the vectors that it verified and their inner products."""
        n, norms = len(self.vectors), np.sqrt((queries**2).sum(axis=1))
        at = (queries / norms[:, None]).astype(np.float32) @ self.lines[:, :-1].T
        chosen = np.argpartition(-np.abs(at), CHOSEN - 1, axis=1)[:, :CHOSEN]
        at = np.take_along_axis(at, chosen, axis=1)
        right, at = at > 0, np.abs(at)
        # Counts of a block of queries are kept between steps; the highest bit marks verified vectors.
        counts = np.zeros((len(queries), n), np.uint8)
        edge = np.where(right, n, 0)
        found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in queries]
        ends, left = np.full(len(queries), len(STEPS)), np.arange(len(queries))
        for step in range(begin, len(STEPS) + 1):
            lines, outer = chosen[left], edge[left]
            need, inner = self._windows(step, lines, right[left], at[left])
            lo, hi, edge[left] = np.minimum(inner, outer).tolist(), np.maximum(inner, outer).tolist(), inner
            stay = []
            for i, q in enumerate(left.tolist()):
                parts = [self.order[line][a:b] for line, a, b in zip(lines[i].tolist(), lo[i], hi[i], strict=True) if a < b]
                if parts:
                    counts[q] += np.bincount(np.concatenate(parts), minlength=n).astype(np.uint8)
                    fresh = np.flatnonzero((counts[q] >= need[i]) & (counts[q] < 128))
                    counts[q, fresh] |= 128
                    found[q].append((fresh, self.vectors[fresh] @ queries[q]))
                if step < len(STEPS) and not self._enough(found[q], STEPS[step] * self.largest * norms[q]):
                    stay.append(q)
                else:
                    ends[q] = step
            left = np.array(stay, np.int64)
            if not len(left):
                break
        none = (np.zeros(0, np.int64), np.zeros(0))
        return [(int(end), *(np.concatenate(x) for x in zip(*(f or [none]), strict=True))) for end, f in zip(ends, found, strict=True)]

    def _windows(self, step: int, lines: np.ndarray, right: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The collisions that a vector of the step's similarity exceeds with high probability, by query, and where the window's inner end is in the lines' order."""
        if step == len(STEPS):
            return np.ones(len(at)), np.where(right, 0, len(self.vectors))
        s = STEPS[step]
        beyond = np.minimum(BEYOND, WAY * at.min(axis=1) * sqrt((1 - s) / (1 + s)))
        p = np.array([erfc(x / sqrt(2)) / 2 for x in beyond])
        cell = cells(s * at + beyond[:, None] * sqrt(1 - s * s)).astype(np.int64)
        return (CHOSEN * p - SLACK * np.sqrt(CHOSEN * p * (1 - p))).astype(np.int64), self.before[lines, np.where(right, cell, 2 * HALF - cell)]

    def _of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some vectors, and how many each has."""
        sizes = self.cuts[vectors + 1] - self.cuts[vectors]
        return self.ids[ragged(self.cuts[vectors], sizes)], sizes

    def _enough(self, found: list[tuple[np.ndarray, np.ndarray]], limit: float) -> bool:
        """Do as many ids as are sought, besides the query's own, reach the limit?"""
        if self.plain:
            return sum(np.count_nonzero(scores >= limit) for _, scores in found) > self.sought
        near = [vectors[scores >= limit] for vectors, scores in found]
        return bool(near) and len(np.unique(self._of(np.concatenate(near))[0])) > self.sought

    def _best(self, own: int, query: np.ndarray, near: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.plain and len(near) > self.k + 1:
            # Other products of the same vectors may differ in the last bits.
            cut = np.partition(scores, len(scores) - self.k - 1)[len(scores) - self.k - 1]
            near = near[scores >= cut - 1e-12 * abs(cut)]
        # Row by row, so that equal vectors of different shards have equal scores.
        scores = (self.vectors[near] * query).sum(axis=1)
        ids, sizes = self._of(near)
        scores = np.repeat(scores, sizes)[ids != own]
        ids = ids[ids != own]
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        first = np.sort(np.unique(ids, return_index=True)[1])[: self.k]
        return ids[first], scores[first]


def _search(k: int, size: int, largest: float, sought: int):
    """Of rows (shard, asked, vec_id, embedding) sorted by shard, base rows before queries: every query's list from the shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, shard = None, [], None
        for batch in batches:
            shards, asked = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(shards) != 0) | (np.diff(asked.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(shards)], strict=True):
                if a == b:
                    continue
                if shards[a] != now:
                    now, held, shard = shards[a], [], None
                ids, vectors = batch.column(2).to_numpy()[a:b], _matrix(batch.slice(a, b - a), size)
                if not asked[a]:
                    held.append((ids, vectors))
                    continue
                if shard is None and held:
                    shard, held = Shard(*(np.concatenate(x) for x in zip(*held, strict=True)), largest, k, sought), []
                for i in range(0, len(ids) if shard else 0, QUERIES):
                    found = shard.search(ids[i : i + QUERIES], vectors[i : i + QUERIES])
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    return run


def _matrix(batch: pa.RecordBatch, size: int) -> np.ndarray:
    """The vectors as rows of `size` components, filled up with zeros."""
    col = batch.column(3)
    sizes = np.diff(col.offsets.to_numpy())
    out = np.zeros((len(col), size), col.type.value_type.to_pandas_dtype())
    out[np.arange(size) < sizes[:, None]] = col.flatten().to_numpy()
    return out


def usable(vector: Column) -> Column:
    """Neither null, zero, nor with null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 20) -> DataFrame:
    """The k nearest of every query: query_id, rank, vec_id, score."""
    own = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").alias("embedding"), is_query.alias("asked"))
    own = own.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    n, size, largest = own.agg(F.count(F.lit(1)), F.max(F.size("embedding")), F.sqrt(F.max(norm))).first()
    tasks = concurrency(vectors.sparkSession)
    shards = max(1, -(-n // SHARD), min(tasks, -(-n // SMALL_SHARD)))
    base = own.select(F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asked"), "vec_id", "embedding")
    queries = own.where("asked").select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(True).alias("asked"), "vec_id", "embedding")
    streamed = base.union(queries).repartition(max(shards, tasks), "shard").sortWithinPartitions("shard", "asked")
    found = streamed.mapInArrow(_search(k, size or 0, largest or 1.0, share(k, shards)), "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
