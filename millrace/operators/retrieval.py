"""Nearest items of a few stated queries, with an unknown answer where the best are too close.

Items and queries are packed into blocks, and each pair of blocks is compared as matrices. A product of unit vectors in single
precision, with a bound on its error, only says which pairs may be among the best; their cosines are summed in double
precision, component by component, and Spark rounds and ranks them. Equal vectors of a block are compared once.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: At most this many queries are broadcast; more are compared in blocks of about as many.
BROADCAST_ROWS = 100_000
#: Rows of a block of items, at most, and at least where there are fewer than tasks; rows of a block of queries, and how many of
#: these are compared at once; bytes of any block.
ITEMS, FEW_ITEMS, QUERIES, AT_ONCE, BLOCK_BYTES = 1 << 14, 1 << 12, 1 << 10, 1 << 8, 1 << 24
#: Numbers that one step of the sums holds.
STEP = 1 << 21


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def _sums(rows: np.ndarray) -> np.ndarray:
    """Of each row, added from left to right as `dot` does."""
    return np.add.accumulate(rows, axis=1)[:, -1] if rows.shape[1] else np.zeros(len(rows))


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of each run."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def _since(new: np.ndarray) -> np.ndarray:
    """How many rows ago the last True was."""
    at = np.arange(len(new))
    return at - np.maximum.accumulate(np.where(new, at, 0))


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Where any of the keys differs from the row before; the first row does."""
    out = np.ones(len(keys[0]), bool)
    if len(out):
        out[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return out


class Vectors:
    """Vectors as rows of doubles, with their lengths and norms; one that is null or holds a null has the length -1."""

    def __init__(self, col: pa.ListArray):
        self.length = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        sizes, flat = np.maximum(self.length, 0), col.flatten()
        self.rows = np.zeros((len(col), max(sizes, default=0)))
        self.rows[np.arange(self.rows.shape[1]) < sizes[:, None]] = flat.to_numpy(zero_copy_only=False)
        if flat.null_count:
            self.length[np.repeat(np.arange(len(col)), sizes)[flat.is_null().to_numpy(zero_copy_only=False)]] = -1
        self.rows[self.length < 0] = 0
        self._measure()

    def _measure(self) -> None:
        self.norm = np.sqrt(_sums(self.rows * self.rows))

    def keep(self, some: np.ndarray) -> None:
        self.rows, self.length = self.rows[some], self.length[some]
        self._measure()

    def plain(self, length: int) -> np.ndarray:
        """Which have the length and a norm whose products neither vanish nor overflow."""
        return (self.length == length) & (self.norm > 1e-100) & (self.norm < 1e100)

    def unit(self, some: np.ndarray) -> np.ndarray:
        return (self.rows[some] / self.norm[some, None]).astype(np.float32)


def _cosines(a: Vectors, b: Vectors, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The same as `cosine` of the pairs (i, j)."""
    width, out = min(a.rows.shape[1], b.rows.shape[1]), np.zeros(len(i))
    step = max(1, STEP // max(1, width))
    for at in range(0, len(i), step):
        x, y = i[at : at + step], j[at : at + step]
        under = a.norm[x] * b.norm[y]
        some = (a.length[x] == b.length[y]) & (a.length[x] >= 0) & (under != 0)
        x, y = x[some], y[some]
        out[at : at + step][some] = _sums(a.rows[x, :width] * b.rows[y, :width]) / under[some]
    return out


class Items:
    """A block of items in order of their ids; of equal vectors one is compared, and the ids that an answer can hold are listed."""

    def __init__(self, table: pa.Table, k: int):
        table = table.take(pc.sort_indices(table.column(0))).combine_chunks()
        self.ids, self.k = table.column(0).chunk(0), k
        self.names = pc.unique(self.ids)
        self.code = pc.index_in(self.ids, value_set=self.names).to_numpy()
        self.vectors = Vectors(table.column(1).chunk(0))
        rows = np.column_stack([self.vectors.rows, self.vectors.length])
        _, first, same = np.unique(rows.view([("", rows.dtype)] * rows.shape[1]).view(f"V{rows.itemsize * rows.shape[1]}").ravel(), return_index=True, return_inverse=True)
        self.vectors.keep(first)
        # An answer leaves out one id, its query's own, and no id fills more than k places.
        at = np.argsort(same, kind="stable")
        at = at[_since(_changes(same[at], self.code[at])) < k]
        at = at[_since(_changes(same[at])) < 2 * k]
        self.members, self.cuts = at, np.searchsorted(same[at], np.arange(len(first) + 1))
        codes, starts = self.code[at], self.cuts[:-1]
        alone = np.minimum.reduceat(codes, starts) == np.maximum.reduceat(codes, starts)
        lengths, counts = np.unique(self.vectors.length, return_counts=True)
        self.usual = int(lengths[np.argmax(counts)])
        plain = self.vectors.plain(self.usual)
        self.plain, self.odd = np.flatnonzero(plain), np.flatnonzero(~plain)
        self.units = np.ascontiguousarray(self.vectors.unit(self.plain).T)
        #: Of the plain vectors: the code of the only id that has it, or -1.
        self.sole = np.where(alone, codes[starts], -1)[self.plain]
        self.by_sole = np.argsort(self.sole, kind="stable")

    def search(self, names: pa.Array, vectors: Vectors, digits: int) -> Iterator[tuple[np.ndarray, ...]]:
        """Parts (query, place of the item, cosine) which hold all that can be among the k best of each query."""
        own = pc.fill_null(pc.index_in(names, value_set=self.names), -2).to_numpy(zero_copy_only=False)
        plain = vectors.plain(self.usual)
        for q in np.flatnonzero(~plain):
            yield self._best(np.full(len(self.cuts) - 1, q), np.arange(len(self.cuts) - 1), own, vectors, digits)
        plain = np.flatnonzero(plain)
        for at in range(0, len(plain) if len(self.plain) else 0, AT_ONCE):
            q, group = self._near(plain[at : at + AT_ONCE], own, vectors, digits)
            yield self._best(q, self.plain[group], own, vectors, digits)
        step = max(1, STEP // max(1, self.vectors.rows.shape[1] * len(self.odd)))
        for at in range(0, len(plain) if len(self.odd) else 0, step):
            some = plain[at : at + step]
            yield self._best(np.repeat(some, len(self.odd)), np.tile(self.odd, len(some)), own, vectors, digits)

    def _near(self, some: np.ndarray, own: np.ndarray, vectors: Vectors, digits: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, plain vector) that may be among the k best by their product in single precision."""
        found = vectors.unit(some) @ self.units
        low, high = (np.searchsorted(self.sole, own[some], side, sorter=self.by_sole) for side in ("left", "right"))
        for i in np.flatnonzero(low < high):
            found[i, self.by_sole[low[i] : high[i]]] = -np.inf
        # The k-th largest of the maxima of runs is a lower bound of the k-th largest.
        n, runs = found.shape[1], found.shape[1] // 64
        heads = found[:, : runs * 64].reshape(len(some), 64, runs).max(axis=1) if runs >= 4 * self.k else found
        bound = np.partition(heads, heads.shape[1] - self.k)[:, heads.shape[1] - self.k] if n >= self.k else np.full(len(some), -np.inf, np.float32)
        slack = 2 * (len(self.units) + 8) * 2.0**-23 + 1.01 * 10.0**-digits + 1e-6
        i, j = np.nonzero(found >= (bound - np.float32(slack))[:, None])
        return some[i], j

    def _best(self, q: np.ndarray, group: np.ndarray, own: np.ndarray, vectors: Vectors, digits: int) -> tuple[np.ndarray, ...]:
        """The k best of each query by rounded cosine and id, and those whose rounding is Spark's to decide."""
        score = _cosines(vectors, self.vectors, q, group)
        sizes = np.diff(self.cuts)[group]
        at = self.members[_ragged(self.cuts[group], sizes)]
        q, score = np.repeat(q, sizes), np.repeat(score, sizes)
        other = self.code[at] != own[q]
        q, at, score = q[other], at[other], score[other]
        scaled = np.where(np.isnan(score), np.inf, score * 10.0**digits)
        near = 1e-4 + 10.0**digits * 1e-15
        low, high = np.floor(scaled + 0.5 - near), np.floor(scaled + 0.5 + near)
        order = np.lexsort((at, -low, q))
        q, at, score, low, high = (x[order] for x in (q, at, score, low, high))
        place = _since(_changes(q))
        last = np.flatnonzero(place == self.k - 1)
        bound = np.full(max(q, default=0) + 1, -np.inf)
        bound[q[last]] = low[last]
        keep = (place < self.k) | ((low < high) & (high >= bound[q]))
        return q[keep], at[keep], score[keep]


def _pack(rows: int):
    """Blocks of at most so many rows: a random key and the rows as an Arrow stream."""

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        sink, table = pa.BufferOutputStream(), pa.Table.from_batches(held).combine_chunks()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return pa.RecordBatch.from_arrays([pa.array([os.urandom(16)], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["key", "rows"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            at, most = 0, min(rows, max(1, BLOCK_BYTES * batch.num_rows // max(1, batch.nbytes)))
            while at < batch.num_rows:
                if n >= most:
                    yield block(held)
                    held, n = [], 0
                held.append(batch.slice(at, most - n))
                at, n = at + held[-1].num_rows, n + held[-1].num_rows
        if held:
            yield block(held)

    return run


def _compare(k: int, digits: int, schema: pa.Schema):
    """Of pairs of blocks (key, items, queries): query_id, item_id and cosine of all that can be among a query's k best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = items = None
        for batch in batches:
            for i in range(batch.num_rows):
                with np.errstate(all="ignore"):
                    if (key := batch.column(0)[i].as_py()) != now:
                        now, items = key, Items(pa.ipc.open_stream(batch.column(1)[i].as_buffer()).read_all(), k)
                    asked = pa.ipc.open_stream(batch.column(2)[i].as_buffer()).read_all().combine_chunks()
                    ids, vectors = asked.column(0).chunk(0), Vectors(asked.column(1).chunk(0))
                    found = list(items.search(asked.column(2).chunk(0), vectors, digits))
                for q, at, score in found:
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(q)), items.ids.take(pa.array(at)), pa.array(score)], schema=schema)

    return run


def top_k(queries: DataFrame, items: DataFrame, id_col: str, vector: str, k: int, digits: int = 6) -> DataFrame:
    """The k most similar items of every query, itself excluded: query_id, rank, item_id, similarity.

    A few stated queries are broadcast, and the items stream past them; more of them are cut into blocks, and each task
    compares one block with one partition of the items. Rows without an id take no part.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    spark, n, of = items.sparkSession, queries.count(), items.count()
    name, vectors = F.col(id_col), F.col(vector)
    kind, own = queries.schema[id_col].dataType, items.schema[id_col].dataType

    def numbers(df: DataFrame) -> Column:
        element = df.schema[vector].dataType.elementType.simpleString()
        return (vectors if element in ("float", "double") else vectors.cast("array<double>")).alias("vector")

    packed = "key binary, rows binary"
    q = queries.where(name.isNotNull()).select(name.alias("query_id"), numbers(queries), (name if kind == own else name.try_cast(own)).alias("own"))
    if n <= BROADCAST_ROWS:
        q = F.broadcast(q.coalesce(1).mapInArrow(_pack(QUERIES), packed).withColumnRenamed("rows", "asked"))
    else:
        q = q.repartition(-(-n // BROADCAST_ROWS), "query_id").mapInArrow(_pack(QUERIES), packed).withColumnRenamed("rows", "asked").hint("shuffle_replicate_nl")
    # Whole rounds of the tasks that run at once, if the blocks do not get too small by it.
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    parts = max(1, min(-(-of // (ITEMS * tasks)) * tasks, -(-of // FEW_ITEMS)))
    i = items.where(name.isNotNull()).select(name.alias("item_id"), numbers(items)).repartition(parts).mapInArrow(_pack(ITEMS), packed)
    pairs = i.crossJoin(q.drop("key")).select("key", "rows", "asked")
    shape = StructType([StructField("query_id", kind), StructField("item_id", own), StructField("similarity", DoubleType())])
    scored = pairs.mapInArrow(_compare(k, digits, to_arrow_schema(shape)), shape).withColumn("similarity", F.round("similarity", digits))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity"), "item_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def open_set(top: DataFrame, labels: DataFrame, id_col: str, label: str, margin: float = 0.02) -> DataFrame:
    """Per query the label of the best item, or `unknown` if another label comes within the margin."""
    named = top.join(labels.select(F.col(id_col).alias("item_id"), F.col(label).alias("__l")), "item_id")
    best = named.groupBy("query_id", "__l").agg(F.max("similarity").alias("s"))
    order = Window.partitionBy("query_id").orderBy(F.desc("s"), "__l")
    two = best.withColumn("r", F.row_number().over(order)).where("r <= 2")
    wide = two.groupBy("query_id").agg(F.max(F.when(F.col("r") == 1, F.col("s"))).alias("s1"), F.max(F.when(F.col("r") == 2, F.col("s"))).alias("s2"), F.max(F.when(F.col("r") == 1, F.col("__l"))).alias("l"))
    sure = F.col("s2").isNull() | (F.round(F.col("s1") - F.col("s2"), 6) > margin)
    return wide.select("query_id", F.when(sure, F.col("l").cast("string")).otherwise("unknown").alias("answer"))
