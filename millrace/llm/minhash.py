"""Near-duplicate groups by fast similarity sketching, banding and exact verification.

Sketch: t bins are filled in at most 2 t rounds. In each of the first t rounds every shingle is hashed to a bin and
a value; a bin keeps the least (round, value), so an early round is never overwritten. In round t + j every
shingle is offered to bin j, which guarantees that all bins are filled. A text leaves the rounds when its bins
are full, mostly after a few.

Stages, all over the whole table:
1. Texts with one set of shingles form a class, named by two 64-bit sums and the size; a class is sketched once.
2. Band keys are range-sorted, ties by class; each sorted part joins neighbours with equal keys, and the ends of the
   parts are joined afterwards, so no key is ever gathered. Connected classes form a neighbourhood.
3. Within each neighbourhood the links are confirmed on full sets, by breadth-first search over texts not yet
   reached: a set must share one of its (1 - threshold) rarest shingles with any set it links to. Only a spanning
   forest is emitted. A neighbourhood beyond BLOCK shingles is dealt over blocks which share some members as
   pivots, each text once but for the pivots. What it still lacks are links between texts that share a band but no
   group. They are sought in units: the whole neighbourhood, whose members outside its largest group are compared with
   all its members, in blocks; or those of its bands that hold texts of several groups (bands of equal members once),
   each for itself. Of the two ways, both exact, the one that moves fewer shingles is taken: a crowd of copies has few
   members outside its largest group, a web of chance collisions has small bands.
4. The confirmed forests' connected components are the groups; unconfirmed collisions never join two texts.

Only stage 2 is probabilistic: with 40 bands of 7 a pair at similarity 0.85 shares no band with probability 2e-7;
with 48 bands of 6, a pair at 0.8 with probability 5e-7.

Nulls and texts without words: an empty set, linked with nothing, a group of its own. A null id is never the
least id; a group without ids has a null component_id. Repeated rows are copies. Empty tables give empty results.
Columns of the input keep their names, whatever they are: the operator's own take other names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vec
from .common import Scratch, concurrency, fresh, slices
from .graph import components

#: Bands and rows of a band, by the least similarity (in percent) that they are meant for.
BANDS = {85: (40, 7), 0: (48, 6)}
#: Shingles of a neighbourhood that one task confirms at once; larger ones are dealt over blocks.
BLOCK = 1 << 15
#: Pivots that the blocks of a large neighbourhood share. Blocks hold twice as many texts at least, unless these have
#: FEW_LARGE blocks' worth of shingles.
PIVOTS, FEW_LARGE = 32, 16
#: Bands are looked at where comparing a neighbourhood's texts whole would move each this many times (there are 40 or 48 bands).
MANY_TIMES = 16
U = np.uint64


def _shingles(col: pa.Array, size: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Names of all shingles of a batch in two lanes, and where each row's begin."""
    data, offsets = vec.utf8(col)
    starts, ends, before = vec.words(data, offsets)
    counts = np.diff(before)
    room = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    first = vec.ragged(before[:-1], room)
    last = first + np.repeat(np.minimum(counts, size), room)
    lanes = vec.wide_names(data, starts, ends, lower=True)
    return [vec.span_names(names, first, last, 5 + lane) for lane, names in enumerate(lanes)], np.concatenate([[0], np.cumsum(room)]), room


def shingle_sets(col: pa.Array, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle names of each text: A-Z lowered, words by white space, whole text if shorter."""
    (shingles, _), cuts, _ = _shingles(col, size)
    return [np.unique(shingles[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _named_sets(col: pa.Array, size: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The sets, and two names of each: a sum over its shingles, and the ends of their other lane."""
    (shingles, other), cuts, room = _shingles(col, size)
    sets = [np.unique(shingles[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    name1 = np.array([vec.mix(s, 21).sum(dtype=U) for s in sets], U)
    name2, full = np.zeros(len(sets), U), np.flatnonzero(room)
    if len(full):
        low, high = (f.reduceat(other, cuts[full]) for f in (np.minimum, np.maximum))
        name2[full] = vec.mix(vec.mix(low, 22) ^ high, 23)
    return sets, name1.view(np.int64), name2.view(np.int64)


def sketch(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Fast similarity sketches of non-empty sets, one row each."""
    empty = U((1 << 64) - 1)
    out = np.full(len(sets) * bins, empty, U)
    if not sets:
        return out.reshape(0, bins)
    sizes = np.array([len(s) for s in sets])
    items, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    for r in range(2 * bins):
        h = vec.mix(items, 1000 + r)
        bin_ = ((h >> U(40)) * U(bins) >> U(24)).astype(np.int64) if r < bins else r - bins
        np.minimum.at(out, row * bins + bin_, (U(r) << U(40)) | (h & U((1 << 40) - 1)))
        short = (out.reshape(-1, bins) == empty).any(axis=1)
        if not short.any():
            break
        left = short[row]
        if not left.all():
            items, row = items[left], row[left]
    return out.reshape(-1, bins)


def band_keys(sets: list[np.ndarray], percent: int) -> np.ndarray:
    bands, rows = next(BANDS[p] for p in sorted(BANDS, reverse=True) if percent >= p)
    full = sketch(sets, bands * rows).reshape(len(sets), bands, rows)
    key = np.tile(vec.mix(np.arange(bands, dtype=U), 77), (len(sets), 1))
    for j in range(rows):
        key = vec.mix(key ^ full[:, :, j], 80 + j)
    return key


def _mark(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets, name1, name2 = _named_sets(batch.column(0), size)
            n = np.array([len(s) for s in sets])
            # A set of n shingles cannot reach the threshold with a different set unless n / (n + 1) does.
            able = np.flatnonzero(100 * n >= percent * (n + 1))
            keys = np.empty(len(sets), object)
            for k, row in zip(able, band_keys([sets[k] for k in able], percent).view(np.int64), strict=True):
                keys[k] = row
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    pa.array(n, pa.int64()),
                    pa.array(name1),
                    pa.array(name2),
                    pa.array([[] if k is None else k for k in keys], pa.list_(pa.int64())),
                ],
                names=["uid", "n", "name1", "name2", "keys"],
            )

    return run


class Union:
    """Union-find in which the least member is the root."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (p := up.setdefault(x, x)) != x:
            up[x] = up.setdefault(p, p)
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


_FOREST = "a long, b long, key long"


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted (key, uid): a spanning forest of equal keys, and the part's two ends with their keys."""
    union, last_key, last_uid, first = Union(), None, None, None
    for batch in batches:
        keys, uids = (batch.column(i).to_numpy() for i in (0, 1))
        if not len(keys):
            continue
        if last_key is None:
            first = (int(keys[0]), int(uids[0]))
        elif int(keys[0]) == last_key:
            union.join(last_uid, int(uids[0]))
        same = np.flatnonzero(keys[1:] == keys[:-1])
        for x, y in zip(uids[same].tolist(), uids[same + 1].tolist(), strict=True):
            union.join(x, y)
        last_key, last_uid = int(keys[-1]), int(uids[-1])
    if first is None:
        return
    pairs = [(x, r, None) for x in union.up if (r := union.find(x)) != x]
    pairs += [(first[1], first[1], first[0]), (last_uid, last_uid, last_key)]
    for i in range(0, len(pairs), 1 << 16):
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs[i : i + (1 << 16)], strict=True)], names=["a", "b", "key"])


class Sets:
    """An inverted index of some sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.cuts = np.concatenate([[0], np.cumsum(self.size)])
        _, self.flat, self.count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        order = np.argsort(self.flat, kind="stable")
        self.holder = np.repeat(np.arange(len(sets)), self.size)[order]
        self.at = np.cumsum(self.count) - self.count
        self.mine = np.zeros(len(self.count), bool)

    def links(self, v: int, among: np.ndarray, percent: int) -> np.ndarray:
        """Which sets of the mask `among` have 100 * intersection >= percent * union with set v."""
        own = self.flat[self.cuts[v] : self.cuts[v + 1]]
        n = len(own)
        need = -(-percent * n // 100)
        rare = own[np.argsort(self.count[own], kind="stable")[: n - need + 1]]
        seen = np.unique(self.holder[vec.ragged(self.at[rare], self.count[rare])])
        seen = seen[among[seen]]
        seen = seen[(100 * self.size[seen] >= percent * n) & (100 * n >= percent * self.size[seen])]
        if not len(seen):
            return seen
        self.mine[own] = True
        sizes = self.size[seen]
        hits = self.mine[self.flat[vec.ragged(self.cuts[seen], sizes)]]
        common = np.add.reduceat(hits.astype(np.int64), np.cumsum(sizes) - sizes)
        self.mine[own] = False
        return seen[100 * common >= percent * (n + sizes - common)]


def forest(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For each set the first set of its component, all links confirmed."""
    index, root = Sets(sets), np.full(len(sets), -1)
    open_ = np.ones(len(sets), bool)
    for seed in range(len(sets)):
        if not open_[seed]:
            continue
        root[seed], open_[seed], queue = seed, False, [seed]
        while queue:
            found = index.links(queue.pop(), open_, percent)
            open_[found], root[found] = False, seed
            queue += found.tolist()
    return root


def _confirm(size: int, percent: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("uid")
        uid = group["uid"].to_numpy()
        root = forest(shingle_sets(group["text"].combine_chunks(), size), percent)
        return pa.table({"a": pa.array(uid), "b": pa.array(uid[root])})

    return run


def _compare(size: int, percent: int):
    """Links between the members marked `outside` and the others of a block, in other groups."""

    def run(group: pa.Table) -> pa.Table:
        uid, root, outside = (group[c].to_numpy() for c in ("uid", "root", "outside"))
        index = Sets(shingle_sets(group["text"].combine_chunks(), size))
        pairs = []
        for v in np.flatnonzero(outside):
            found = index.links(v, ~outside & (root != root[v]), percent)
            _, one = np.unique(root[found], return_index=True)
            pairs += [(int(root[v]), int(root[w])) for w in found[one]]
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    return run


def _n_blocks(shingles: Column, members: Column) -> Column:
    """Blocks of a neighbourhood or band: by its shingles, but a few long texts stay together unless they are very long."""
    dealt = F.least(F.ceil(shingles / F.lit(BLOCK)), F.ceil(members / F.lit(2 * PIVOTS)))
    return F.greatest(dealt, F.ceil(shingles / F.lit(BLOCK * FEW_LARGE))).cast("int")


def _numbers(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), n.cast("long") - 1))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """(base, found): base has the columns of `docs` and, as its last, a row number; found has uid (that number), doc_id,
    n, component_id, chosen."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "near")
    (own,) = fresh(docs.columns, "__uid")
    base = scratch.cut(docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.monotonically_increasing_id().alias(own)), "base")
    texts = base.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(own).alias("uid"))
    marks = scratch.cut(texts.mapInArrow(_mark(size, percent), "uid long, n long, name1 long, name2 long, keys array<long>"), "marks")
    ids = base.select(F.col(own).alias("uid"), F.col(f"`{id_col}`").alias("doc_id"))
    classes = scratch.cut(marks.where("n > 0").groupBy("n", "name1", "name2").agg(F.min("uid").alias("class")), "classes")

    keyed = marks.join(classes.select(F.col("class").alias("uid")), "uid", "left_semi").select(F.explode("keys").alias("key"), "uid")
    ranged = keyed.repartitionByRange(concurrency(spark), "key", "uid").sortWithinPartitions("key", "uid")
    near = scratch.cut(ranged.mapInArrow(_neighbours, _FOREST), "near")
    ends = near.where("key is not null")
    ends = ends.join(ends.groupBy("key").agg(F.min("a").alias("least")), "key").select("a", F.col("least").alias("b"))
    neighbourhood = components(near.where("key is null").select("a", "b").union(ends), scratch, "near")

    sized = neighbourhood.join(marks.select(F.col("uid").alias("node"), "n"), "node")
    hoods = sized.groupBy(F.col("root").alias("hood")).agg(F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("m"))
    hoods = hoods.withColumn("blocks", _n_blocks(F.col("all_n"), F.col("m")))
    members = neighbourhood.select(F.col("node").alias("uid"), F.col("root").alias("hood")).join(hoods, "hood")
    members = scratch.cut(members.withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks").cast("long"))), "members")
    large = members.where("blocks > 1")
    pivots = large.where(F.pmod(F.xxhash64("uid", F.lit(1)), F.ceil(F.col("m") / F.lit(PIVOTS)).cast("long")) == 0)
    guests = pivots.select("uid", "hood", F.col("block").alias("own"), _numbers(F.col("blocks")).alias("block"))
    placed = members.select("uid", "hood", "block").union(guests.where("block <> own").select("uid", "hood", "block"))
    confirmed = placed.join(texts, "uid").groupBy("hood", "block").applyInArrow(_confirm(size, percent), "a long, b long")
    links = scratch.cut(confirmed, "links")
    if not large.isEmpty():
        links = links.union(_across(links, large, marks, texts, scratch, size, percent))
    groups = components(links, scratch, "links")
    return base, _found(marks, classes, ids, groups.select(F.col("node").alias("class"), "root"), scratch)


def _across(links: DataFrame, large: DataFrame, marks: DataFrame, texts: DataFrame, scratch: Scratch, size: int, percent: int) -> DataFrame:
    """The links that the blocks of large neighbourhoods could not see: between texts that share a band but no group yet."""
    wide, once = F.lit(BLOCK * FEW_LARGE), F.lit(1).cast("long")
    joined = components(links, scratch, "blocks")
    own = large.select("uid", "hood").join(joined.withColumnRenamed("node", "uid"), "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    own = scratch.cut(own.join(marks.select("uid", "n", "keys"), "uid"), "own")

    # What comparing whole neighbourhoods moves, in shingles; one group needs nothing more.
    groups = own.groupBy("hood", "root").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("m"))
    hoods = groups.groupBy("hood").agg(F.sum("n").alias("all_n"), F.max(F.struct("n", "m", "root")).alias("main"), F.sum("m").alias("m"))
    hoods = hoods.select("hood", "all_n", "m", (F.col("all_n") - F.col("main.n")).alias("rest_n")).where("rest_n > 0")
    of_hood = hoods.withColumn("blocks", _n_blocks(F.col("all_n"), F.col("m"))).withColumn("cost", F.col("all_n") * F.greatest(once, F.ceil(F.col("rest_n") / wide)) + F.col("rest_n") * F.col("blocks"))
    of_hood = scratch.cut(of_hood, "hoods")

    # Where that is much more than each text once: the bands with texts of several groups, those of equal members once.
    costly = of_hood.where(F.col("cost") > F.lit(MANY_TIMES) * F.col("all_n"))
    banded = own.join(costly.select("hood"), "hood", "left_semi").select("hood", F.explode("keys").alias("unit"), "uid", "n", "root")
    of_band = banded.groupBy("hood", "unit").agg(
        F.min("root").alias("r1"), F.max("root").alias("r2"), F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("m"), F.bit_xor(F.xxhash64("uid")).alias("x"), F.bit_xor(F.xxhash64("uid", F.lit(5))).alias("y")
    )
    bands = of_band.where("r1 <> r2").groupBy("hood", "m", "all_n", "x", "y").agg(F.min("unit").alias("unit"))
    bands = scratch.cut(bands.select("hood", "unit", "all_n", _n_blocks(F.col("all_n"), F.col("m")).alias("blocks")), "bands")
    # A costly neighbourhood without such bands has no pair left that shares one.
    moved = costly.join(bands.groupBy("hood").agg(F.sum("all_n").alias("moved")), "hood", "left")
    few = moved.select("hood", (F.coalesce("moved", F.lit(0)) < F.col("cost")).alias("few"))
    by_band = scratch.cut(of_hood.join(few, "hood", "left").select("hood", "blocks", F.coalesce("few", F.lit(False)).alias("few")), "ways")

    whole = own.join(by_band.where("not few").select("hood", "blocks"), "hood").select(F.lit(0).alias("way"), F.col("hood").alias("unit"), "uid", "n", "root", "blocks")
    chosen = bands.join(by_band.where("few").select("hood"), "hood", "left_semi").select("hood", "unit", "blocks")
    parts = banded.join(chosen, ["hood", "unit"]).select(F.lit(1).alias("way"), "unit", "uid", "n", "root", "blocks")
    held = scratch.cut(whole.union(parts), "held")
    small = held.where("blocks = 1").select("way", "unit", "uid").join(texts, "uid")
    found = scratch.cut(small.groupBy("way", "unit").applyInArrow(_confirm(size, percent), "a long, b long"), "small")
    split = held.where("blocks > 1")
    if split.isEmpty():
        return found
    unit = ["way", "unit"]
    per_root = split.groupBy(*unit, "root").agg(F.sum("n").alias("k"))
    main = per_root.groupBy(*unit).agg(F.max(F.struct("k", "root")).alias("main")).select(*unit, F.col("main.root").alias("main"))
    rest = split.join(main, unit).where("root <> main")
    shares = rest.groupBy(*unit).agg(F.ceil(F.sum("n") / wide).cast("int").alias("parts"))
    rest = scratch.cut(rest.join(shares, unit).select(*unit, "uid", "root", "blocks", "parts"), "rest")
    part = F.pmod(F.xxhash64("uid", F.lit(2)), F.col("parts").cast("long")).alias("part")
    block = F.pmod(F.xxhash64("uid", F.lit(3)), F.col("blocks").cast("long")).alias("block")
    outside = rest.select(*unit, "uid", "root", part, _numbers(F.col("blocks")).alias("block"), F.lit(True).alias("outside"))
    others = split.join(shares, unit).select(*unit, "uid", "root", _numbers(F.col("parts")).alias("part"), block, F.lit(False).alias("outside"))
    compared = outside.union(others).join(texts, "uid").groupBy(*unit, "block", "part").applyInArrow(_compare(size, percent), "a long, b long")
    return found.union(scratch.cut(compared, "wide"))


def _found(marks: DataFrame, classes: DataFrame, ids: DataFrame, groups: DataFrame, scratch: Scratch) -> DataFrame:
    rooted = scratch.cut(classes.join(groups, "class", "left").withColumn("root", F.coalesce("root", "class")), "rooted")
    rows = marks.select("uid", "n", "name1", "name2").join(rooted, ["n", "name1", "name2"], "left")
    rows = rows.select("uid", "n", F.coalesce("root", "uid").alias("root")).join(ids, "uid")
    rows = scratch.cut(rows, "rows")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("uid"))).alias("best")
    least = scratch.cut(rows.groupBy("root").agg(best), "least")
    return rows.join(least, "root").select("uid", "doc_id", "n", F.col("best.doc_id").alias("component_id"), (F.col("uid") == F.col("best.uid")).alias("chosen"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 85) -> DataFrame:
    """The rows of `docs` that stay, one of each group (the least id), with all their columns."""
    base, found = near_groups(docs, id_col, text_col, size, percent)
    own = base.columns[-1]
    return base.join(found.where("chosen").select(F.col("uid").alias(own)), own, "left_semi").drop(own)
