"""Asset banks and placement: the metadata side of synthetic composition."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_int


def required_split(product: Column, special: dict[str, str], usual: str = "train_seen") -> Column:
    """The split that a product's sources must come from; some products have one of their own."""
    out = F.lit(usual)
    for p, s in special.items():
        out = F.when(product == p, s).otherwise(out)
    return out


#: Gates on masks and cut-outs (fixed values): bounds of the ratios, and the least side in pixels.
CUTOUT = {"area": (0.20, 1.28), "fill": 0.93, "side": (0.48, 1.24)}
MASK = {"area": (0.18, 1.10), "least": 24}
PREPARED = {"area": (0.14, 1.22), "fill": 0.94, "least": 24}


def cutout_gate(area: Column, fill: Column, width: Column, height: Column, touches: Column) -> Column:
    """Area, fill and side ratios within bounds, and no touch of the crop's edge; missing values fail."""
    low, high = CUTOUT["side"]
    sides = width.between(low, high) & height.between(low, high)
    return F.coalesce(area.between(*CUTOUT["area"]) & (fill <= CUTOUT["fill"]) & sides & ~touches, F.lit(False))


def mask_gate(area: Column, width: Column, height: Column, touches: Column) -> Column:
    return F.coalesce(area.between(*MASK["area"]) & (width >= MASK["least"]) & (height >= MASK["least"]) & ~touches, F.lit(False))


def prepared_gate(area: Column, fill: Column, width: Column, height: Column, touches: Column) -> Column:
    least = (width >= PREPARED["least"]) & (height >= PREPARED["least"])
    return F.coalesce(area.between(*PREPARED["area"]) & (fill <= PREPARED["fill"]) & least & ~touches, F.lit(False))


def gated(df: DataFrame, gate: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that do not): both sides are kept."""
    marked = df.withColumn("__ok", F.coalesce(gate, F.lit(False)))
    return marked.where("__ok").drop("__ok"), marked.where("not __ok").drop("__ok")


def asset_bank(candidates: DataFrame, product: str, order: list[str], passes: Column, quota: int, existing: DataFrame | None = None) -> DataFrame:
    """Per product the first passing candidates in order until the quota, existing assets counted: adds asset_index.

    Ranks beyond the quota are cut before the shuffle.
    """
    nth = F.row_number().over(Window.partitionBy(product).orderBy(*order)) - 1
    first = candidates.where(F.coalesce(passes, F.lit(False))).withColumn("__nth", nth).where(F.col("__nth") < quota)
    if existing is None:
        return first.withColumnRenamed("__nth", "asset_index")
    have = existing.groupBy(F.col(product).alias("__p")).agg(F.count(F.lit(1)).alias("__have"))
    joined = first.join(have, F.col(product) == F.col("__p"), "left").withColumn("asset_index", F.col("__nth") + F.coalesce("__have", F.lit(0)))
    return joined.where(F.col("asset_index") < quota).drop("__p", "__have", "__nth")


def best_candidate(df: DataFrame, keys: list[str], score: str, order: str) -> DataFrame:
    """Per key the candidate of the highest score; of equal ones the first."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(score), -F.col(order))).alias("__b")).select(*keys, "__b.*")


#: Centres for 2, 3 and 4 objects, as shares of the canvas (fixed values).
PATTERNS = {
    2: [[(0.28, 0.34), (0.72, 0.66)], [(0.30, 0.66), (0.72, 0.34)], [(0.32, 0.50), (0.70, 0.50)]],
    3: [[(0.28, 0.30), (0.72, 0.34), (0.50, 0.72)], [(0.30, 0.68), (0.50, 0.30), (0.74, 0.68)], [(0.28, 0.36), (0.70, 0.50), (0.34, 0.74)]],
    4: [[(0.28, 0.28), (0.72, 0.30), (0.30, 0.72), (0.72, 0.72)], [(0.34, 0.25), (0.72, 0.40), (0.28, 0.62), (0.66, 0.78)]],
}
#: The jitter of a centre as a share of the canvas, and how far later tries move in pixels across and down (fixed values).
JITTER = 0.055
REACH = (120, 150)


def centre(image: Column, size: Column, slot: Column, width: int, height: int, seed: str) -> tuple[Column, Column]:
    """The centre of a slot: a pattern for the image and a jitter for the slot, both hashed. More than 4 objects use the pattern of 4."""
    listed = F.create_map(
        *[
            x
            for n, ps in PATTERNS.items()
            for x in (F.lit(n), F.array(*[F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in p]) for p in ps]))
        ]
    )
    choices = F.element_at(listed, F.least(F.greatest(size, F.lit(2)), F.lit(4)))
    pattern = F.get(choices, (hash_int(seed, image) % F.size(choices)).cast("int"))
    spot = F.get(pattern, slot % F.size(pattern))

    def place(axis: int, side: int) -> Column:
        reach = int(side * JITTER)
        return F.bround(spot[axis] * side + (hash_int(seed, image, slot, F.lit(axis)) % (2 * reach + 1) - reach), 0).cast("int")

    return place(0, width), place(1, height)


def place_objects(objects: DataFrame, image: str, slot: str, width: int, height: int, seed: str, tries: int = 160, margin: int = 16, area: tuple[float, float] = (0.015, 0.14), percent: int = 2, rounds: int = 1) -> DataFrame:
    """Places the objects (columns w, h, cx, cy) of each image in turn: image, slot, x, y, attempt; attempt is -1 where none fits.

    The first try stands at the centre, later ones are moved by hashed offsets. A place must keep the margin, the
    area must be within bounds, and no box placed before may be overlapped by more than `percent`. An image where an
    object finds no place is laid out anew, with other draws, up to `rounds` times. Images do not depend on each other:
    a task takes many of them in order, and holds the few objects of one.
    """
    low, high = area

    def fits(w: int, h: int) -> bool:
        return low <= w * h / (width * height) <= high

    def moves(key: str, at: tuple) -> Iterator[tuple[int, int, int]]:
        """Hashed corners of one object, numbered by try."""
        w, h, cx, cy = at
        for attempt in range(tries):
            shift = [0, 0]
            if attempt:
                digests = (hashlib.sha1(f"{key}|{attempt}|{axis}".encode()).hexdigest() for axis in "xy")
                shift = [int(d[:13], 16) % (2 * reach + 1) - reach for d, reach in zip(digests, REACH, strict=True)]
            yield attempt, cx + shift[0] - w // 2, cy + shift[1] - h // 2

    def free(x: int, y: int, w: int, h: int, boxes: list[tuple]) -> bool:
        # A margin, and areas of a share of the canvas that hardly overlap: the boxes of an image stay few.
        if min(x, y) < margin or x + w > width - margin or y + h > height - margin:
            return False
        for bx, by, bw, bh in boxes:
            across, down = min(x + w, bx + bw) - max(x, bx), min(y + h, by + bh) - max(y, by)
            if across > 0 and down > 0 and across * down * 100 > percent * (w * h + bw * bh - across * down):
                return False
        return True

    def layout(name: int, group: list[tuple], draws: str) -> list[tuple]:
        boxes, rows = [], []
        for s, w, h, cx, cy in group:
            spots = (m for m in moves(f"{draws}|{name}|{s}", (w, h, cx, cy)) if free(m[1], m[2], w, h, boxes)) if fits(w, h) else iter(())
            attempt, x, y = next(spots, (-1, 0, 0))
            if attempt >= 0:
                boxes.append((x, y, w, h))
            rows.append((name, s, x, y, attempt))
        return rows

    def placed(name: int, group: list[tuple]) -> list[tuple]:
        # With an object of no allowed area every round fails, and the last one is the result.
        rows = []
        for turn in range(rounds) if all(fits(w, h) for _, w, h, *_ in group) else range(rounds - 1, rounds):
            rows = layout(name, group, seed if turn == 0 else f"{seed}|{turn}")
            if all(r[-1] >= 0 for r in rows):
                break
        return rows

    def objects_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), *[pa.int32()] * 4]
        names = ["image", "slot", "x", "y", "attempt"]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        out = []
        for name, group in groupby(objects_of(batches), key=lambda r: r[0]):
            out += placed(int(name), [r[1:] for r in group])
            if len(out) >= 10_000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    own = objects.select(F.col(image).cast("long").alias("image"), F.col(slot).cast("int").alias("slot"), *[F.col(c).cast("long").alias(c) for c in ("w", "h", "cx", "cy")])
    tasks = max(1, int(objects.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    return own.repartition(tasks, "image").sortWithinPartitions("image", "slot").mapInArrow(run, "image long, slot int, x int, y int, attempt int")
