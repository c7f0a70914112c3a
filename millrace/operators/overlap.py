"""Overlaps of boxes within an image."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Box


def overlap_pairs(boxes: DataFrame, image: str, pos: str, numerator: int = 1, denominator: int = 50) -> DataFrame:
    """Pairs of an image (left before right) with intersection * denominator > union * numerator.

    Integer boxes are compared without floating point.
    """
    side = lambda p: boxes.select(F.col(image).alias(image if p == "a" else "__image"), F.col(pos).alias(f"{p}_pos"), *[F.col(c).alias(f"{p}_{c}") for c in "xywh"])
    pairs = side("a").join(side("b"), (F.col(image) == F.col("__image")) & (F.col("a_pos") < F.col("b_pos"))).drop("__image")
    a, b = Box.of("a_"), Box.of("b_")
    return pairs.where(a.intersection(b) * denominator > a.union(b) * numerator).withColumn("iou", a.iou(b))


def failures(pairs: DataFrame, image: str) -> DataFrame:
    """Per image: overlapping pairs, and left boxes with any overlap (the two ways to count)."""
    return pairs.groupBy(image).agg(F.count(F.lit(1)).alias("per_pair"), F.count_distinct("a_pos").alias("per_left"))


def _collected(boxes: DataFrame, image: str, pos: str, *more: str) -> DataFrame:
    return boxes.groupBy(image).agg(F.array_sort(F.collect_list(F.struct(pos, "x", "y", "w", "h", *more))).alias("__boxes"))


def _meets(a: Column, b: Column, numerator: int, denominator: int) -> Column:
    p, q = (Box(c["x"], c["y"], c["w"], c["h"]) for c in (a, b))
    return p.intersection(q) * denominator > p.union(q) * numerator


def nested_overlaps(boxes: DataFrame, image: str, pos: str, numerator: int = 1, denominator: int = 50) -> DataFrame:
    """Per image the number of left boxes with a later overlapping box, within the image's own array: one shuffle."""
    left = F.filter(
        F.col("__boxes"), lambda a: F.exists(F.col("__boxes"), lambda b: (b[pos] > a[pos]) & _meets(a, b, numerator, denominator))
    )
    return _collected(boxes, image, pos).select(image, F.size(left).cast("long").alias("per_left")).where("per_left > 0")


def non_maximum_suppression(boxes: DataFrame, groups: list[str], score: str, pos: str, numerator: int = 1, denominator: int = 2) -> DataFrame:
    """Per group the positions of the boxes kept: by falling score, a box goes if it overlaps one kept before."""
    ranked = F.sort_array(F.collect_list(F.struct((-F.col(score)).alias("o"), F.col(pos).alias("pos"), "x", "y", "w", "h")))
    kind = f"array<struct<o:{_type(boxes, score)},pos:{_type(boxes, pos)},x:{_type(boxes, 'x')},y:{_type(boxes, 'y')},w:{_type(boxes, 'w')},h:{_type(boxes, 'h')}>>"
    kept = F.aggregate(
        F.col("__r"),
        F.array().cast(kind),
        lambda acc, b: F.when(F.exists(acc, lambda k: _meets(k, b, numerator, denominator)), acc).otherwise(F.array_append(acc, b)),
    )
    return boxes.groupBy(*groups).agg(ranked.alias("__r")).select(*groups, F.explode(F.transform(kept, lambda b: b["pos"])).alias(pos))


def _type(df: DataFrame, col: str) -> str:
    kind = df.schema[col].dataType.simpleString()
    return kind
