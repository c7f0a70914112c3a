"""Pairing of images and labels by key, with reports of what has no partner."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_groups(labels: DataFrame, keys: list[str], member: str, ordinal: str) -> DataFrame:
    """Per key: all label members in order, the first as primary, and how many duplicates there are."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col(member).alias("m"))))
    grouped = labels.groupBy(*keys).agg(listed.alias("__all"))
    return grouped.select(*keys, F.transform("__all", lambda x: x["m"]).alias("label_members"), F.get("__all", F.lit(0))["m"].alias("label_member"), (F.size("__all") - 1).alias("duplicates"))


def paired(images: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    return images.join(labels, keys, "inner")


def unmatched(images: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found on one side only, with that side's name."""
    lone = images.select(*keys).join(labels.select(*keys), keys, "left_anti").withColumn("side", F.lit("image_only"))
    other = labels.select(*keys).join(images.select(*keys), keys, "left_anti").withColumn("side", F.lit("label_only"))
    return lone.unionByName(other).distinct()


def set_status(images: DataFrame, labels: DataFrame, set_col: str, key: str, invalid: DataFrame | None = None) -> DataFrame:
    """Per set: pairs, unmatched on either side, invalid labels, and the status by precedence."""
    i = images.select(set_col, key).distinct().withColumn("__i", F.lit(1))
    k = labels.select(set_col, key).distinct().withColumn("__l", F.lit(1))
    both = i.join(k, [set_col, key], "full_outer")
    count = lambda c: F.count_if(c).alias
    stats = both.groupBy(set_col).agg(
        count(F.col("__i").isNotNull() & F.col("__l").isNotNull())("paired"),
        count(F.col("__l").isNull())("image_only"),
        count(F.col("__i").isNull())("label_only"),
    )
    bad = invalid.groupBy(set_col).agg(F.count(F.lit(1)).alias("invalid")) if invalid is not None else None
    stats = stats.join(bad, set_col, "left") if bad is not None else stats.withColumn("invalid", F.lit(0).cast("long"))
    stats = stats.withColumn("invalid", F.coalesce("invalid", F.lit(0).cast("long")))
    status = (
        F.when((F.col("paired") == 0) & (F.col("image_only") == 0), "label_only_set")
        .when((F.col("paired") == 0) & (F.col("label_only") == 0), "source_only_set")
        .when(F.col("invalid") > 0, "invalid_labels")
        .when((F.col("image_only") > 0) | (F.col("label_only") > 0), "paired_with_unmatched")
        .otherwise("perfect")
    )
    return stats.withColumn("status", status)


def duplicate_keys(df: DataFrame, keys: list) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def drop_ambiguous(df: DataFrame, group: list, reasons: list[tuple[str, object]], ambiguous: str) -> DataFrame:
    """Adds reason: the first that applies, or `ambiguous` for every row of a group that occurs more than once; null if kept.

    Rows failing an earlier reason do not count for a group.
    """
    first = F.lit(None).cast("string")
    for name, condition in reversed(reasons):
        first = F.when(condition, name).otherwise(first)
    marked = df.withColumn("__first", first)
    n = F.count_if(F.col("__first").isNull()).over(Window.partitionBy(*group))
    return marked.withColumn("reason", F.when(F.col("__first").isNotNull(), F.col("__first")).when(n > 1, ambiguous)).drop("__first")
