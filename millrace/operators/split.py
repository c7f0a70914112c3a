"""Leakage-safe splits and class weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_order, text_key
from ..functions.numbers import clamped_quota, effective_weight


def stable_split(df: DataFrame, class_col: str, id_col: str, salt: str = "v2_split", ratio: float = 0.10, least: int = 24, most: int = 128) -> DataFrame:
    """Adds split: in every class the quota of least hash is val_seen_id, the rest train_seen.

    Only the `most` candidates of a class are ranked, so a class that holds a third of the rows is
    trimmed before the shuffle; the chosen ids come back by a join.
    """
    ids = df.select(F.col(class_col).alias("__class"), F.col(id_col).alias("__id"), hash_order(salt, F.col(id_col)).alias("__h"))
    nth = F.row_number().over(Window.partitionBy("__class").orderBy("__h", "__id"))
    first = ids.withColumn("__nth", nth).where(F.col("__nth") <= most)
    quota = ids.groupBy(F.col("__class").alias("__group")).agg(clamped_quota(F.count(F.lit(1)), ratio, least, most).alias("__quota"))
    chosen = first.join(quota, F.col("__class").eqNullSafe(F.col("__group"))).where("__nth <= __quota").select("__class", "__id", F.lit(True).alias("__val"))
    same = F.col(class_col).eqNullSafe(F.col("__class")) & (F.col(id_col) == F.col("__id"))
    joined = df.join(chosen, same, "left")
    return joined.withColumn("split", F.when(F.col("__val"), "val_seen_id").otherwise("train_seen")).drop("__class", "__id", "__val")


def sampler_plan(split: DataFrame, class_col: str, beta: float = 0.9999) -> DataFrame:
    """Per class: its dense index, counts by split, and the effective-number weight over all its rows."""
    counts = split.groupBy(F.col(class_col).alias("class")).agg(
        F.count_if(F.col("split") == "train_seen").alias("train_count"), F.count_if(F.col("split") == "val_seen_id").alias("val_count")
    )
    # One row per class: small whatever the input.
    index = (F.dense_rank().over(Window.orderBy("class")) - 1).alias("class_index")
    weight = F.round(effective_weight(F.col("train_count") + F.col("val_count"), beta), 12)
    return counts.select("class", index, "train_count", "val_count", weight.alias("class_weight"))


def group_split(df: DataFrame, group_col: str, val_percent: int = 10, salt: str = "group") -> DataFrame:
    """All rows of a group fall into one split, by the MD5 of the group."""
    bucket = F.conv(F.substring(F.md5(text_key(salt, F.col(group_col))), 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("split", F.when(bucket < val_percent, "val").otherwise("train"))


def kfold(df: DataFrame, id_col: str, k: int = 5, salt: str = "fold") -> DataFrame:
    bucket = F.conv(F.substring(F.md5(text_key(salt, F.col(id_col))), 1, 8), 16, 10).cast("long") % k
    return df.withColumn("fold", bucket.cast("int"))
