"""Fixed-size shards: numbers, plans, manifests and merges."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .prefix import running_total


def shard_plan(df: DataFrame, order_col: str, size: int, by: list[str] | None = None, prefix: str = "shard") -> DataFrame:
    """Adds shard (from 0) and its file name: `size` rows each, in order, within `by` or over the whole table."""
    if by:
        at = F.row_number().over(Window.partitionBy(*by).orderBy(order_col)) - 1
        placed = df.withColumn("__at", at)
    else:
        placed = running_total(df.withColumn("__one", F.lit(1)), order_col, "__one", [], "__at").drop("__one")
    shard = F.floor(F.col("__at") / size).cast("int")
    return placed.withColumn("shard", shard).withColumn("file", F.concat(F.lit(f"{prefix}-"), F.lpad(shard.cast("string"), 6, "0"), F.lit(".tar"))).drop("__at")


def shard_manifest(plan: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Per shard: rows, least and greatest id, and a digest of its sorted ids."""
    ids = F.array_sort(F.collect_list(F.col(id_col).cast("long")))  # at most the shard size
    grouped = plan.groupBy(*keys).agg(F.count(F.lit(1)).alias("samples"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id"), ids.alias("__ids"))
    return grouped.withColumn("sha256", F.sha2(F.concat_ws(",", F.transform("__ids", lambda x: x.cast("string"))), 256)).drop("__ids")


def merge_map(parts: DataFrame, part_col: str, shard_col: str, prefix: str = "shard") -> DataFrame:
    """New global names for the shards of several parts, in order of part and shard. One row per shard file."""
    new = F.row_number().over(Window.orderBy(part_col, shard_col)) - 1
    named = parts.select(part_col, shard_col).distinct().withColumn("new_shard", new)
    return named.withColumn("new_file", F.concat(F.lit(f"{prefix}-"), F.lpad(F.col("new_shard").cast("string"), 6, "0"), F.lit(".tar")))


def remap(df: DataFrame, mapping: DataFrame, keys: list[str], new: str, old: str) -> DataFrame:
    """Replaces old by the mapped name; rows without one keep theirs."""
    renamed = mapping.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(new).alias("__new"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    out = df.join(renamed, same, "left").withColumn(old, F.coalesce("__new", F.col(old)))
    return out.drop("__new", *[f"__{k}" for k in keys])
