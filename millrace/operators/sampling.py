"""Sampling and allocation by hashed draws: equal in distribution to sequential sampling, and repeatable."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_int, hash_order, hash_unit
from .prefix import running_total


def bottom_k(df: DataFrame, keys: list[str], id_col: str, k: int, seed: str) -> DataFrame:
    """k rows of every key without replacement: those of least seeded hash. Fewer rows: all."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(hash_order(seed, F.col(id_col)), id_col))
    return df.withColumn("nth", nth).where(F.col("nth") <= k)


def weighted_draws(items: DataFrame, id_col: str, weight: str, draws: DataFrame, draw_col: str, seed: str, chunks: int = 256) -> DataFrame:
    """For every draw an item, with replacement, in proportion to integer weights: rows (draw, item).

    The cumulative weights are cut into `chunks` equal spans; draws and items meet by span, then by interval, so
    neither side is compared with all of the other.
    """
    live = items.where(F.col(weight) > 0).select(F.col(id_col).alias("item"), F.col(weight).cast("long").alias("w"))
    total = live.agg(F.sum("w")).first()[0] or 0
    span = max(1, -(-total // chunks))
    placed = running_total(live, "item", "w", [], "lo").withColumn("hi", F.col("lo") + F.col("w"))
    spread = placed.withColumn("chunk", F.explode(F.sequence(F.floor(F.col("lo") / span), F.floor((F.col("hi") - 1) / span))))
    at = draws.select(F.col(draw_col).alias("draw"), (hash_int(seed, F.col(draw_col)) % F.lit(max(1, total))).alias("u")).withColumn("chunk", F.floor(F.col("u") / span))
    return at.join(spread, "chunk").where("lo <= u and u < hi").select("draw", "item")


def size_draw(key: Column, seed: str, two: float = 0.30, three: float = 0.40) -> Column:
    """2, 3 or 4 by thresholds on a hashed draw."""
    u = hash_unit(seed, key)
    return F.when(u < two, 2).when(u < two + three, 3).otherwise(4)


#: Allocations of sizes 2, 3 and 4 for the image counts that have one of their own (fixed values), and the shares of 2 and 4 else.
EXACT_SIZES = {100: (3, 65, 32), 696: (21, 453, 222), 2500: (76, 1616, 808)}
SIZE_SHARES = (0.0302, 0.3189)


def exact_sizes(n: int) -> tuple[int, int, int]:
    """How many combinations of 2, 3 and 4."""
    if n in EXACT_SIZES:
        return EXACT_SIZES[n]
    two, four = (round(n * share) for share in SIZE_SHARES)
    return two, n - two - four, four


def allocate_sizes(rows: DataFrame, id_col: str, n: int, seed: str) -> DataFrame:
    """Gives the n rows exactly the allotted sizes, dealt by hash."""
    two, three, _ = exact_sizes(n)
    keyed = rows.withColumn("__h", hash_int(seed, F.col(id_col))).withColumn("__one", F.lit(1))
    ranked = running_total(keyed, "__h", "__one", [id_col], "__at")
    return ranked.withColumn("size", F.when(F.col("__at") < two, 2).when(F.col("__at") < two + three, 3).otherwise(4)).drop("__h", "__one", "__at")
