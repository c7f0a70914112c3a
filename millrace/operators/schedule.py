"""Balanced schedules: the sequential least-used-first rules in closed form where there is one."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_int, hash_order
from .prefix import running_total


def balanced_schedule(combos: DataFrame, combo_col: str, size_col: str, products: DataFrame, product_col: str) -> DataFrame:
    """Rows (combo, slot, product): always the least used products, ties by name.

    The least-used rule deals the sorted products round and round, so combination i takes the positions from the sum
    of the sizes before it.
    """
    n = products.select(product_col).distinct().count()
    # One row per product, the class list.
    index = products.select(F.col(product_col).alias("product")).distinct().withColumn("index", F.dense_rank().over(Window.orderBy("product")) - 1)
    placed = running_total(combos.select(F.col(combo_col).alias("combo"), F.least(F.col(size_col), F.lit(n)).alias("size")), "combo", "size", [], "start")
    slots = placed.select("combo", "start", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("slot"))
    return slots.withColumn("index", ((F.col("start") + F.col("slot")) % F.lit(max(1, n))).cast("int")).join(index, "index").select("combo", "slot", "product")


def round_robin(uses: DataFrame, product_col: str, order_cols: list[str], assets: DataFrame, asset_col: str, seed: str) -> DataFrame:
    """Adds asset: every product deals its assets in turn, newly shuffled in each cycle. Products without assets drop out.

    The first order column is numeric: the uses of a product are numbered in buckets, so a hot one fills no single task.
    """
    count = assets.groupBy(F.col(product_col).alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    numbered = running_total(uses.withColumn("__one", F.lit(1)), order_cols[0], "__one", order_cols[1:], "__o", [product_col]).drop("__one")
    turns = numbered.join(count, F.col(product_col) == F.col("__p")).drop("__p")
    turns = turns.withColumn("cycle", F.floor(F.col("__o") / F.col("__n"))).withColumn("__slot", (F.col("__o") % F.col("__n")).cast("int"))
    cycles = turns.select(F.col(product_col).alias("__p"), F.col("cycle").alias("__c")).distinct()
    listed = assets.select(F.col(product_col).alias("__q"), F.col(asset_col).alias("asset"))
    dealt = cycles.join(listed, F.col("__p") == F.col("__q")).drop("__q")
    place = F.row_number().over(Window.partitionBy("__p", "__c").orderBy(hash_order(seed, F.col("__c"), F.col("asset")), "asset")) - 1
    dealt = dealt.withColumn("__s", place)
    same = (F.col(product_col) == F.col("__p")) & (F.col("cycle") == F.col("__c")) & (F.col("__slot") == F.col("__s"))
    return turns.join(dealt, same).drop("__o", "__n", "__slot", "__p", "__c", "__s")


def hard_mix(anchors: DataFrame, combo_col: str, products: DataFrame, product_col: str, group_col: str, used_col: str, seed: str, most: int = 16, k: int = 3) -> DataFrame:
    """Partners for anchors: the k least used of up to `most` hashed candidates that share the anchor's group.

    Candidates are drawn by place: distinct hashed places among the other products of the group (Floyd's sampling:
    every subset is equally likely), so that an anchor never meets its whole group.

    Products have numeric identifiers, each once. Groups with one product have no partners.
    """
    grouped = products.where(F.col(group_col).isNotNull()).select(F.col(product_col).alias("partner"), F.col(group_col).alias("__g"), F.col(used_col).alias("used"), F.lit(1).alias("__one"))
    placed = running_total(grouped, "partner", "__one", [], "__at", ["__g"]).drop("__one")
    sizes = placed.groupBy("__g").agg(F.count(F.lit(1)).alias("__n"))
    own = placed.join(sizes, "__g").select(F.col("partner").alias("anchor"), "__g", F.col("__at").alias("__own"), (F.col("__n") - 1).alias("__others"))
    anchor = anchors.select(F.col(combo_col).alias("combo"), F.col(product_col).alias("anchor")).join(own, "anchor").where("__others > 0")

    def step(taken, top):
        at = hash_int(seed, F.col("combo"), top) % (top + 1)
        return F.concat(taken, F.array(F.when(F.array_contains(taken, at), top).otherwise(at)))

    tops = F.sequence(F.greatest(F.col("__others") - most, F.lit(0)), F.col("__others") - 1)
    drawn = anchor.withColumn("__p", F.explode(F.aggregate(tops, F.array().cast("array<bigint>"), step)))
    at = F.col("__p") + F.when(F.col("__p") >= F.col("__own"), 1).otherwise(0)
    few = drawn.withColumn("__at", at).join(placed, ["__g", "__at"])
    least = F.row_number().over(Window.partitionBy("combo").orderBy("used", hash_order(seed, F.col("combo"), F.col("partner")), "partner"))
    return few.withColumn("nth", least).where(F.col("nth") <= k).select("combo", "anchor", "partner", "nth")


def deficit_balanced(sizes: DataFrame, order_col: str, size_col: str, products: DataFrame, product_col: str, real_col: str, seed: int, floor: int = 0, synthetic_only: bool = False) -> DataFrame:
    """Rows (combo, slot, product): products below the floor first, then by (used before, real + used), ties by hash.

    Every choice depends on all earlier ones, so the combinations run through one task in order; the state is a
    count for each product of the class list, which reaches the task by closure.
    """
    real = {r[0]: int(r[1]) for r in products.select(product_col, real_col).collect()}  # the class list

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        used = dict.fromkeys(real, 0)
        for batch in batches:
            rows = []
            for combo, size in zip(batch["combo"], batch["size"], strict=True):
                tie = {p: hashlib.sha1(f"{seed}|{combo}|{p}".encode()).hexdigest() for p in real}
                low = sorted((p for p in real if used[p] < floor), key=lambda p: (used[p], tie[p]))[:size]
                rest = sorted((p for p in real if p not in low), key=(lambda p: (used[p], tie[p])) if synthetic_only else (lambda p: (used[p] > 0, real[p] + used[p], tie[p])))
                chosen = low + rest[: size - len(low)]
                for slot, p in enumerate(chosen):
                    used[p] += 1
                    rows.append((combo, slot, p))
            yield pd.DataFrame(rows, columns=["combo", "slot", "product"])

    kind = products.schema[product_col].dataType.simpleString()
    ordered = sizes.select(F.col(order_col).cast("long").alias("combo"), F.col(size_col).cast("int").alias("size")).repartition(1).sortWithinPartitions("combo")
    return ordered.mapInPandas(run, f"combo long, slot int, product {kind}")


def even_split(total: int, workers: DataFrame, worker_col: str, n: int) -> DataFrame:
    """Adds share: total over n workers numbered from 0, the first ones one more."""
    return workers.withColumn("share", F.lit(total // n).cast("long") + F.when(F.col(worker_col) < total % n, 1).otherwise(0))
