"""What the registered queries share: tables, and boxes derived from lineitem."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Registry = dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]]
WIDTH, HEIGHT = 976, 1280


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(registry: Registry, sql: str | None = None):
    """Enters the query under its function's name, with its SQL."""

    def enter(run):
        registry[run.__name__] = (run, sql)
        return run

    return enter


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integer boxes: an order is an image, its lines are annotations in a total order."""
    lines = read(spark, sf_dir, "lineitem")
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    side = F.col("l_quantity").cast("long")
    return lines.select(
        F.col("l_orderkey").alias("image_id"), F.row_number().over(order).alias("pos"), F.col("l_partkey").alias("part_id"), F.col("l_suppkey").alias("supp_id"),
        (F.col("l_partkey") * 37 % WIDTH).alias("x"), (F.col("l_suppkey") * 53 % HEIGHT).alias("y"), (60 + side * 4).alias("w"), (60 + side * 5).alias("h"),
    )


BOXES = f"""boxes AS (
  SELECT l_orderkey AS image_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS INTEGER) AS pos,
         l_partkey AS part_id, l_suppkey AS supp_id, (l_partkey * 37) % {WIDTH} AS x, (l_suppkey * 53) % {HEIGHT} AS y,
         60 + CAST(l_quantity AS BIGINT) * 4 AS w, 60 + CAST(l_quantity AS BIGINT) * 5 AS h
  FROM lineitem)"""


def inter(a: str, b: str) -> str:
    """SQL of the intersection area of two aliased boxes."""
    return f"(greatest(least({a}.x + {a}.w, {b}.x + {b}.w) - greatest({a}.x, {b}.x), 0) * greatest(least({a}.y + {a}.h, {b}.y + {b}.h) - greatest({a}.y, {b}.y), 0))"


def union(a: str, b: str) -> str:
    return f"({a}.w * {a}.h + {b}.w * {b}.h - {inter(a, b)})"
