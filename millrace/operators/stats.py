"""Counts, distributions and correlations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import pearson
from .prefix import order_statistics, running_total


def class_distribution(classes: DataFrame, class_col: str, counted: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Every class with its count in each relation; 0 where it does not occur. counted: name -> (relation, class column)."""
    out = classes
    for name, (rows, col) in counted.items():
        n = rows.groupBy(F.col(col).alias("__c")).agg(F.count(F.lit(1)).alias(name))
        out = out.join(n, F.col(class_col) == F.col("__c"), "left").drop("__c").withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return out


def count_of_counts(parents: DataFrame, parent_key: str, children: DataFrame, child_key: str) -> DataFrame:
    """How many parents have 0, 1, 2, ... children."""
    per = children.groupBy(F.col(child_key).alias("__k")).agg(F.count(F.lit(1)).alias("__n"))
    n = F.coalesce("__n", F.lit(0).cast("long")).alias("objects")
    return parents.join(per, F.col(parent_key) == F.col("__k"), "left").select(n).groupBy("objects").agg(F.count(F.lit(1)).alias("images"))


def quantiles(df: DataFrame, by: list[str], value: str, points: list[float], digits: int = 3) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per point."""
    found = order_statistics(df, by, value, points)
    return found.select(*by, F.posexplode("quantiles").alias("__i", "__v")).select(
        *by, F.element_at(F.array(*[F.lit(p) for p in points]), F.col("__i") + 1).alias("point"), F.round("__v", digits).alias("value")
    )


def correlation(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """Pearson correlation, 0 where undefined (no rows or no variance), as `correlation`."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    sums = df.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n"), F.sum(a).alias("sx"), F.sum(b).alias("sy"), F.sum(a * a).alias("sxx"), F.sum(b * b).alias("syy"), F.sum(a * b).alias("sxy")
    )
    return sums.select(*(by or []), pearson(*[F.col(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]).alias("correlation"))


def average_rank(df: DataFrame, value: str, out: str) -> DataFrame:
    """Ranks of a numeric column from 1, ties sharing their average; a null has rank null.

    Ties are aggregated first, and the counts below each value are summed in quantile buckets.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    ranked = running_total(counts, "__v", "__n", [], "__below").select("__v", (F.col("__below") + (F.col("__n") + 1) / 2).alias(out))
    return df.join(ranked, F.col(value) == F.col("__v"), "left").drop("__v")


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    return correlation(average_rank(average_rank(df, x, "__rx"), y, "__ry"), "__rx", "__ry")


def rarity_weight(annotations: DataFrame, image_col: str, class_col: str, share: float = 0.15) -> DataFrame:
    """Per image: the largest 1 / class count of its annotations plus `share` of their sum."""
    n = annotations.groupBy(F.col(class_col).alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    per = annotations.groupBy(image_col, class_col).agg(F.count(F.lit(1)).alias("__k"))  # pre-aggregated: a hot class meets its count once per image
    joined = per.join(n, F.col(class_col) == F.col("__c")).withColumn("__w", 1 / F.greatest(F.col("__n"), F.lit(1)))
    return joined.groupBy(image_col).agg((F.max("__w") + share * F.sum(F.col("__w") * F.col("__k"))).alias("weight"))


def profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Histograms of several columns in one pass: rows (field, value, n)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns])
    return df.select(F.inline(pairs)).groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))
