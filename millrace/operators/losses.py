"""Losses of predicted probabilities as column formulas: sums per group, no training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Probabilities are kept this far from 0 and 1.
EDGE = 1e-7


def cross_entropy(p: Column, y: Column, positive: float = 1.0) -> Column:
    """Weighted binary cross entropy of one row."""
    p = F.least(F.greatest(p, F.lit(EDGE)), F.lit(1 - EDGE))
    return -(positive * y * F.log(p) + (1 - y) * F.log(1 - p))


def focal(p: Column, y: Column, alpha: float = 0.25, gamma: float = 2.0) -> Column:
    right = F.when(y == 1, p).otherwise(1 - p)
    weight = F.when(y == 1, alpha).otherwise(1 - alpha)
    return -weight * F.pow(1 - right, F.lit(gamma)) * F.log(F.greatest(right, F.lit(EDGE)))


def losses(df: DataFrame, by: list[str], p: str, y: str, positive: float = 1.0, alpha: float = 0.7, share: float = 0.5) -> DataFrame:
    """Per group the mean weighted cross entropy and focal loss, Tversky loss (alpha weighs the missed) and their combination.

    Rows without probability or truth do not count. Tversky is 0 where nothing is true, missed or wrongly found.
    """
    a, b = F.col(p).cast("double"), F.col(y).cast("double")
    rows = df.where(a.isNotNull() & b.isNotNull())
    sums = rows.groupBy(*by).agg(F.avg(cross_entropy(a, b, positive)).alias("weighted"), F.avg(focal(a, b)).alias("focal"), F.sum(a * b).alias("__hit"), F.sum((1 - a) * b).alias("__miss"), F.sum(a * (1 - b)).alias("__wrong"))
    index = F.try_divide(F.col("__hit"), F.col("__hit") + alpha * F.col("__miss") + (1 - alpha) * F.col("__wrong"))
    out = sums.withColumn("tversky", F.coalesce(1 - index, F.lit(0.0)))
    return out.withColumn("combined", share * F.col("weighted") + (1 - share) * F.col("tversky")).drop("__hit", "__miss", "__wrong")


def anomalies(df: DataFrame, error: str, by: list[str], k: float = 3.0) -> DataFrame:
    """Rows whose reconstruction error is more than k standard deviations above their group's mean."""
    stats = df.groupBy(*by).agg((F.avg(error) + k * F.stddev_pop(error)).alias("limit"))
    joined = df.join(stats, by) if by else df.join(F.broadcast(stats))
    return joined.where(F.col(error) > F.col("limit"))
