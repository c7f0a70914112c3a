"""Exploration and cleaning of tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .prefix import order_statistics, same_keys


def summary(df: DataFrame, columns: list[str], digits: int = 4) -> DataFrame:
    """A row per numeric column: count, nulls, mean, standard deviation, least, median, greatest; one pass."""
    stats = [
        F.struct(
            F.lit(c).alias("column"), F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("nulls"), F.round(F.avg(c), digits).alias("mean"), F.round(F.try_divide(F.stddev_pop(c), F.lit(1)), digits).alias("std"),
            F.min(c).cast("double").alias("min"), F.round(F.expr(f"percentile({c}, 0.5)"), digits).alias("median"), F.max(c).cast("double").alias("max"),
        )
        for c in columns
    ]
    one = df.agg(*[s.alias(f"__{i}") for i, s in enumerate(stats)])
    return one.select(F.inline(F.array(*[F.col(f"__{i}") for i in range(len(columns))])))


def fill_value(df: DataFrame, column: str, how: str = "median") -> DataFrame:
    """Nulls replaced by the column's mean, median or mode (ties: the least value)."""
    if how == "mode":
        counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("__n"))
        value = counts.agg(F.max(F.struct(F.col("__n"), (-F.col(column)).alias("__v"))).alias("__m")).select((-F.col("__m.__v")).alias("__fill"))
    elif how == "mean":
        value = df.agg(F.avg(column).alias("__fill"))
    else:
        value = order_statistics(df, [], column, [0.5]).select(F.col("quantiles")[0].alias("__fill"))
    # One row, or none where there are no values.
    return df.join(F.broadcast(value), how="left").withColumn(column, F.coalesce(F.col(column), F.col("__fill"))).drop("__fill")


def fill_along(df: DataFrame, column: str, by: list[str], order: list[str], backward: bool = False) -> DataFrame:
    """Nulls replaced by the last known value before (or the next after) within a key."""
    turn = F.desc if backward else F.asc
    so_far = Window.partitionBy(*by).orderBy(*[turn(c) for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    value = F.last(column, ignorenulls=True).over(so_far)
    return df.withColumn(column, value)


def drop_duplicates(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the distinct keys, the keys with their number of surplus rows)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(*keys), counts.where("n > 1").select(*keys, (F.col("n") - 1).alias("surplus"))


def iqr_fences(df: DataFrame, column: str, by: list[str], k: float = 1.5) -> DataFrame:
    found = order_statistics(df, by, column, [0.25, 0.75]).withColumnRenamed("quantiles", "__q")
    spread = (F.col("__q")[1] - F.col("__q")[0]) * k
    return found.select(*by, (F.col("__q")[0] - spread).alias("low"), (F.col("__q")[1] + spread).alias("high"))


def outliers_iqr(df: DataFrame, column: str, by: list[str], k: float = 1.5, clip: bool = False) -> DataFrame:
    """Rows beyond the fences; with clip all rows, drawn to the fences."""
    held = [f"__by_{c}" for c in by]
    fences = iqr_fences(df, column, by, k).select(*[F.col(c).alias(h) for c, h in zip(by, held, strict=True)], "low", "high")
    fenced = df.join(fences, same_keys(by, held), "left").drop(*held)
    if clip:
        return fenced.withColumn(column, F.least(F.greatest(F.col(column), F.col("low")), F.col("high"))).drop("low", "high")
    return fenced.where((F.col(column) < F.col("low")) | (F.col(column) > F.col("high"))).drop("low", "high")


def outliers_zscore(df: DataFrame, column: str, by: list[str], limit: float = 3.0) -> DataFrame:
    """Rows further than `limit` standard deviations (of the population) from the mean of their group."""
    stats = df.groupBy(*by).agg(F.avg(column).alias("__m"), F.stddev_pop(column).alias("__s"))
    return df.join(stats, by).where(F.abs(F.col(column) - F.col("__m")) > limit * F.col("__s")).drop("__m", "__s")


def min_max(df: DataFrame, column: str, by: list[str], out: str) -> DataFrame:
    """Scaled to 0..1 within groups; 0 where all values are equal."""
    stats = df.groupBy(*by).agg(F.min(column).alias("__a"), F.max(column).alias("__b"))
    return df.join(stats, by).withColumn(out, F.coalesce(F.try_divide(F.col(column) - F.col("__a"), F.col("__b") - F.col("__a")), F.lit(0.0))).drop("__a", "__b")


def standardise(df: DataFrame, column: str, by: list[str], out: str) -> DataFrame:
    stats = df.groupBy(*by).agg(F.avg(column).alias("__m"), F.stddev_pop(column).alias("__s"))
    return df.join(stats, by).withColumn(out, F.coalesce(F.try_divide(F.col(column) - F.col("__m"), F.col("__s")), F.lit(0.0))).drop("__m", "__s")


def encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Categories numbered from 0 in order. One row per category is ranked and joined back."""
    codes = df.select(F.col(column).alias("__c")).distinct().withColumn(out, (F.dense_rank().over(Window.orderBy("__c")) - 1).cast("int"))
    return df.join(codes, F.col(column).eqNullSafe(F.col("__c"))).drop("__c")


def rollup_coverage(df: DataFrame, keys: list[str], flag: Column) -> DataFrame:
    """Rows and share of flagged rows by all prefixes of the keys; `all` stands for a rolled-up key."""
    agg = df.withColumn("__f", flag.cast("int")).rollup(*keys).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("__f"), 6).alias("coverage"), *[F.grouping(k).alias(f"__g_{k}") for k in keys])
    return agg.select(*[F.when(F.col(f"__g_{k}") == 1, "all").otherwise(F.col(k).cast("string")).alias(k) for k in keys], "n", "coverage")


def principal_components(df: DataFrame, vector_col: str, k: int, id_col: str) -> DataFrame:
    """The first k principal components of array vectors, as arrays."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    vectors = df.select(id_col, array_to_vector(F.col(vector_col).cast("array<double>")).alias("__v"))
    model = PCA(k=k, inputCol="__v", outputCol="__c").fit(vectors)
    return model.transform(vectors).select(id_col, vector_to_array("__c").alias("components"))
