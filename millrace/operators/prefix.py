"""Running totals over a whole table, or large groups, without one window for all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Buckets hold about this many rows, between the least and the most buckets (the bounds are one nested expression).
BUCKET_ROWS, LEAST_BUCKETS, MOST_BUCKETS = 1_000_000, 64, 512


def quantile_bounds(df: DataFrame, order: str) -> list:
    """Distinct values that cut the rows into about equal buckets by a numeric column; more rows, more buckets."""
    cuts = [i / MOST_BUCKETS for i in range(1, MOST_BUCKETS)]
    n, found = df.agg(F.count(order), F.percentile_approx(order, cuts, 10_000)).first()
    buckets = LEAST_BUCKETS
    while buckets < MOST_BUCKETS and buckets * BUCKET_ROWS < n:
        buckets *= 2
    step = MOST_BUCKETS // buckets
    return sorted(set((found or [])[step - 1 :: step]))


def same_keys(left: list[str], right: list[str]) -> Column:
    """Equality of the key columns, nulls equal to nulls."""
    out = F.lit(True)
    for a, b in zip(left, right, strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def bucket_of(value: Column, bounds: list, before: int = 0) -> Column:
    """How many of the sorted bounds are at most the value, by halving; 0 for a null."""
    if not bounds:
        return F.lit(before)
    half = len(bounds) // 2
    return F.when(value >= F.lit(bounds[half]), bucket_of(value, bounds[half + 1 :], before + half + 1)).otherwise(bucket_of(value, bounds[:half], before))


def running_totals(df: DataFrame, order: str, values: dict[str, str], ties: list[str], by: list[str] | None = None, bounds: list | None = None) -> DataFrame:
    """Adds, for each (new column, value) pair, the sum of the value over all rows (of the same `by`) before each row, by
    the numeric column `order` and then `ties`.

    Rows are bucketed at quantiles of `order`; sums run within buckets, and only the bucket totals (a row for each
    bucket and group) meet in one window. Unless bounds are given, the quantiles cost one more pass over `df`.
    Rows with a null in `by` are a group of their own.
    """
    by, bounds = by or [], quantile_bounds(df, order) if bounds is None else bounds
    at = bucket_of(F.col(order), bounds)
    placed = df.withColumn("__bucket", at)
    zero = F.lit(0)
    within = Window.partitionBy(*by, "__bucket").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*by, "__bucket").agg(*[F.sum(v).alias(f"__sum_{out}") for out, v in values.items()])
    ahead = Window.partitionBy(*by).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    held = [f"__by_{c}" for c in by]
    offsets = totals.select(*[F.col(c).alias(h) for c, h in zip(by, held, strict=True)], F.col("__bucket").alias("__at"), *[F.coalesce(F.sum(f"__sum_{out}").over(ahead), zero).alias(f"__offset_{out}") for out in values])
    local = placed.select("*", *[F.coalesce(F.sum(v).over(within), zero).alias(f"__local_{out}") for out, v in values.items()])
    joined = local.join(offsets if by else F.broadcast(offsets), (F.col("__bucket") == F.col("__at")) & same_keys(by, held))
    return joined.select(*df.columns, *[(F.col(f"__local_{out}") + F.col(f"__offset_{out}")).alias(out) for out in values])


def running_total(df: DataFrame, order: str, value: str, ties: list[str], out: str = "before", by: list[str] | None = None) -> DataFrame:
    """The same for one value."""
    return running_totals(df, order, {out: value}, ties, by)


def order_statistics(df: DataFrame, by: list[str], value: str, points: list[float]) -> DataFrame:
    """Exact quantiles of a numeric column with linear interpolation, as an array of doubles `quantiles` per group.

    Counts per quantile bucket tell which buckets hold the wanted ranks; only their rows are shuffled, as counts per value.
    Nulls do not count; a group without values has no row.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("__v"))
    placed = rows.withColumn("__bucket", bucket_of(F.col("__v"), quantile_bounds(rows, "__v")))
    group = Window.partitionBy(*by)
    ahead = group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*by, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
    totals = totals.withColumn("__ahead", F.coalesce(F.sum("__n").over(ahead), F.lit(0))).withColumn("__size", F.sum("__n").over(group))

    def ranks(point: float) -> tuple[Column, Column, Column]:
        place = F.lit(float(point)) * (F.col("__size") - 1)
        return F.floor(place), F.ceil(place), place

    def holds(rank: Column, start: str, n: str) -> Column:
        return (F.col(start) <= rank) & (rank < F.col(start) + F.col(n))

    needed = F.lit(False)
    for p in points:
        low, high, _ = ranks(p)
        needed = needed | holds(low, "__ahead", "__n") | holds(high, "__ahead", "__n")
    held = [f"__by_{c}" for c in by]
    wanted = totals.where(needed).select(*[F.col(c).alias(h) for c, h in zip(by, held, strict=True)], F.col("__bucket").alias("__at"), "__ahead", "__size")
    few = placed.join(wanted, (F.col("__bucket") == F.col("__at")) & same_keys(by, held)).groupBy(*by, "__bucket", "__ahead", "__size", "__v").agg(F.count(F.lit(1)).alias("__k"))
    before = Window.partitionBy(*by, "__bucket").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    few = few.withColumn("__below", F.col("__ahead") + F.coalesce(F.sum("__k").over(before), F.lit(0)))
    ends = []
    for p in points:
        low, high, place = ranks(p)
        at = [F.max(F.when(holds(rank, "__below", "__k"), F.col("__v").cast("double"))) for rank in (low, high)]
        share = F.max(place - low)
        ends.append(F.when(at[0] == at[1], at[0]).otherwise((1 - share) * at[0] + share * at[1]))
    return few.groupBy(*by).agg(F.array(*ends).alias("quantiles"))
