"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

A source's mean repetition rate is target share * output size / rows of the source. Each document draws
one uniform number from a hash of (seed, document), and its copies are the Poisson quantile of that number at
the rate of its source; copies are exploded and dealt globally by a hash of (seed, document, copy).

The draw depends on nothing but the seed and the document, so a retried task repeats it.

Nulls: a null source is a source of its own; a null id hashes as the empty string. Sources without a target weight
have weight 0 when weights are given. Repeated rows draw alike. Empty tables give empty results. Columns of the input
keep their names; an added column whose name is taken has more underscores in front (`added_names`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

#: Rate tables of at most this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_SOURCES = 10_000
#: Rates above this are drawn as sums of equal parts, since exp(-rate) would vanish.
PART = 400.0


def uniform(seed: int, *keys: Column) -> Column:
    """A number in [0, 1) of 52 bits from the MD5 of the seed and the keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def poisson_table(rate: Column) -> Column:
    """P(X <= k), k = 0, 1, ..., for X of the Poisson distribution with the given mean (up to PART), as far as doubles tell."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("upto"))

    def step(s: Column, k: Column) -> Column:
        p = s["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(s["upto"], F.array(F.element_at(s["upto"], -1) + p)).alias("upto"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["upto"])


def drawn(u: Column, upto: Column) -> Column:
    """The least k with P(X <= k) > u: how many of the first entries are at most u."""
    least = F.least(F.size(F.filter(F.slice(upto, 1, 4), lambda c: c <= u)), F.size(upto) - 1)
    return F.when(least < 4, least).otherwise(F.least(F.size(F.filter(upto, lambda c: c <= u)), F.size(upto) - 1)).cast("int")


def poisson_quantile(u: Column, rate: Column) -> Column:
    """The least k with P(X <= k) > u."""
    return drawn(u, poisson_table(rate))


def repetition_rates(docs: DataFrame, source_col: str, weights: dict[str, float] | None, temperature: float, size_factor: float) -> DataFrame:
    """Rows (source, n_rows, rate). Without weights the target share is proportional to n_rows ** temperature."""
    counts = docs.groupBy(F.col(f"`{source_col}`").alias("source")).agg(F.count(F.lit(1)).alias("n_rows"))
    if weights is None:
        counts = counts.withColumn("weight", F.pow(F.col("n_rows").cast("double"), F.lit(temperature)))
    else:
        given = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv]) if weights else None
        weight = F.coalesce(F.try_element_at(given, F.col("source")), F.lit(0.0)) if weights else F.lit(0.0)
        counts = counts.withColumn("weight", weight)
    total = counts.agg(F.sum("weight").alias("all_weight"), F.sum("n_rows").alias("all_rows"))
    rate = F.try_divide(F.col("weight") * F.col("all_rows") * F.lit(size_factor), F.col("all_weight") * F.col("n_rows"))
    return counts.crossJoin(F.broadcast(total)).select("source", "n_rows", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def added_names(docs: DataFrame) -> list[str]:
    """What `mix_sources` calls its columns __rate, __copies, __copy and __order beside those of `docs`."""
    return fresh(docs.columns, "__rate", "__copies", "__copy", "__order")


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: dict[str, float] | None = None,
    temperature: float = 0.7,
    size_factor: float = 1.0,
    seed: int = 17,
) -> DataFrame:
    """The copies, each with the columns of `docs` and __rate, __copies, __copy (from 1), __order (the global shuffle key)."""
    rate, copies, copy, order = added_names(docs)
    source, cdf = fresh([*docs.columns, rate, copies, copy, order], "__source", "__cdf")
    # The distribution of a source's draws is one table, made once for each source; a document only looks its number up.
    rates = repetition_rates(docs, source_col, weights, temperature, size_factor)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    rates = rates.withColumn("parts", parts).select(F.col("source").alias(source), F.col("rate").alias(rate), F.struct("parts", poisson_table(F.col("rate") / F.col("parts")).alias("upto")).alias(cdf))
    few = rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    own = F.col(f"`{id_col}`")
    joined = docs.join(F.broadcast(rates) if few else rates, F.col(f"`{source_col}`").eqNullSafe(F.col(source)))
    table = F.col(cdf)
    draw = F.aggregate(F.sequence(F.lit(1), table["parts"]), F.lit(0), lambda n, part: n + drawn(uniform(seed, own, part), table["upto"]))
    one = drawn(uniform(seed, own, F.lit(1)), table["upto"])
    counted = joined.withColumn(copies, F.when(table["parts"] == 1, one).otherwise(draw)).drop(source, cdf).where(F.col(copies) > 0)
    exploded = counted.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    dealt = exploded.withColumn(order, F.md5(F.concat_ws("|", F.lit(f"order{seed}"), F.coalesce(own.cast("string"), F.lit("")), F.col(copy).cast("string"))))
    return dealt.repartition(F.col(order)).sortWithinPartitions(order)
