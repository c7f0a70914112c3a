"""Counts, quantiles, correlations, weights."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import stats
from .base import Registry, read, register

REGISTRY: Registry = {}

_COUNTS = """k AS (SELECT n_nationkey, n_name, coalesce(a, 0) AS customers, coalesce(b, 0) AS suppliers FROM nation
  LEFT JOIN (SELECT c_nationkey AS n_nationkey, count(*) AS a FROM customer GROUP BY 1) USING (n_nationkey)
  LEFT JOIN (SELECT s_nationkey AS n_nationkey, count(*) AS b FROM supplier GROUP BY 1) USING (n_nationkey))"""


def _counts(spark, sf_dir):
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return stats.class_distribution(nations, "n_nationkey", {"customers": (read(spark, sf_dir, "customer"), "c_nationkey"), "suppliers": (read(spark, sf_dir, "supplier"), "s_nationkey")})


@register(REGISTRY, f"WITH {_COUNTS} SELECT * FROM k")
def class_distribution(spark, sf_dir):
    return _counts(spark, sf_dir)


@register(REGISTRY, "SELECT objects, count(*) AS images FROM (SELECT o_orderkey, count(l_orderkey) AS objects FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey) GROUP BY objects")
def count_of_counts(spark, sf_dir):
    return stats.count_of_counts(read(spark, sf_dir, "orders"), "o_orderkey", read(spark, sf_dir, "lineitem"), "l_orderkey")


@register(
    REGISTRY,
    """WITH q AS (SELECT l_returnflag, quantile_cont(l_extendedprice, [0.05, 0.25, 0.5, 0.75, 0.95]) AS v FROM lineitem GROUP BY l_returnflag)
SELECT l_returnflag, unnest([0.05::DOUBLE, 0.25, 0.5, 0.75, 0.95]) AS point, round(unnest(v), 3) AS value FROM q""",
)
def quantiles_exact(spark, sf_dir):
    return stats.quantiles(read(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.05, 0.25, 0.5, 0.75, 0.95])


_PEARSON = "coalesce((count(*) * sum({x} * {y}) - sum({x}) * sum({y})) / nullif(sqrt(greatest(count(*) * sum({x} * {x}) - sum({x}) * sum({x}), 0)) * sqrt(greatest(count(*) * sum({y} * {y}) - sum({y}) * sum({y}), 0)), 0), 0)"


@register(REGISTRY, f"WITH {_COUNTS} SELECT round({_PEARSON.format(x='customers::DOUBLE', y='suppliers::DOUBLE')}, 9) AS correlation, round({_PEARSON.format(x='customers::DOUBLE', y='7::DOUBLE')}, 9) AS flat FROM k")
def pearson_safe(spark, sf_dir):
    counts = _counts(spark, sf_dir).withColumn("seven", F.lit(7))
    flat = stats.correlation(counts, "customers", "seven").select(F.round("correlation", 9).alias("flat"))
    return stats.correlation(counts, "customers", "suppliers").select(F.round("correlation", 9).alias("correlation")).crossJoin(F.broadcast(flat))


@register(
    REGISTRY,
    f"""WITH {_COUNTS}, r AS (SELECT rank() OVER (ORDER BY customers) + (count(*) OVER (PARTITION BY customers) - 1) / 2.0::DOUBLE AS rx, rank() OVER (ORDER BY suppliers) + (count(*) OVER (PARTITION BY suppliers) - 1) / 2.0::DOUBLE AS ry FROM k)
SELECT round({_PEARSON.format(x='rx', y='ry')}, 9) AS correlation FROM r""",
)
def spearman(spark, sf_dir):
    return stats.spearman(_counts(spark, sf_dir), "customers", "suppliers").select(F.round("correlation", 9).alias("correlation"))


@register(
    REGISTRY,
    """WITH a AS (SELECT l_orderkey, p_brand FROM lineitem JOIN part ON p_partkey = l_partkey), n AS (SELECT p_brand, count(*) AS n FROM a GROUP BY p_brand)
SELECT l_orderkey, round(max(1.0::DOUBLE / n) + 0.15::DOUBLE * sum(1.0::DOUBLE / n), 9) AS weight FROM a JOIN n USING (p_brand) GROUP BY l_orderkey""",
)
def rarity_weight(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return stats.rarity_weight(lines, "l_orderkey", "p_brand").select("l_orderkey", F.round("weight", 9).alias("weight"))


@register(
    REGISTRY,
    "SELECT 'lang' AS field, coalesce(lang, '') AS value, count(*) AS n FROM documents GROUP BY ALL UNION ALL SELECT 'source', coalesce(source, ''), count(*) FROM documents GROUP BY ALL",
)
def source_profile(spark, sf_dir):
    return stats.profile(read(spark, sf_dir, "documents"), ["lang", "source"])


@register(REGISTRY, "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS discounted, count(DISTINCT l_suppkey) AS suppliers, round(count(*) / greatest(1, count(DISTINCT l_orderkey))::DOUBLE, 6) AS per_order, coalesce(min(l_linenumber), 0) AS first_line, coalesce(max(l_linenumber), 0) AS last_line FROM lineitem GROUP BY ALL")
def conditional_counts(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"), F.count_distinct("l_suppkey").alias("suppliers"),
        F.round(F.count(F.lit(1)) / F.greatest(F.lit(1), F.count_distinct("l_orderkey")), 6).alias("per_order"), F.coalesce(F.min("l_linenumber"), F.lit(0)).alias("first_line"), F.coalesce(F.max("l_linenumber"), F.lit(0)).alias("last_line"),
    )
