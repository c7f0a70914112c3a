"""Exploration and cleaning of tables; labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import eda, labels
from .base import Registry, read, register

REGISTRY: Registry = {}


def _one(c: str) -> str:
    return f"SELECT '{c}' AS \"column\", count({c}) AS n, count(*) FILTER ({c} IS NULL) AS nulls, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont({c}, 0.5), 4) AS median, CAST(max({c}) AS DOUBLE) AS max FROM lineitem"


@register(REGISTRY, " UNION ALL ".join(_one(c) for c in ("l_quantity", "l_extendedprice", "l_discount")))
def eda_summary(spark, sf_dir):
    return eda.summary(read(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


_GAPS = "g AS (SELECT event_id, user_id, ts, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS value FROM events)"


def _gaps(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))


@register(REGISTRY, f"WITH {_GAPS} SELECT event_id, round(coalesce(value, (SELECT quantile_cont(value, 0.5) FROM g)), 6) AS value FROM g")
def fill_median(spark, sf_dir):
    return eda.fill_value(_gaps(spark, sf_dir), "value").select("event_id", F.round("value", 6).alias("value"))


@register(REGISTRY, "WITH g AS (SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_size END AS p_size FROM part) SELECT p_partkey, coalesce(p_size, (SELECT p_size FROM g WHERE p_size IS NOT NULL GROUP BY p_size ORDER BY count(*) DESC, p_size LIMIT 1)) AS p_size FROM g")
def fill_mode(spark, sf_dir):
    gaps = read(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 6 != 0, F.col("p_size")).alias("p_size"))
    return eda.fill_value(gaps, "p_size", "mode")


@register(REGISTRY, f"WITH {_GAPS} SELECT event_id, last_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS forward, first_value(value IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS backward FROM g")
def fill_forward_backward(spark, sf_dir):
    gaps = _gaps(spark, sf_dir).withColumn("forward", F.col("value")).withColumn("backward", F.col("value"))
    filled = eda.fill_along(eda.fill_along(gaps, "forward", ["user_id"], ["ts", "event_id"]), "backward", ["user_id"], ["ts", "event_id"], backward=True)
    return filled.select("event_id", "forward", "backward")


_FENCES = "f AS (SELECT l_returnflag, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY l_returnflag)"


@register(REGISTRY, f"WITH {_FENCES} SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem JOIN f USING (l_returnflag) WHERE l_extendedprice < q1 - 0.5 * (q3 - q1) OR l_extendedprice > q3 + 0.5 * (q3 - q1)")
def outlier_iqr(spark, sf_dir):
    return eda.outliers_iqr(read(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"], 0.5).select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")


@register(REGISTRY, f"WITH {_FENCES} SELECT l_returnflag, count(*) AS n, round(sum(least(greatest(l_extendedprice, q1 - 0.5 * (q3 - q1)), q3 + 0.5 * (q3 - q1))), 2) AS total FROM lineitem JOIN f USING (l_returnflag) GROUP BY l_returnflag")
def outlier_clip(spark, sf_dir):
    clipped = eda.outliers_iqr(read(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_returnflag"], 0.5, clip=True)
    return clipped.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("total"))


@register(REGISTRY, "WITH s AS (SELECT event_type, avg(value) AS m, stddev_pop(value) AS s FROM events GROUP BY event_type) SELECT event_id, event_type, value FROM events JOIN s USING (event_type) WHERE abs(value - m) > 1.5 * s")
def outlier_zscore(spark, sf_dir):
    return eda.outliers_zscore(read(spark, sf_dir, "events"), "value", ["event_type"], 1.5).select("event_id", "event_type", "value")


@register(REGISTRY, "SELECT p_partkey, round(coalesce((p_retailprice - min(p_retailprice) OVER w) / nullif(max(p_retailprice) OVER w - min(p_retailprice) OVER w, 0), 0), 9) AS scaled, round(coalesce((p_retailprice - avg(p_retailprice) OVER w) / nullif(stddev_pop(p_retailprice) OVER w, 0), 0), 6) AS z, CAST(dense_rank() OVER (ORDER BY p_brand) - 1 AS INTEGER) AS brand_code FROM part WINDOW w AS (PARTITION BY p_type)")
def scale_and_encode(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    scaled = eda.encode(eda.standardise(eda.min_max(part, "p_retailprice", ["p_type"], "scaled"), "p_retailprice", ["p_type"], "z"), "p_brand", "brand_code")
    return scaled.select("p_partkey", F.round("scaled", 9).alias("scaled"), F.round("z", 6).alias("z"), "brand_code")


@register(REGISTRY, "SELECT lang, source, count(*) - 1 AS surplus FROM documents GROUP BY lang, source HAVING count(*) > 1")
def duplicate_rows(spark, sf_dir):
    return eda.drop_duplicates(read(spark, sf_dir, "documents"), ["lang", "source"])[1]


@register(REGISTRY, "SELECT CASE WHEN grouping(event_type) = 1 THEN 'all' ELSE event_type END AS event_type, CASE WHEN grouping(y) = 1 THEN 'all' ELSE CAST(y AS VARCHAR) END AS y, count(*) AS n, round(avg(CASE WHEN value > 50 THEN 1 ELSE 0 END), 6) AS coverage FROM (SELECT event_type, month(ts) AS y, value FROM events) GROUP BY ROLLUP (event_type, y)")
def template_rollup(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_type", F.month("ts").alias("y"), "value")
    return eda.rollup_coverage(events, ["event_type", "y"], F.col("value") > 50)


@register(REGISTRY)
def pca_embeddings(spark, sf_dir):
    return eda.principal_components(read(spark, sf_dir, "embeddings"), "embedding", 3, "vec_id")


@register(REGISTRY, "SELECT c_nationkey, arg_max(c_name, c_custkey) AS last_name, arg_min(c_name, c_custkey) AS first_name FROM customer GROUP BY c_nationkey")
def first_and_last_per_key(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_name")
    last = labels.last_per_key(rows, "c_nationkey", "c_custkey").select("c_nationkey", F.col("c_name").alias("last_name"))
    return last.join(labels.first_per_key(rows, "c_nationkey", "c_custkey").select("c_nationkey", F.col("c_name").alias("first_name")), "c_nationkey")


@register(REGISTRY, "SELECT conv_id, turn, role, row_number() OVER (ORDER BY conv_id, turn) AS annotation_id FROM conversations")
def running_ids(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    return labels.running_ids(rows, "conv_id", "turn").select("conv_id", "turn", "role", F.col("annotation_id").cast("long").alias("annotation_id"))


@register(REGISTRY, "WITH a AS (SELECT l_orderkey, list('K-' || l_partkey ORDER BY l_linenumber, l_partkey) AS p FROM lineitem GROUP BY l_orderkey) SELECT l_orderkey, array_to_string(p, ',') AS products, len(p) <> len(list_distinct(p)) AS repeated FROM a")
def nested_products(spark, sf_dir):
    listed = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("a"))
    products = F.transform("a", lambda x: F.concat(F.lit("K-"), x["l_partkey"].cast("string")))
    return listed.select("l_orderkey", F.concat_ws(",", products).alias("products"), (F.size(F.array_distinct(products)) != F.size(products)).alias("repeated"))
