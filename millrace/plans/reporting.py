"""Registered reports, losses and per-object documents on the test tables, beside their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import losses, reports
from . import generation
from .base import BOXES, HEIGHT, WIDTH, Registry, boxes, inter, read, register, union
from .sampling import POINTS

REGISTRY: Registry = {}

# Annotations with planted faults: unknown products, a forbidden category, wrong indexes, assets that are missing.
_MARKED = """ann AS (SELECT image_id, pos, CASE WHEN part_id % 101 = 0 THEN -part_id ELSE part_id END AS product_id, CASE WHEN part_id % 97 = 0 THEN 1 ELSE part_id * 10 END AS category_id,
  CASE WHEN part_id % 89 = 0 THEN -1 ELSE part_id - 1 END AS class_index, part_id + CASE WHEN part_id % 83 = 0 THEN 1 ELSE 0 END AS source_asset_id, x, y, w, h FROM boxes),
cls AS (SELECT p_partkey AS product_id, p_partkey * 10 AS category_id, p_partkey - 1 AS class_index FROM part)"""


def _marked(spark, sf_dir):
    k = F.col("part_id")
    marked = boxes(spark, sf_dir).select(
        "image_id", "pos", F.when(k % 101 == 0, -k).otherwise(k).alias("product_id"), F.when(k % 97 == 0, F.lit(1)).otherwise(k * 10).alias("category_id"),
        F.when(k % 89 == 0, F.lit(-1)).otherwise(k - 1).alias("class_index"), (k + F.when(k % 83 == 0, 1).otherwise(0)).alias("source_asset_id"), *"xywh",
    )
    p = F.col("p_partkey")
    return marked, read(spark, sf_dir, "part").select(p.alias("product_id"), (p * 10).alias("category_id"), (p - 1).alias("class_index"))


_SUM = lambda condition: f"coalesce(sum(CASE WHEN {condition} THEN 1 ELSE 0 END), 0)"
_ROWS = lambda table, rules: " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) AS checked, CAST({_SUM(c)} AS BIGINT) AS violations FROM {table}" for n, c in rules.items())


@register(
    REGISTRY,
    f"""WITH {BOXES}, {_MARKED}, img AS (SELECT o_orderkey AS image_id, o_orderkey % 7 + 1 AS combo_size FROM orders),
a AS (SELECT ann.*, cls.product_id IS NOT NULL AS known, cls.category_id AS cc, cls.class_index AS ci, img.image_id IS NOT NULL AS has, s.product_id AS asset_of
  FROM ann LEFT JOIN cls USING (product_id) LEFT JOIN img ON img.image_id = ann.image_id LEFT JOIN cls s ON s.product_id = ann.source_asset_id),
per AS (SELECT image_id, count(*) AS n, count(DISTINCT product_id) AS products FROM ann GROUP BY 1),
ov AS (SELECT DISTINCT a.image_id FROM ann a JOIN ann b ON a.image_id = b.image_id AND a.pos < b.pos WHERE {inter("a", "b")} * 50 > {union("a", "b")}),
i AS (SELECT img.*, coalesce(n, 0) AS n, products, ov.image_id IS NOT NULL AS met FROM img LEFT JOIN per USING (image_id) LEFT JOIN ov USING (image_id)),
u AS (SELECT cls.product_id, count(ann.product_id) AS made FROM cls LEFT JOIN ann USING (product_id) GROUP BY 1)
SELECT * FROM ({_ROWS("a", {"unknown_product": "NOT known", "forbidden_category": "known AND category_id = 1", "category_mismatch": "known AND category_id <> cc", "class_index_mismatch": "known AND class_index <> ci",
    "box": f"NOT (has AND x >= 0 AND y >= 0 AND w > 0 AND h > 0 AND x + w <= {WIDTH} AND y + h <= {HEIGHT})", "source_asset": "known AND asset_of IS DISTINCT FROM product_id"})}
UNION ALL {_ROWS("i", {"combo_size": "combo_size <> n", "duplicate_product": "products < n", "overlap": "met"})} UNION ALL {_ROWS("u", {"unused_class": "made = 0", "below_floor": "made + 1 < 20"})})""",
)
def strict_report(spark, sf_dir):
    marked, classes = _marked(spark, sf_dir)
    images = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"), F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"), (F.col("o_orderkey") % 7 + 1).alias("combo_size"))
    assets = classes.select(F.col("product_id").alias("asset_id"), "product_id")
    return reports.strict_report(images, marked, classes, assets, classes.select("product_id"), 20).select("rule", "checked", "violations")


@register(
    REGISTRY,
    f"""WITH a AS (SELECT s_suppkey AS asset_id, s_nationkey AS product_id, CASE WHEN s_suppkey % 9 = 0 THEN 1 ELSE s_nationkey + 100 END AS category_id, s_nationkey AS class_index FROM supplier),
c AS (SELECT n_nationkey AS product_id, n_nationkey + 100 AS category_id, n_nationkey AS class_index FROM nation WHERE n_regionkey <> 2), m AS (SELECT a.*, c.product_id IS NOT NULL AS known, c.category_id AS cc FROM a LEFT JOIN c USING (product_id)),
k AS (SELECT asset_id, count(*) AS n FROM a GROUP BY 1), u AS (SELECT c.product_id, count(a.asset_id) AS have FROM c LEFT JOIN a USING (product_id) GROUP BY 1)
SELECT * FROM ({_ROWS("m", {"unknown_product": "NOT known", "forbidden_category": "known AND category_id = 1", "mapping": "known AND category_id <> cc"})} UNION ALL {_ROWS("k", {"duplicate_asset": "n > 1"})} UNION ALL {_ROWS("u", {"quota": "have <> 4"})})""",
)
def asset_report(spark, sf_dir):
    n, s = F.col("n_nationkey"), F.col("s_nationkey")
    classes = read(spark, sf_dir, "nation").where("n_regionkey <> 2").select(n.alias("product_id"), (n + 100).alias("category_id"), n.alias("class_index"))
    bank = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("asset_id"), s.alias("product_id"), F.when(F.col("s_suppkey") % 9 == 0, F.lit(1)).otherwise(s + 100).alias("category_id"), s.alias("class_index"))
    return reports.asset_report(bank, classes, 4).select("rule", "checked", "violations")


@register(
    REGISTRY,
    """WITH e AS (SELECT o_orderkey % 5 AS set_id, CAST(o_orderkey AS VARCHAR) AS member FROM orders), a AS (SELECT o_orderkey % 5 AS set_id, CAST(CASE WHEN o_orderkey % 50 = 0 THEN -o_orderkey ELSE o_orderkey END AS VARCHAR) AS member FROM orders)
SELECT set_id, rule, count(*) AS violations FROM (SELECT set_id, 'missing_member' AS rule FROM e ANTI JOIN a USING (set_id, member) UNION ALL SELECT set_id, 'extra_member' FROM a ANTI JOIN e USING (set_id, member)
UNION ALL SELECT o_orderkey % 5, 'changed_document' FROM orders WHERE o_orderkey % 31 = 0) GROUP BY ALL""",
)
def compressed_report(spark, sf_dir):
    k = F.col("o_orderkey")
    orders = read(spark, sf_dir, "orders").withColumn("set_id", k % 5)
    expected = orders.select("set_id", k.cast("string").alias("member"))
    actual = orders.select("set_id", F.when(k % 50 == 0, -k).otherwise(k).cast("string").alias("member"))
    before = orders.select("set_id", k.alias("doc"), F.col("o_custkey").alias("width"))
    after = before.withColumn("width", F.when(F.col("doc") % 31 == 0, F.col("width") + 1).otherwise(F.col("width")))
    return reports.compressed_report(expected, actual, before, after, ["doc"], ["width"])


@register(
    REGISTRY,
    f"""WITH {BOXES}, s AS (SELECT l_suppkey % 25 AS category_id, count(*) AS source FROM lineitem WHERE l_quantity > 20 GROUP BY 1), g AS (SELECT supp_id % 25 AS category_id, count(*) AS made FROM boxes GROUP BY 1),
k AS (SELECT source, coalesce(made, 0) AS made FROM nation JOIN s ON s.category_id = n_nationkey LEFT JOIN g ON g.category_id = n_nationkey),
r AS (SELECT *, rank() OVER (ORDER BY source) + (count(*) OVER (PARTITION BY source) - 1) / 2.0::DOUBLE AS rx, rank() OVER (ORDER BY made) + (count(*) OVER (PARTITION BY made) - 1) / 2.0::DOUBLE AS ry FROM k),
p AS (SELECT image_id, count(*) AS n FROM boxes GROUP BY 1), q AS (SELECT w * h / {WIDTH * HEIGHT}::DOUBLE AS share FROM boxes),
v AS (SELECT 'mean_objects' AS rule, avg(n) AS value FROM p UNION ALL SELECT 'share_of_other_sizes', avg(CASE WHEN n BETWEEN 2 AND 4 THEN 0.0::DOUBLE ELSE 1 END) FROM p
  UNION ALL SELECT 'share_within_area', avg(CASE WHEN share BETWEEN 0.02::DOUBLE AND 0.12::DOUBLE THEN 1.0::DOUBLE ELSE 0 END) FROM q
  UNION ALL SELECT 'area_p05', quantile_cont(share, 0.05) FROM q UNION ALL SELECT 'area_p50', quantile_cont(share, 0.5) FROM q UNION ALL SELECT 'area_p95', quantile_cont(share, 0.95) FROM q
  UNION ALL SELECT 'spearman', coalesce(corr(rx, ry), 0) FROM r UNION ALL SELECT 'pearson', coalesce(corr(source, made), 0) FROM r)
SELECT rule, round(value, 6) AS value, CASE WHEN rule = 'mean_objects' THEN value BETWEEN 3.2 AND 3.4 WHEN rule = 'share_of_other_sizes' THEN value = 0 WHEN rule IN ('area_p05', 'area_p95') THEN value BETWEEN 0.02::DOUBLE AND 0.12::DOUBLE END AS passed FROM v""",
)
def distribution_report(spark, sf_dir):
    made = boxes(spark, sf_dir).withColumn("category_id", F.col("supp_id") % 25)
    source = read(spark, sf_dir, "lineitem").where("l_quantity > 20").select((F.col("l_suppkey") % 25).alias("category_id"))
    return reports.distribution_report(made, read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("category_id")), source, WIDTH, HEIGHT)


@register(REGISTRY, "WITH s AS (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') SELECT count(*) AS candidates, count(l_orderkey) AS suspects, count(*) - count(l_orderkey) AS clean FROM orders LEFT JOIN s ON l_orderkey = o_orderkey")
def dirty_audit(spark, sf_dir):
    suspects = read(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return reports.dirty_audit(read(spark, sf_dir, "orders").select("o_orderkey"), suspects, ["o_orderkey"])[1]


@register(
    REGISTRY,
    """WITH s AS (SELECT l_orderkey AS item, l_returnflag AS label, avg(l_quantity::DOUBLE) AS s FROM lineitem GROUP BY ALL), t AS (SELECT *, max(s) OVER (PARTITION BY item) AS best FROM s)
SELECT item, min(label) AS label, round(best, 6) AS score FROM t WHERE s = best GROUP BY item, best""",
)
def averaged_views(spark, sf_dir):
    views = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("item"), F.col("l_returnflag").alias("label"), F.col("l_quantity").cast("double").alias("q"))
    return reports.averaged_views(views, "item", "label", "q").withColumn("score", F.round("score", 6))


@register(
    REGISTRY,
    """WITH r AS (SELECT l_returnflag AS grp, l_linenumber % 2 AS y, (l_quantity::DOUBLE + 1) / 60 AS p FROM lineitem),
m AS (SELECT *, CASE WHEN y = 1 THEN p ELSE 1 - p END AS ok FROM r),
s AS (SELECT grp, avg(-(2 * y * ln(p) + (1 - y) * ln(1 - p))) AS weighted, avg(-(CASE WHEN y = 1 THEN 0.25::DOUBLE ELSE 0.75::DOUBLE END) * pow(1 - ok, 2) * ln(ok)) AS focal, 1 - sum(p * y) / (sum(p * y) + 0.7::DOUBLE * sum((1 - p) * y) + 0.3::DOUBLE * sum(p * (1 - y))) AS tversky FROM m GROUP BY grp)
SELECT grp, round(weighted, 5) AS weighted, round(focal, 5) AS focal, round(tversky, 5) AS tversky, round(0.5::DOUBLE * weighted + 0.5::DOUBLE * tversky, 5) AS combined FROM s""",
)
def loss_report(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("grp"), (F.col("l_linenumber") % 2).alias("y"), ((F.col("l_quantity").cast("double") + 1) / 60).alias("p"))
    return losses.losses(rows, ["grp"], "p", "y", positive=2.0).select("grp", *[F.round(c, 5).alias(c) for c in ("weighted", "focal", "tversky", "combined")])


@register(
    REGISTRY,
    f"""WITH {BOXES}, k AS (SELECT image_id, string_agg(CAST(part_id AS VARCHAR), '-' ORDER BY pos) AS key FROM boxes GROUP BY 1)
SELECT key || '_json/' || part_id || '/img_' || image_id || '.json' AS file,
 '{{"images":[{{"file_name":"img_' || image_id || '.png","width":{WIDTH},"height":{HEIGHT},"drug_N":"' || part_id || '"}}],"type":"instances","annotations":[{{"area":' || w * h || ',"iscrowd":0,"bbox":[' || x || ',' || y || ',' || w || ',' || h
 || '],"category_id":' || supp_id || ',"ignore":0,"segmentation":[],"id":' || pos || ',"image_id":' || image_id || '}}],"categories":[{{"supercategory":"pill","id":' || supp_id || ',"name":"s' || supp_id || '"}}]}}' AS content
FROM boxes JOIN k USING (image_id) JOIN supplier ON s_suppkey = supp_id""",
)
def object_documents(spark, sf_dir):
    found = boxes(spark, sf_dir).select("image_id", "pos", F.col("pos").alias("id"), F.col("part_id").alias("product_id"), F.col("supp_id").alias("category_id"), *"xywh")
    images = found.select("image_id").distinct().select("image_id", F.concat(F.lit("img_"), F.col("image_id").cast("string"), F.lit(".png")).alias("file_name"), F.lit(WIDTH).alias("width"), F.lit(HEIGHT).alias("height"))
    key = F.col("s_suppkey")
    return generation.object_documents(images, found, read(spark, sf_dir, "supplier").select(key.alias("category_id"), F.concat(F.lit("s"), key.cast("string")).alias("name")))


@register(REGISTRY)
def generated_annotations(spark, sf_dir):
    """A set generated over all customers as combinations; tests hold it against the rules that it must keep."""
    c = F.col
    sizes = read(spark, sf_dir, "customer").select(c("c_custkey").alias("combo"), (2 + c("c_custkey") % 3).cast("int").alias("size"))
    classes = read(spark, sf_dir, "nation").select(c("n_nationkey").alias("product_id"), (c("n_nationkey") + 100).alias("category_id"), c("n_nationkey").alias("class_index"))
    bank = read(spark, sf_dir, "part").select(c("p_partkey").alias("asset_id"), (c("p_partkey") % 25).cast("int").alias("product_id"), (F.lit(0.8) + c("p_size") / 100).alias("aspect"))
    return generation.generate(sizes, classes, bank, POINTS, WIDTH, HEIGHT, "g")[1]
