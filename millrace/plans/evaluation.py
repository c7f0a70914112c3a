"""Detection and segmentation scores, consensus, retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import detection, retrieval
from ..operators.prefix import quantile_bounds
from .base import BOXES, Registry, boxes, inter, read, register, union

REGISTRY: Registry = {}

# Detections: the boxes moved a little, some of them far, with a score from the keys; classes from the supplier.
_DET = f"""{BOXES}, truth AS (SELECT image_id, supp_id % 5 AS class, pos, x, y, w, h FROM boxes),
found AS (SELECT image_id, class, pos, x + (pos * 7) % 15 + CASE WHEN (image_id + pos) % 6 = 0 THEN 300 ELSE 0 END AS x, y + (pos * 5) % 11 AS y, w, h, (image_id * 31 + pos * 17) % 1000 AS score FROM truth),
best AS (SELECT f.image_id, f.class, f.pos, f.score, arg_max(t.pos, (({inter("f", "t")} / {union("f", "t")}::DOUBLE), -t.pos)) AS gt, max({inter("f", "t")} / {union("f", "t")}::DOUBLE) AS iou FROM found f JOIN truth t USING (image_id, class) GROUP BY ALL),
hit AS (SELECT image_id, class, pos FROM best WHERE iou * 100 >= 50 QUALIFY row_number() OVER (PARTITION BY image_id, class, gt ORDER BY score DESC, pos) = 1),
matched AS (SELECT f.image_id, f.class, f.pos, f.score, CASE WHEN hit.pos IS NULL THEN 0 ELSE 1 END AS tp FROM found f LEFT JOIN hit USING (image_id, class, pos)),
nt AS (SELECT class, count(*) AS n_truth FROM truth GROUP BY class),
curve AS (SELECT class, image_id, pos, sum(tp) OVER w AS tps, count(*) OVER w AS rank, n_truth FROM matched JOIN nt USING (class) WINDOW w AS (PARTITION BY class ORDER BY score DESC, image_id, pos ROWS UNBOUNDED PRECEDING))"""


def _truth(spark, sf_dir):
    return boxes(spark, sf_dir).select("image_id", (F.col("supp_id") % 5).alias("class"), "pos", "x", "y", "w", "h")


def _found(spark, sf_dir):
    far = F.when((F.col("image_id") + F.col("pos")) % 6 == 0, 300).otherwise(0)
    moved = _truth(spark, sf_dir).withColumn("x", F.col("x") + F.col("pos") * 7 % 15 + far).withColumn("y", F.col("y") + F.col("pos") * 5 % 11)
    return moved.withColumn("score", (F.col("image_id") * 31 + F.col("pos") * 17) % 1000)


def _matched(spark, sf_dir):
    return detection.match(_truth(spark, sf_dir), _found(spark, sf_dir), ["image_id", "class"], "pos", "score")


def _counts(spark, sf_dir):
    return _truth(spark, sf_dir).groupBy("class").agg(F.count(F.lit(1)).alias("n_truth"))


@register(REGISTRY, f"WITH {_DET} SELECT class, sum(tp) AS tp, count(*) - sum(tp) AS fp, any_value(n_truth) - sum(tp) AS fn FROM matched JOIN nt USING (class) GROUP BY class")
def det_match(spark, sf_dir):
    m = _matched(spark, sf_dir).groupBy("class").agg(F.sum("tp").alias("tp"), (F.count(F.lit(1)) - F.sum("tp")).alias("fp"))
    return m.join(_counts(spark, sf_dir), "class").select("class", "tp", "fp", (F.col("n_truth") - F.col("tp")).alias("fn"))


def _curve(spark, sf_dir, counts):
    bounds = quantile_bounds(_found(spark, sf_dir).select((-F.col("score")).alias("o")), "o")
    return detection.pr_curve(_matched(spark, sf_dir), counts, "class", "score", ["image_id", "pos"], bounds)


@register(REGISTRY, f'WITH {_DET} SELECT class, image_id, pos, round(tps / rank::DOUBLE, 9) AS "precision", round(tps / n_truth::DOUBLE, 9) AS recall FROM curve')
def pr_curve(spark, sf_dir):
    return _curve(spark, sf_dir, _counts(spark, sf_dir)).select("class", "image_id", "pos", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


_AP = "ap AS (SELECT class, n_truth, round(coalesce(sum(p), 0) / 101, 6) AS ap FROM (SELECT nt.class, nt.n_truth, k, max(tps / rank::DOUBLE) AS p FROM nt, range(0, 101) r(k) LEFT JOIN curve c ON c.class = nt.class AND 100 * c.tps >= k * nt.n_truth GROUP BY ALL) GROUP BY class, n_truth)"


@register(REGISTRY, f"WITH {_DET}, {_AP} SELECT class, n_truth, ap FROM ap")
def ap101(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return detection.average_precision(_curve(spark, sf_dir, counts), counts, "class")


@register(REGISTRY, f"WITH {_DET}, {_AP} SELECT round(avg(ap), 6) AS map FROM ap")
def mean_ap(spark, sf_dir):
    return ap101(spark, sf_dir).agg(F.round(F.avg("ap"), 6).alias("map"))


@register(
    REGISTRY,
    f"""WITH {_DET} SELECT CASE WHEN w * h < 15000 THEN 'S' WHEN w * h < 40000 THEN 'M' ELSE 'L' END AS size, count(*) AS n_found, sum(tp) AS tp FROM matched JOIN found USING (image_id, class, pos) GROUP BY ALL""",
)
def tp_by_size(spark, sf_dir):
    area = F.col("w") * F.col("h")
    size = F.when(area < 15000, "S").when(area < 40000, "M").otherwise("L").alias("size")
    return _matched(spark, sf_dir).groupBy(size).agg(F.count(F.lit(1)).alias("n_found"), F.sum("tp").alias("tp"))


_CONF = "m AS (SELECT label AS truth, CAST(CASE WHEN vec_id % 3 = 0 THEN (vec_id * 7 + label) % 10 ELSE label END AS INTEGER) AS predicted, count(*) AS n FROM embeddings GROUP BY ALL)"


def _confusion(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    predicted = F.when(F.col("vec_id") % 3 == 0, (F.col("vec_id") * 7 + F.col("label")) % 10).otherwise(F.col("label")).cast("int")
    return detection.confusion(e.withColumn("p", predicted), "label", "p")


@register(REGISTRY, f"WITH {_CONF} SELECT * FROM m")
def confusion(spark, sf_dir):
    return _confusion(spark, sf_dir)


_CLASS = f"""{_CONF}, c AS (SELECT coalesce(t.class, p.class) AS class, coalesce(hit, 0) AS hit, coalesce(a, 0) + coalesce(b, 0) - coalesce(hit, 0) AS u
  FROM (SELECT truth AS class, sum(n) AS a, sum(CASE WHEN truth = predicted THEN n ELSE 0 END) AS hit FROM m GROUP BY truth) t FULL JOIN (SELECT predicted AS class, sum(n) AS b FROM m GROUP BY predicted) p ON t.class = p.class),
s AS (SELECT class, hit, u AS "union", round(hit / greatest(u, 1)::DOUBLE, 6) AS iou, round(2 * (hit / greatest(u, 1)::DOUBLE) / (1 + hit / greatest(u, 1)::DOUBLE), 6) AS dice FROM c)"""


@register(REGISTRY, f"WITH {_CLASS} SELECT * FROM s")
def iou_dice(spark, sf_dir):
    return detection.overlap_scores(_confusion(spark, sf_dir))


@register(REGISTRY, f"WITH {_CLASS} SELECT (SELECT round(sum(CASE WHEN truth = predicted THEN n ELSE 0 END) / greatest(sum(n), 1)::DOUBLE, 6) FROM m) AS pixel_accuracy, round(avg(iou), 6) AS mean_iou, round(avg(dice), 6) AS mean_dice FROM s")
def segmentation_scores(spark, sf_dir):
    return detection.overall_scores(_confusion(spark, sf_dir))


@register(
    REGISTRY,
    f"""WITH {_DET}, pq AS (SELECT f.class, {inter("f", "t")} / {union("f", "t")}::DOUBLE AS iou FROM found f JOIN truth t USING (image_id, class, pos)),
h AS (SELECT class, count(*) AS tp, sum(iou) AS s FROM pq WHERE iou > 0.5 GROUP BY class)
SELECT class, coalesce(tp, 0) AS tp, round(coalesce(s / tp, 0), 6) AS sq, round(coalesce(tp, 0) / n_truth::DOUBLE, 6) AS rq, round(coalesce(s / tp, 0) * (coalesce(tp, 0) / n_truth::DOUBLE), 6) AS pq FROM nt LEFT JOIN h USING (class)""",
)
def panoptic_quality(spark, sf_dir):
    from ..functions.geometry import Box

    truth = _truth(spark, sf_dir).select("image_id", "class", "pos", *[F.col(c).alias(f"g_{c}") for c in "xywh"])
    pairs = _found(spark, sf_dir).join(truth, ["image_id", "class", "pos"]).withColumn("iou", Box.of().iou(Box.of("g_")))
    n = _counts(spark, sf_dir)
    return detection.panoptic_quality(pairs, n, n.withColumnRenamed("n_truth", "n_found"), "class")


# Votes: five methods see each part, each shifted by its own amount.
_VOTES = """votes AS (SELECT p_partkey, CAST(m AS INTEGER) AS method, (p_partkey * 13) % 400 + m * (p_partkey % 9) * 4 AS x, (p_partkey * 29) % 500 + m * (p_partkey % 5) AS y, 100 + p_size AS w, 120 + p_size AS h FROM part, range(0, 5) r(m))"""


@register(
    REGISTRY,
    f"""WITH {_VOTES}, agree AS (SELECT a.p_partkey, a.method, b.x, b.y, b.w, b.h FROM votes a JOIN votes b USING (p_partkey) WHERE {inter("a", "b")} * 100 / {union("a", "b")}::DOUBLE >= 50),
d AS (SELECT p_partkey, method, count(*) AS support FROM agree GROUP BY ALL), core AS (SELECT * FROM d WHERE support >= 3 QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY support DESC, method) = 1)
SELECT p_partkey, support, quantile_cont(x, 0.5) AS x, quantile_cont(y, 0.5) AS y, quantile_cont(w, 0.5) AS w, quantile_cont(h, 0.5) AS h FROM agree JOIN core USING (p_partkey, method) GROUP BY p_partkey, support""",
)
def box_consensus(spark, sf_dir):
    p = F.col("p_partkey")
    part = read(spark, sf_dir, "part").withColumn("method", F.explode(F.sequence(F.lit(0), F.lit(4))))
    m = F.col("method")
    votes = part.select("p_partkey", "method", (p * 13 % 400 + m * (p % 9) * 4).alias("x"), (p * 29 % 500 + m * (p % 5)).alias("y"), (100 + F.col("p_size")).alias("w"), (120 + F.col("p_size")).alias("h"))
    return detection.consensus(votes, ["p_partkey"], "method")


@register(
    REGISTRY,
    """WITH g AS (SELECT o_orderpriority AS grp, count(*) FILTER (o_orderkey % 997 <> 0) AS hits, count(*) AS n, count(DISTINCT o_orderstatus) AS strategies, count(DISTINCT o_custkey % 4) AS families, 0.95 AS quality FROM orders GROUP BY 1),
l AS (SELECT *, CASE WHEN n > 0 THEN (hits / n::DOUBLE + 3.8416 / (2 * n) - 1.96 * sqrt((hits / n::DOUBLE) * (1 - hits / n::DOUBLE) / n + 3.8416 / (4 * n * n::DOUBLE))) / (1 + 3.8416 / n) ELSE 0 END AS lower FROM g)
SELECT grp, hits, n, round(lower, 9) AS lower, n >= 500 AND lower >= 0.995 AND strategies >= 3 AND families >= 2 AND quality >= 0.9 AS promoted FROM l""",
)
def wilson_gate(spark, sf_dir):
    groups = read(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("grp")).agg(
        F.count_if(F.col("o_orderkey") % 997 != 0).alias("hits"), F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderstatus").alias("strategies"), F.count_distinct(F.col("o_custkey") % 4).alias("families"), F.lit(0.95).alias("quality")
    )
    return detection.promotion(groups, "hits", "n", "strategies", "families", "quality").select("grp", "hits", "n", "lower", "promoted")


_TOP = """q AS (SELECT vec_id AS query_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id % 20 = 0),
s AS (SELECT query_id, vec_id AS item_id, round(coalesce(list_dot_product(e, embedding::DOUBLE[]) / (sqrt(list_dot_product(e, e)) * sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 0), 6) AS similarity FROM q, embeddings WHERE query_id <> vec_id),
top AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, item_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 10)"""


def _top(spark, sf_dir):
    """The stated queries, every id divisible by 20, against all rows."""
    e = read(spark, sf_dir, "embeddings")
    return retrieval.top_k(e.where("vec_id % 20 = 0"), e, "vec_id", "embedding", 10)


@register(REGISTRY, f"WITH {_TOP} SELECT query_id, rank, item_id, similarity FROM top")
def knn_topk(spark, sf_dir):
    return _top(spark, sf_dir).select("query_id", "rank", "item_id", "similarity")


@register(
    REGISTRY,
    f"""WITH {_TOP}, b AS (SELECT query_id, label, max(similarity) AS s FROM top JOIN embeddings ON vec_id = item_id GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, label) AS r FROM b),
w AS (SELECT query_id, max(s) FILTER (r = 1) AS s1, max(s) FILTER (r = 2) AS s2, max(label) FILTER (r = 1) AS l FROM r GROUP BY query_id)
SELECT query_id, CASE WHEN s2 IS NULL OR round(s1 - s2, 6) > 0.02 THEN CAST(l AS VARCHAR) ELSE 'unknown' END AS answer FROM w""",
)
def open_set_unknown(spark, sf_dir):
    return retrieval.open_set(_top(spark, sf_dir), read(spark, sf_dir, "embeddings"), "vec_id", "label")
