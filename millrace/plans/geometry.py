"""Boxes: validity, overlap, placement grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import Box, grid_cells
from ..operators import detection, overlap
from .base import BOXES, HEIGHT, WIDTH, Registry, boxes, inter, read, register, union

REGISTRY: Registry = {}


def _size():
    return F.lit(WIDTH), F.lit(HEIGHT)


@register(
    REGISTRY,
    f"""WITH {BOXES} SELECT image_id, pos, (x >= 0 AND y >= 0 AND w > 0 AND h > 0 AND x + w <= {WIDTH} AND y + h <= {HEIGHT}) AS strict,
    (w > 0 AND h > 0 AND x < {WIDTH} AND y < {HEIGHT} AND x + w > 0 AND y + h > 0) AS loose FROM boxes""",
)
def bbox_valid(spark, sf_dir):
    box = Box.of()
    return boxes(spark, sf_dir).select("image_id", "pos", box.strict(*_size()).alias("strict"), box.loose(*_size()).alias("loose"))


@register(
    REGISTRY,
    f"""WITH {BOXES}, b AS (SELECT image_id, pos, x - 40 AS x, y, w, h, CASE WHEN part_id % 11 = 0 THEN 0 ELSE {WIDTH} END AS width, {HEIGHT} AS height, part_id FROM boxes)
SELECT image_id, pos, CASE WHEN width <= 0 THEN 'invalid_dimensions' WHEN part_id % 13 = 0 THEN 'invalid_bbox' WHEN x < 0 OR y < 0 OR w <= 0 OR h <= 0 THEN 'non_positive'
  WHEN x + w > width OR y + h > height THEN 'out_of_bounds' END AS error_code FROM b""",
)
def bbox_error_code(spark, sf_dir):
    b = boxes(spark, sf_dir)
    box = Box(F.when(F.col("part_id") % 13 != 0, F.col("x") - 40), F.col("y"), F.col("w"), F.col("h"))
    width = F.when(F.col("part_id") % 11 == 0, 0).otherwise(WIDTH)
    return b.select("image_id", "pos", box.error_code(width, F.lit(HEIGHT)).alias("error_code"))


@register(
    REGISTRY,
    f"""WITH {BOXES}, m AS (SELECT *, greatest(2.0, round_even(greatest(w, h) * 0.07::DOUBLE, 0)) AS r, greatest(10.0, greatest(w, h) * 0.18::DOUBLE) AS f FROM boxes)
SELECT image_id, pos, CAST(greatest(floor(x - r), 0) AS BIGINT) AS rx0, CAST(least(ceil(x + w + r), {WIDTH}) AS BIGINT) AS rx1, CAST(greatest(floor(y - f), 0) AS BIGINT) AS fy0,
  CAST(least(ceil(y + h + f), {HEIGHT}) AS BIGINT) AS fy1, CAST(greatest(x - 24, 0) AS BIGINT) AS px0, CAST(least(y + h + 24, {HEIGHT}) AS BIGINT) AS py1 FROM m""",
)
def bbox_expand(spark, sf_dir):
    box = Box.of()
    ratio, fraction, fixed = (box.expanded(*_size(), m) for m in (box.ratio_margin(), box.fraction_margin(), F.lit(24)))
    return boxes(spark, sf_dir).select("image_id", "pos", ratio[0].alias("rx0"), ratio[2].alias("rx1"), fraction[1].alias("fy0"), fraction[3].alias("fy1"), fixed[0].alias("px0"), fixed[3].alias("py1"))


@register(REGISTRY, f"WITH {BOXES} SELECT image_id, pos, round(sqrt(greatest(w * h, 0)), 6) AS side, round(w * h / greatest({WIDTH * HEIGHT}, 1), 9) AS relative_area FROM boxes")
def bbox_size(spark, sf_dir):
    box = Box.of()
    return boxes(spark, sf_dir).select("image_id", "pos", F.round(box.side(), 6).alias("side"), F.round(box.relative_area(*_size()), 9).alias("relative_area"))


_PAIRS = f"""{BOXES}, pairs AS (SELECT a.image_id, a.pos AS a_pos, b.pos AS b_pos, {inter("a", "b")} / {union("a", "b")}::DOUBLE AS iou
  FROM boxes a JOIN boxes b ON a.image_id = b.image_id AND a.pos < b.pos WHERE {inter("a", "b")} * 50 > {union("a", "b")})"""


@register(REGISTRY, f"WITH {_PAIRS} SELECT image_id, a_pos, b_pos, round(iou, 9) AS iou FROM pairs")
def iou_pairs(spark, sf_dir):
    return overlap.overlap_pairs(boxes(spark, sf_dir), "image_id", "pos").select("image_id", "a_pos", "b_pos", F.round("iou", 9).alias("iou"))


@register(REGISTRY, f"WITH {_PAIRS} SELECT image_id, count(*) AS per_pair, count(DISTINCT a_pos) AS per_left FROM pairs GROUP BY image_id")
def iou_failures(spark, sf_dir):
    return overlap.failures(overlap.overlap_pairs(boxes(spark, sf_dir), "image_id", "pos"), "image_id")


@register(REGISTRY, f"WITH {_PAIRS} SELECT image_id, count(DISTINCT a_pos) AS per_left FROM pairs GROUP BY image_id")
def nested_overlap(spark, sf_dir):
    return overlap.nested_overlaps(boxes(spark, sf_dir), "image_id", "pos")


@register(
    REGISTRY,
    f"""WITH RECURSIVE {BOXES}, r AS (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY part_id * 7919 % 1000 DESC, pos) AS r FROM boxes),
s AS (SELECT image_id, 0::BIGINT AS r, []::STRUCT(pos INTEGER, x BIGINT, y BIGINT, w BIGINT, h BIGINT)[] AS kept FROM (SELECT DISTINCT image_id FROM boxes)
  UNION ALL SELECT b.image_id, b.r, CASE WHEN len(list_filter(kept, lambda k: {inter("k", "b")} * 10 > {union("k", "b")})) > 0 THEN kept ELSE list_append(kept, {{'pos': pos, 'x': x, 'y': y, 'w': w, 'h': h}}) END
  FROM s JOIN r b ON b.image_id = s.image_id AND b.r = s.r + 1)
SELECT image_id, unnest(list_transform(kept, lambda k: k.pos)) AS pos FROM s QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY r DESC) = 1""",
)
def nms(spark, sf_dir):
    found = boxes(spark, sf_dir).withColumn("score", F.col("part_id") * 7919 % 1000)
    return overlap.non_maximum_suppression(found, ["image_id"], "score", "pos", 1, 10)


@register(
    REGISTRY,
    """SELECT n AS size, c.x0, c.y0, c.x1, c.y1 FROM (VALUES
 (2, 72, 92, 416, 1188), (2, 488, 92, 904, 1188), (3, 72, 92, 416, 640), (3, 488, 92, 904, 640), (3, 244, 640, 732, 1188),
 (4, 72, 92, 416, 640), (4, 488, 92, 904, 640), (4, 72, 640, 416, 1188), (4, 488, 640, 904, 1188)) AS c(n, x0, y0, x1, y1)""",
)
def grid_cells_by_size(spark, sf_dir):
    return spark.range(2, 5).select(F.col("id").cast("int").alias("size")).select("size", F.inline(grid_cells(F.col("size"))))


@register(
    REGISTRY,
    """WITH i AS (SELECT p_partkey, CAST(500 + p_size * 40 AS INTEGER) AS width, CAST(400 + p_size * 30 AS INTEGER) AS height FROM part),
x AS (SELECT *, unnest(range(0, CAST(greatest(0, ceil((width - 512) / 448.0)) AS BIGINT) + 1)) AS tx FROM i), y AS (SELECT *, unnest(range(0, CAST(greatest(0, ceil((height - 512) / 448.0)) AS BIGINT) + 1)) AS ty FROM x),
z AS (SELECT *, greatest(0, least(tx * 448, width - 512)) AS x0, greatest(0, least(ty * 448, height - 512)) AS y0 FROM y)
SELECT p_partkey, tx, ty, x0, y0, least(x0 + 512, width) AS x1, least(y0 + 512, height) AS y1 FROM z""",
)
def tile_grid(spark, sf_dir):
    images = read(spark, sf_dir, "part").select("p_partkey", (500 + F.col("p_size") * 40).alias("width"), (400 + F.col("p_size") * 30).alias("height"))
    return detection.tile_grid(images, "width", "height", 512, 64).select("p_partkey", "tx", "ty", "x0", "y0", "x1", "y1")
