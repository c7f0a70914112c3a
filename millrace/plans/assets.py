"""Asset banks, placement, archives and image measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import images
from ..operators import assets
from ..sources import archives
from .base import BOXES, HEIGHT, WIDTH, Registry, boxes, read, register

REGISTRY: Registry = {}


@register(REGISTRY, "SELECT p_partkey, CASE WHEN p_brand = 'Brand#11' THEN 'val_official_single_ood' ELSE 'train_seen' END AS split FROM part")
def required_split(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", assets.required_split(F.col("p_brand"), {"Brand#11": "val_official_single_ood"}).alias("split"))


_RATIOS = f"r AS (SELECT image_id, pos, (pos * 31 + part_id) % 140 / 100.0::DOUBLE AS area, (part_id % 100) / 100.0::DOUBLE AS fill, w / 200.0::DOUBLE AS rw, h / 220.0::DOUBLE AS rh, w, h, x <= 1 OR y <= 1 AS touches FROM boxes)"


def _ratios(spark, sf_dir):
    p, k = F.col("pos"), F.col("part_id")
    return boxes(spark, sf_dir).select(
        "image_id", "pos", ((p * 31 + k) % 140 / F.lit(100.0)).alias("area"), (k % 100 / F.lit(100.0)).alias("fill"), (F.col("w") / F.lit(200.0)).alias("rw"), (F.col("h") / F.lit(220.0)).alias("rh"),
        "w", "h", ((F.col("x") <= 1) | (F.col("y") <= 1)).alias("touches"),
    )


@register(
    REGISTRY,
    f"""WITH {BOXES}, {_RATIOS} SELECT image_id, pos, area BETWEEN 0.20::DOUBLE AND 1.28::DOUBLE AND fill <= 0.93::DOUBLE AND rw BETWEEN 0.48::DOUBLE AND 1.24::DOUBLE AND rh BETWEEN 0.48::DOUBLE AND 1.24::DOUBLE AND NOT touches AS cutout,
  area BETWEEN 0.18::DOUBLE AND 1.10::DOUBLE AND w >= 24 AND h >= 24 AND NOT touches AS mask, area BETWEEN 0.14::DOUBLE AND 1.22::DOUBLE AND fill <= 0.94::DOUBLE AND w >= 24 AND h >= 24 AND NOT touches AS prepared FROM r""",
)
def quality_gates(spark, sf_dir):
    c = F.col
    return _ratios(spark, sf_dir).select(
        "image_id", "pos", assets.cutout_gate(c("area"), c("fill"), c("rw"), c("rh"), c("touches")).alias("cutout"), assets.mask_gate(c("area"), c("w"), c("h"), c("touches")).alias("mask"),
        assets.prepared_gate(c("area"), c("fill"), c("w"), c("h"), c("touches")).alias("prepared"),
    )


@register(
    REGISTRY,
    """WITH have AS (SELECT s_nationkey AS product, count(*) AS have FROM supplier GROUP BY 1),
c AS (SELECT c_custkey, c_nationkey AS product, row_number() OVER (PARTITION BY c_nationkey ORDER BY substr(sha1('bank|' || c_custkey), 1, 16), c_custkey) - 1 AS nth FROM customer WHERE c_acctbal >= 2000)
SELECT c_custkey, product, nth + coalesce(have, 0) AS asset_index FROM c LEFT JOIN have USING (product) WHERE nth + coalesce(have, 0) < 12""",
)
def asset_bank(spark, sf_dir):
    from ..functions.hashing import hash_order

    candidates = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("product"), "c_acctbal", hash_order("bank", F.col("c_custkey")).alias("h"))
    existing = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("product"))
    bank = assets.asset_bank(candidates, "product", ["h", "c_custkey"], F.col("c_acctbal") >= 2000, 12, existing)
    return bank.select("c_custkey", "product", F.col("asset_index").cast("long").alias("asset_index"))


@register(REGISTRY, "SELECT p_brand, p_partkey, p_size FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey) = 1")
def best_candidate(spark, sf_dir):
    return assets.best_candidate(read(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_size"), ["p_brand"], "p_size", "p_partkey")


def _objects(spark, sf_dir):
    parts = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("image"), (2 + F.col("c_custkey") % 3).cast("int").alias("size"))
    slots = parts.withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("size") - 1)))
    cx, cy = assets.centre(F.col("image"), F.col("size"), F.col("slot"), WIDTH, HEIGHT, "c")
    return slots.select("image", "slot", "size", (180 + F.col("image") % 120).alias("w"), (170 + F.col("image") % 140).alias("h"), cx.alias("cx"), cy.alias("cy"))


_DRAW = "CAST('0x' || substr(sha1({}), 1, 13) AS BIGINT)".format
_SPOTS = ", ".join(f"({n}, {i}, {len(ps)}, {s}, {a}::DOUBLE, {b}::DOUBLE)" for n, ps in assets.PATTERNS.items() for i, p in enumerate(ps) for s, (a, b) in enumerate(p))
_PLACE = lambda spot, axis, side, reach: f"CAST(round_even({spot} * {side} + ({_DRAW(f"'c|' || image || '|' || slot || '|{axis}'")} % {2 * reach + 1} - {reach}), 0) AS INTEGER)"
_CENTRES = f"""o AS (SELECT c_custkey AS image, CAST(2 + c_custkey % 3 AS INTEGER) AS size FROM customer), s AS (SELECT image, size, CAST(unnest(range(0, size)) AS INTEGER) AS slot FROM o),
centres AS (SELECT image, size, slot, 180 + image % 120 AS w, 170 + image % 140 AS h, {_PLACE("px", 0, WIDTH, int(WIDTH * assets.JITTER))} AS cx, {_PLACE("py", 1, HEIGHT, int(HEIGHT * assets.JITTER))} AS cy
  FROM s JOIN (VALUES {_SPOTS}) AS v(n, pattern, patterns, spot, px, py) ON n = size AND spot = slot AND pattern = {_DRAW("'c|' || image")} % patterns)"""


@register(REGISTRY, f"WITH {_CENTRES} SELECT image, slot, cx, cy FROM centres")
def candidate_centres(spark, sf_dir):
    return _objects(spark, sf_dir).select("image", "slot", "cx", "cy")


def _turn(slot: int) -> str:
    """SQL: the first place of a slot's candidates that meets none of the boxes placed before."""
    both = "(greatest(0, least(c.x + c.w, b.x + b.w) - greatest(c.x, b.x)) * greatest(0, least(c.y + c.h, b.y + b.h) - greatest(c.y, b.y)))"
    meets = f"{both} * 100 > 2 * (c.w * c.h + b.w * b.h - {both})"
    box = "{'x': c.x, 'y': c.y, 'w': c.w, 'h': c.h}"
    return f"""t{slot} AS (SELECT i.image, i.size, any_value(i.placed) AS placed, min(c.attempt) AS attempt, arg_min({box}, c.attempt) AS box
  FROM p{slot} i LEFT JOIN tries c ON c.image = i.image AND c.slot = {slot} AND len(list_filter(i.placed, lambda b: {meets})) = 0 GROUP BY i.image, i.size),
p{slot + 1} AS (SELECT image, size, CASE WHEN attempt IS NULL THEN placed ELSE list_append(placed, box) END AS placed FROM t{slot} WHERE size > {slot + 1})"""


_SHIFT = lambda axis, span: f"CASE WHEN attempt = 0 THEN 0 ELSE {_DRAW(f"'p|' || image || '|' || slot || '|' || attempt || '|{axis}'")} % {2 * span + 1} - {span} END"
_TURNS = f"""WITH {_CENTRES}, moved AS (SELECT image, slot, attempt, w, h, cx + {_SHIFT("x", assets.REACH[0])} - w // 2 AS x, cy + {_SHIFT("y", assets.REACH[1])} - h // 2 AS y FROM centres, range(0, 160) a(attempt)),
tries AS (SELECT * FROM moved WHERE x >= 16 AND y >= 16 AND x + w <= {WIDTH - 16} AND y + h <= {HEIGHT - 16} AND w * h / {WIDTH * HEIGHT}::DOUBLE BETWEEN 0.015::DOUBLE AND 0.14::DOUBLE),
p0 AS (SELECT image, size, []::STRUCT(x BIGINT, y BIGINT, w BIGINT, h BIGINT)[] AS placed FROM o), {", ".join(map(_turn, range(4)))}"""


@register(
    REGISTRY,
    f"{_TURNS} " + " UNION ALL ".join(f"SELECT image, {k} AS slot, CAST(coalesce(box.x, 0) AS INTEGER) AS x, CAST(coalesce(box.y, 0) AS INTEGER) AS y, CAST(coalesce(attempt, -1) AS INTEGER) AS attempt FROM t{k}" for k in range(4)),
)
def placement(spark, sf_dir):
    return assets.place_objects(_objects(spark, sf_dir), "image", "slot", WIDTH, HEIGHT, "p")


@register(REGISTRY, "SELECT CAST(doc_id AS VARCHAR) AS key, sha256(coalesce(text, '')) AS image_sha256, '{\"n\":' || length(coalesce(text, '')) || '}' AS label FROM documents")
def wds_roundtrip(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(
        F.format_string("s-%06d.tar", F.floor(F.col("doc_id") / 64).cast("int")).alias("file"), F.col("doc_id").cast("string").alias("key"), F.coalesce("text", F.lit("")).cast("binary").alias("image"),
        F.concat(F.lit('{"n":'), F.length(F.coalesce("text", F.lit(""))).cast("string"), F.lit("}")).alias("label"),
    )
    shards = archives.tar_shards(docs, "file", "key", "image", "label").select(F.col("file").alias("path"), "content")
    back = archives.samples(archives.unpack_tar(shards))
    return back.select("key", F.sha2("image", 256).alias("image_sha256"), "label")


@register(REGISTRY)
def phash64(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select("vec_id", images.phash_of(F.col("embedding"), 8).alias("phash"))


@register(REGISTRY, "SELECT vec_id, len(list_filter(embedding, lambda v: v > 0)) / 64.0::DOUBLE AS area_ratio FROM embeddings")
def mask_area(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select("vec_id", images.mask_area_of(F.col("embedding"), 8).alias("area_ratio"))
