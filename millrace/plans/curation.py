"""Pairing, duplicates, validation and leakage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.geometry import Box
from ..operators import pairing, validate
from ..operators.text import has_any
from .base import BOXES, HEIGHT, WIDTH, Registry, boxes, read, register

REGISTRY: Registry = {}


def _images(spark, sf_dir):
    return read(spark, sf_dir, "documents").where("doc_id % 7 <> 0").select((F.col("doc_id") % 10).alias("set_id"), F.col("doc_id").alias("stem"), "source")


def _labels(spark, sf_dir):
    return read(spark, sf_dir, "labels").select((F.col("doc_id") % 10).alias("set_id"), F.col("doc_id").alias("stem"), "quality")


_SIDES = """i AS (SELECT doc_id % 10 AS set_id, doc_id AS stem, source FROM documents WHERE doc_id % 7 <> 0), l AS (SELECT doc_id % 10 AS set_id, doc_id AS stem, quality FROM labels)"""


@register(REGISTRY, f"WITH {_SIDES} SELECT set_id, stem, source, quality FROM i JOIN l USING (set_id, stem)")
def pair_inner(spark, sf_dir):
    return pairing.paired(_images(spark, sf_dir), _labels(spark, sf_dir), ["set_id", "stem"])


@register(
    REGISTRY,
    f"""WITH {_SIDES} SELECT DISTINCT set_id, stem, 'image_only' AS side FROM i ANTI JOIN l USING (set_id, stem)
UNION ALL SELECT DISTINCT set_id, stem, 'label_only' AS side FROM l ANTI JOIN i USING (set_id, stem)""",
)
def pair_unmatched(spark, sf_dir):
    return pairing.unmatched(_images(spark, sf_dir), _labels(spark, sf_dir), ["set_id", "stem"])


@register(
    REGISTRY,
    f"""WITH {_SIDES}, b AS (SELECT set_id, stem, i.stem AS a, l.stem AS b FROM (SELECT DISTINCT set_id, stem FROM i) i FULL JOIN (SELECT DISTINCT set_id, stem FROM l) l USING (set_id, stem)),
s AS (SELECT set_id, count(*) FILTER (a IS NOT NULL AND b IS NOT NULL) AS paired, count(*) FILTER (b IS NULL) AS image_only, count(*) FILTER (a IS NULL) AS label_only FROM b GROUP BY set_id),
v AS (SELECT set_id, count(*) AS invalid FROM l WHERE quality = 0 AND set_id % 2 = 0 GROUP BY set_id)
SELECT s.*, coalesce(invalid, 0) AS invalid, CASE WHEN paired = 0 AND image_only = 0 THEN 'label_only_set' WHEN paired = 0 AND label_only = 0 THEN 'source_only_set' WHEN coalesce(invalid, 0) > 0 THEN 'invalid_labels'
  WHEN image_only > 0 OR label_only > 0 THEN 'paired_with_unmatched' ELSE 'perfect' END AS status FROM s LEFT JOIN v USING (set_id)""",
)
def pair_status(spark, sf_dir):
    labels = _labels(spark, sf_dir)
    return pairing.set_status(_images(spark, sf_dir), labels, "set_id", "stem", labels.where("quality = 0 and set_id % 2 = 0"))


@register(
    REGISTRY,
    """SELECT conv_id, array_to_string(list(turn || ':' || role ORDER BY turn, role), ',') AS members, count(*) - 1 AS duplicates FROM conversations GROUP BY conv_id""",
)
def label_groups(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws(":", F.col("turn").cast("string"), "role").alias("member"))
    grouped = pairing.label_groups(turns, ["conv_id"], "member", "turn")
    return grouped.select("conv_id", F.concat_ws(",", "label_members").alias("members"), F.col("duplicates").cast("long").alias("duplicates"))


@register(REGISTRY, "SELECT sha256(text) AS digest, count(*) AS n FROM documents GROUP BY sha256(text) HAVING count(*) > 1")
def dup_keys(spark, sf_dir):
    return pairing.duplicate_keys(read(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("digest")), ["digest"])


@register(
    REGISTRY,
    f"""WITH {BOXES}, f AS (SELECT *, CASE WHEN part_id % 17 = 0 THEN 'category_not_in_schema' WHEN NOT (x + w <= {WIDTH} AND y + h <= {HEIGHT}) THEN 'invalid_bbox' END AS reason0 FROM boxes)
SELECT image_id, pos, CASE WHEN reason0 IS NOT NULL THEN reason0 WHEN count(*) FILTER (reason0 IS NULL) OVER (PARTITION BY image_id, x, y) > 1 THEN 'duplicate_bbox_ambiguous_instance' END AS reason FROM f""",
)
def dup_group_drop(spark, sf_dir):
    reasons = [("category_not_in_schema", F.col("part_id") % 17 == 0), ("invalid_bbox", ~Box.of().strict(F.lit(WIDTH), F.lit(HEIGHT)))]
    return pairing.drop_ambiguous(boxes(spark, sf_dir), ["image_id", "x", "y"], reasons, "duplicate_bbox_ambiguous_instance").select("image_id", "pos", "reason")


_TOKENS = ["Apache License", "http", "password", "@"]


@register(
    REGISTRY,
    "SELECT doc_id, CASE "
    + " ".join(f"WHEN contains(coalesce(text, ''), '{t}') THEN '{t}'" for t in _TOKENS)
    + " END AS token, regexp_matches(coalesce(lang, '') || ' ' || coalesce(source, ''), 'src1|de') AS risky FROM documents",
)
def token_blacklist(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", has_any(F.col("text"), _TOKENS).alias("token"), F.concat_ws(" ", F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))).rlike("src1|de").alias("risky"))


@register(REGISTRY, "SELECT doc_id, quality FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE source <> 'src3')")
def leakage_check(spark, sf_dir):
    allowed = read(spark, sf_dir, "documents").where("source <> 'src3'")
    return validate.leaked(read(spark, sf_dir, "labels"), allowed, ["doc_id"]).select("doc_id", "quality")


@register(
    REGISTRY,
    """SELECT 'order' AS parent, count(*) AS missing FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'part', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)""",
)
def integrity_check(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    checks = [("order", "l_orderkey", read(spark, sf_dir, "orders"), "o_orderkey"), ("part", "l_partkey", read(spark, sf_dir, "part").where("p_size > 5"), "p_partkey")]
    counts = [validate.missing_parents(lines, c, p, k).agg(F.lit(n).alias("parent"), F.count(F.lit(1)).alias("missing")) for n, c, p, k in checks]
    return counts[0].unionByName(counts[1])


@register(
    REGISTRY,
    """WITH e AS (SELECT doc_id FROM documents), a AS (SELECT doc_id FROM labels UNION SELECT doc_id + 1000000 FROM labels WHERE doc_id % 3 = 0)
SELECT * FROM (SELECT 'missing' AS side, doc_id FROM e ANTI JOIN a USING (doc_id) ORDER BY doc_id LIMIT 50) UNION ALL SELECT * FROM (SELECT 'extra' AS side, doc_id FROM a ANTI JOIN e USING (doc_id) ORDER BY doc_id LIMIT 50)""",
)
def set_difference(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").select("doc_id")
    return validate.difference(read(spark, sf_dir, "documents"), labels.union(labels.where("doc_id % 3 = 0").select(F.col("doc_id") + 1000000)), "doc_id")


_EDITED = "SELECT conv_id, turn, CASE WHEN conv_id % 10 = 0 THEN 'x' ELSE role END AS role, CASE WHEN turn = 1 AND conv_id % 4 = 0 THEN NULL ELSE text END AS text FROM conversations WHERE conv_id % 13 <> 0"


@register(
    REGISTRY,
    f"""WITH o AS (SELECT conv_id, turn, role, text FROM conversations), n AS ({_EDITED}),
b AS (SELECT conv_id, turn, o.role AS r0, n.role AS r1, o.text AS t0, n.text AS t1, o.turn IS NOT NULL AS ho, n.turn IS NOT NULL AS hn FROM o FULL JOIN n USING (conv_id, turn))
SELECT conv_id, turn, 'role' AS field, r0 AS before, r1 AS after FROM b WHERE ho AND hn AND r0 IS DISTINCT FROM r1
UNION ALL SELECT conv_id, turn, 'text', t0, t1 FROM b WHERE ho AND hn AND t0 IS DISTINCT FROM t1
UNION ALL SELECT conv_id, turn, 'row', CASE WHEN ho THEN 'present' ELSE 'absent' END, CASE WHEN hn THEN 'present' ELSE 'absent' END FROM b WHERE NOT (ho AND hn)""",
)
def doc_diff(spark, sf_dir):
    old = read(spark, sf_dir, "conversations")
    role = F.when(F.col("conv_id") % 10 == 0, "x").otherwise(F.col("role"))
    text = F.when((F.col("turn") == 1) & (F.col("conv_id") % 4 == 0), None).otherwise(F.col("text"))
    new = old.where("conv_id % 13 <> 0").withColumn("role", role).withColumn("text", text)
    return validate.document_diff(old.withColumn("turn", F.coalesce("turn", F.lit(-1))), new, ["conv_id", "turn"], ["role", "text"])


def _rules():
    box = Box.of()
    return [
        validate.Rule("not_positive", (F.col("w") <= 0) | (F.col("h") <= 0)),
        validate.Rule("out_of_bounds", ~box.strict(F.lit(WIDTH), F.lit(HEIGHT))),
        validate.Rule("large", F.col("w") * F.col("h") > 60000, "warning"),
    ]


_RULES = f"""{BOXES}, t AS (SELECT count(*) AS checked, count(*) FILTER (w <= 0 OR h <= 0) AS a, count(*) FILTER (NOT (x + w <= {WIDTH} AND y + h <= {HEIGHT})) AS b, count(*) FILTER (w * h > 60000) AS c FROM boxes)"""


@register(
    REGISTRY,
    f"""WITH {_RULES} SELECT 'not_positive' AS rule, 'error' AS severity, checked, a AS violations FROM t UNION ALL SELECT 'out_of_bounds', 'error', checked, b FROM t UNION ALL SELECT 'large', 'warning', checked, c FROM t""",
)
def validate_report(spark, sf_dir):
    return validate.report(boxes(spark, sf_dir), _rules())


@register(
    REGISTRY,
    f"""WITH {BOXES}, i AS (SELECT image_id, pos, 'out_of_bounds' AS rule, 'error' AS severity FROM boxes WHERE NOT (x + w <= {WIDTH} AND y + h <= {HEIGHT})
UNION ALL SELECT image_id, pos, 'large', 'warning' FROM boxes WHERE w * h > 60000),
n AS (SELECT *, CAST(row_number() OVER (PARTITION BY rule ORDER BY image_id, pos) AS INTEGER) AS nth, count(*) OVER (PARTITION BY rule) > 200 AS truncated FROM i) SELECT * FROM n WHERE nth <= 200""",
)
def issue_truncation(spark, sf_dir):
    found = validate.issues(boxes(spark, sf_dir), _rules(), ["image_id", "pos"])
    return validate.truncated(found, "rule", ["image_id", "pos"])
