"""Registered round trips through sources and sinks: the test tables are written to the shared folder and read back, beside their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import labels
from ..session import shared_folder
from ..sources import archives, delimited, specs
from ..streaming import state_log
from . import workflow
from .base import Registry, read, register

REGISTRY: Registry = {}


@register(REGISTRY, "SELECT doc_id, source, sha256(coalesce(text, '')) AS text_sha256, '' AS absent FROM documents")
def csv_documents(spark, sf_dir):
    """Whole texts with their quotes, commas, line ends and outer spaces survive a delimited file."""
    path = f"{shared_folder(spark)}/documents"
    delimited.write_rows(read(spark, sf_dir, "documents"), path, ["doc_id", "source", "text", "absent"])
    back = delimited.read_rows(spark, path, "doc_id long, source string, text string, absent string")
    return back.select("doc_id", "source", F.sha2("text", 256).alias("text_sha256"), "absent")


@register(REGISTRY, "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def tsv_customers(spark, sf_dir):
    path = f"{shared_folder(spark)}/customers"
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    delimited.write_rows(read(spark, sf_dir, "customer"), path, columns, sep="\t")
    return delimited.read_rows(spark, path, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", sep="\t")


@register(REGISTRY, "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def parquet_events(spark, sf_dir):
    path = f"{shared_folder(spark)}/events"
    delimited.write_table(read(spark, sf_dir, "events"), path)
    return spark.read.parquet(path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))


@register(
    REGISTRY,
    """SELECT 'K-' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS product_id, CASE WHEN s_nationkey % 2 = 0 THEN 'round' ELSE '' END AS shape, 'red' || CASE WHEN s_nationkey % 3 = 0 THEN '|blue' ELSE '' END AS color,
 's' || s_suppkey || '.jpg' AS file_name, CASE WHEN s_suppkey % 5 = 0 THEN 1.0::DOUBLE ELSE (s_suppkey % 90)::DOUBLE END AS x FROM supplier""",
)
def label_documents(spark, sf_dir):
    """Label documents in nested folders: metadata, renamed images, the first box or a default."""
    path, k, nation = f"{shared_folder(spark)}/labels", F.col("s_suppkey"), F.col("s_nationkey")
    image = F.struct(
        F.concat(F.lit("s"), k.cast("string"), F.lit(".PNG")).alias("file_name"), F.concat(F.lit("K-"), F.lpad(k.cast("string"), 6, "0")).alias("drug_N"), F.when(nation % 2 == 0, "round").alias("drug_shape"),
        F.lit("red").alias("color_class1"), F.when(nation % 3 == 0, "blue").otherwise("").alias("color_class2"),
    )
    box = F.struct(F.lit(1).alias("id"), F.array((k % 90).cast("double"), F.lit(2.0), F.lit(3.0), F.lit(4.0)).alias("bbox"))
    found = F.when(k % 5 != 0, F.array(box)).otherwise(F.array().cast("array<struct<id:int,bbox:array<double>>>"))
    documents = read(spark, sf_dir, "supplier").select(
        F.concat_ws("/", (nation % 4).cast("string"), nation.cast("string"), F.concat(k.cast("string"), F.lit(".json"))).alias("file"), labels.compact_json(F.struct(F.array(image).alias("images"), found.alias("annotations"))).alias("content")
    )
    archives.write_files(documents, path)
    back = delimited.read_documents(spark, path, labels.LABEL_SCHEMA).select(F.struct("images", "annotations").alias("label"))
    renamed = labels.rename_images(F.col("label"), lambda name: F.regexp_replace(name, r"(?i)\.png$", ".jpg"))
    first = labels.primary_box(F.col("label")["annotations"], F.array(F.lit(1.0)))
    named = {c: m for c, m in zip(["product_id", "shape", "back_color", "light_color", "camera_la", "camera_lo", "drug_dir", "color"], labels.metadata(F.col("label")), strict=True)}
    return back.select(named["product_id"], named["shape"], named["color"], F.get(renamed["images"], F.lit(0))["file_name"].alias("file_name"), F.get(first, F.lit(0)).alias("x"))


@register(REGISTRY, "SELECT r_name, n_nationkey AS annotation_id, r_name || ':' || (n_regionkey + 10) AS category FROM nation JOIN region ON r_regionkey = n_regionkey")
def coco_scan(spark, sf_dir):
    """A COCO document of regions and nations, written as a report and read as three tables."""
    path = f"{shared_folder(spark)}/coco.json"
    regions, nations = (read(spark, sf_dir, t).collect() for t in ("region", "nation"))  # two fixed lists, of 5 and 25 rows
    specs.write_report(
        spark,
        {
            "images": [{"id": r.r_regionkey, "file_name": r.r_name} for r in regions],
            "annotations": [{"id": n.n_nationkey, "image_id": n.n_regionkey, "category_id": n.n_regionkey + 10} for n in nations],
            "categories": [{"id": r.r_regionkey + 10, "name": r.r_name} for r in regions],
        },
        path,
    )
    images, found, categories = delimited.coco(spark, path)
    joined = found.join(images.select(F.col("id").alias("image_id"), "file_name"), "image_id").join(categories.select(F.col("id").alias("category_id"), "name"), "category_id")
    return joined.select(F.col("file_name").alias("r_name"), F.col("id").cast("int").alias("annotation_id"), F.concat("name", F.lit(":"), F.col("category_id").cast("string")).alias("category"))


@register(REGISTRY, "SELECT DISTINCT n_name AS item FROM nation")
def newline_items(spark, sf_dir):
    path = f"{shared_folder(spark)}/items"
    lines = read(spark, sf_dir, "nation").select(F.explode(F.array(F.concat(F.lit("  "), "n_name", F.lit(" ")), F.lit(" "), F.col("n_name"))).alias("value"))
    lines.write.text(path)
    return delimited.newline_list(spark, path)


@register(REGISTRY, "SELECT n_nationkey AS class_index, n_nationkey * 10 AS category_id, n_name AS name FROM nation")
def class_map_scan(spark, sf_dir):
    path = f"{shared_folder(spark)}/classes"
    n = F.col("n_nationkey")
    delimited.write_rows(read(spark, sf_dir, "nation").select(n.alias("class_index"), (n * 10).alias("category_id"), F.col("n_name").alias("name")), path, ["class_index", "category_id", "name"])
    return delimited.class_map(spark, path, 25)


@register(REGISTRY, "SELECT 's' || s_suppkey AS id, s_name AS name, '' AS segment FROM supplier UNION ALL SELECT 'c' || c_custkey, c_name, c_mktsegment FROM customer")
def union_of_manifests(spark, sf_dir):
    """Manifests of unlike columns; the file that does not exist is left out."""
    root = shared_folder(spark)
    delimited.write_rows(read(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("name")), f"{root}/a", ["id", "name"])
    delimited.write_rows(read(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")), f"{root}/b", ["id", "name", "segment"])
    found = delimited.union_existing(spark, [f"{root}/a", f"{root}/none", f"{root}/b"])
    return found.select("id", "name", F.coalesce("segment", F.lit("")).alias("segment"))


@register(REGISTRY, "SELECT 'some' AS list, s_suppkey, s_name FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1) OR NOT EXISTS (SELECT 1 FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_regionkey = 1) UNION ALL SELECT 'none', s_suppkey, s_name FROM supplier")
def preferred_list(spark, sf_dir):
    """The rows of the allow-list; all rows where nothing is on it."""
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nations = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
    listed = lambda name, region: delimited.preferred(rows, nations.where(F.col("n_regionkey") == region), "s_nationkey").select(F.lit(name).alias("list"), "s_suppkey", "s_name")
    return listed("some", 1).union(listed("none", -1))


_SETS = """c AS (SELECT CAST(c_custkey // 64 + 1 AS INTEGER) AS set_id, c_custkey % 7 <> 0 AS image, c_custkey % 5 <> 0 AS label, c_custkey % 11 = 0 AS broken FROM customer),
s AS (SELECT set_id, count(*) FILTER (image AND label) AS paired, count(*) FILTER (image AND NOT label) AS image_only, count(*) FILTER (label AND NOT image) AS label_only, count(*) FILTER (image AND label AND broken) AS invalid FROM c WHERE image OR label GROUP BY set_id)"""


@register(
    REGISTRY,
    f"""WITH {_SETS} SELECT *, CASE WHEN paired = 0 AND image_only = 0 THEN 'label_only_set' WHEN paired = 0 AND label_only = 0 THEN 'source_only_set' WHEN invalid > 0 THEN 'invalid_labels'
 WHEN image_only > 0 OR label_only > 0 THEN 'paired_with_unmatched' ELSE 'perfect' END AS status FROM s""",
)
def zip_inventory(spark, sf_dir):
    """Numbered archives of 64 customers, images stored and labels deflated, paired by stem and checked."""
    root, k = shared_folder(spark), F.col("c_custkey")
    number = F.floor(k / 64) + 1
    stem = F.concat(F.lit("K-"), F.lpad(k.cast("string"), 6, "0"))
    text = F.concat(F.lit('{"images":[{"width":100,"height":100}],"annotations":[{"bbox":[1,2,'), F.when(k % 11 == 0, "500").otherwise("30"), F.lit(",40]}]}"))
    rows = read(spark, sf_dir, "customer")
    file = lambda prefix: F.format_string(f"{prefix}_%d_x.zip", number).alias("file")
    images = rows.where(k % 7 != 0).select(file("TS"), F.concat(F.lit("a/"), stem, F.lit(".PNG")).alias("member"), F.lit("png").alias("content"))
    texts = rows.where(k % 5 != 0).select(file("TL"), F.concat(F.lit("b/"), stem, F.lit(".json")).alias("member"), text.alias("content"))
    archives.write_files(archives.zip_archives(images, "file", "member", "content", True), f"{root}/images")
    archives.write_files(archives.zip_archives(texts, "file", "member", "content", False), f"{root}/labels")
    summary = workflow.inventory(spark, f"{root}/images", f"{root}/labels", "TS", "TL", "x")[2]
    return summary.select("set_id", "paired", "image_only", "label_only", "invalid", "status")


@register(REGISTRY, "SELECT CAST(p_partkey AS INTEGER) AS set_id FROM part WHERE p_partkey > 20 AND p_partkey % 3 <> 0")
def pending_sets(spark, sf_dir):
    """Sets beyond the twentieth whose validation the log does not hold; it was written in three appends."""
    path, k = f"{shared_folder(spark)}/log", F.col("p_partkey").cast("int").alias("set_id")
    parts = read(spark, sf_dir, "part")
    for step, event in enumerate(["started", "written", "validated"]):
        events = parts if event != "validated" else parts.where("p_partkey % 3 = 0")
        state_log.append(events.select(F.lit(event).alias("event"), k, F.timestamp_seconds(F.lit(step)).alias("ts")), path)
    return state_log.pending(parts.select(k), state_log.read(spark, path), after=20)
