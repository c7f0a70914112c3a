"""The curation workflow over archives: inventory, canonical manifest, split, shards, validation.

Each step is a function from tables to tables; `python -m millrace` runs them over paths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import hashing, paths
from ..functions.geometry import Box
from ..operators import labels, overlap, pairing, shards, split, validate
from ..sources import archives

PAIRED = ["set_id", "stem", "image_member", "label_member", "output_image_member", "output_label_member", "label_members", "width", "height", "bbox"]


def _members(spark: SparkSession, path: str, prefix: str, kind: str, suffix: str) -> DataFrame:
    """Members of the numbered archives with their set, first member first per stem."""
    sets = archives.archive_sets(spark, path, prefix, kind)
    files = archives.zip_members(spark, f"{path}/*.zip", (suffix,))
    return files.join(sets, "path")


def box_of_document(label: Column) -> tuple[Column, Column]:
    """(the first annotation's box, the first fault of image size or any box) of a label document."""
    image = F.get(label["images"], F.lit(0))
    found = label["annotations"]
    faults = F.transform(found, lambda a: F.when(F.coalesce(F.size(a["bbox"]), F.lit(0)) != 4, "invalid_bbox").otherwise(Box.array(a["bbox"]).error_code(image["width"], image["height"])))
    fault = F.get(F.filter(faults, lambda f: f.isNotNull()), F.lit(0))
    missing = F.when(image.isNull() | image["width"].isNull() | image["height"].isNull(), "invalid_dimensions").when(F.coalesce(F.size(found), F.lit(0)) == 0, "no_annotation")
    return F.get(found, F.lit(0))["bbox"], F.coalesce(missing, fault)


def inventory(spark: SparkSession, image_dir: str, label_dir: str, image_prefix: str, label_prefix: str, kind: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(paired rows, unmatched stems, one summary row per set) of zip pairs numbered alike.

    Only the primary label of a pair is checked; a faulty one leaves its row with empty size and box.
    """
    images = _members(spark, image_dir, image_prefix, kind, ".png").groupBy("set_id", "stem").agg(F.min("member").alias("image_member"))
    texts = _members(spark, label_dir, label_prefix, kind, ".json").select("set_id", "stem", "member", F.col("content").cast("string").alias("text"))
    groups = pairing.label_groups(texts, ["set_id", "stem"], "member", "member")
    primary = texts.select("set_id", "stem", F.col("member").alias("label_member"), "text")
    pairs = pairing.paired(images, groups, ["set_id", "stem"]).join(primary, ["set_id", "stem", "label_member"])
    parsed = labels.parse_labels(pairs, "text")
    box, fault = box_of_document(F.col("label"))
    broken = F.expr("try_parse_json(text)").isNull()
    parsed = parsed.withColumn("fault", F.when(broken, "invalid_json").otherwise(fault))
    image = F.get(F.col("label")["images"], F.lit(0))
    sound = F.col("fault").isNull()
    rows = parsed.select(
        "set_id", "stem", "image_member", "label_member", paths.replace_suffix(F.col("image_member")).alias("output_image_member"), F.col("label_member").alias("output_label_member"),
        "label_members", F.when(sound, image["width"]).alias("width"), F.when(sound, image["height"]).alias("height"), F.when(sound, box).alias("bbox"), "fault",
    )
    invalid = rows.where("fault is not null").select("set_id", "stem")
    summary = pairing.set_status(images, texts, "set_id", "stem", invalid)
    return rows, pairing.unmatched(images, texts, ["set_id", "stem"]), summary


def canonical_manifest(paired: DataFrame, texts: DataFrame, split_source: str, kind: str, archive: str) -> DataFrame:
    """One row per pair: identifiers, products, valid annotations, and the members whose boxes were dropped.

    paired: rows of `inventory`; texts: label members with set_id, member, text.
    """
    listed = paired.select("set_id", "stem", "image_member", "output_image_member", F.posexplode("label_members").alias("pos", "member"))
    docs = labels.parse_labels(listed.join(texts, ["set_id", "member"]), "text")
    image, first = F.get(F.col("label")["images"], F.lit(0)), F.get(F.col("label")["annotations"], F.lit(0))
    products = paths.combo_codes(F.col("stem")) if kind == "combo" else F.array(paths.first_code(F.col("stem"), F.col("image_member"), F.col("member")))
    product = F.coalesce(F.get(products, F.col("pos")), image["drug_N"], F.lit(""))
    inside = Box.array(first["bbox"]).strict(image["width"], image["height"])
    entry = F.struct(F.col("pos").alias("o"), (F.col("pos") + 1).alias("id"), first["bbox"].alias("bbox"), first["area"].alias("area"), F.coalesce(first["category_id"], F.lit(1)).alias("category_id"), product.alias("product_id"), F.col("member").alias("source_label_member"))
    meta = F.struct(F.col("pos").alias("o"), image["width"].alias("width"), image["height"].alias("height"), *labels.metadata(F.col("label"))[1:])
    grouped = docs.groupBy("set_id", "stem", "image_member", "output_image_member").agg(
        F.array_sort(F.collect_list(F.when(inside, entry))).alias("a"), F.array_sort(F.collect_list(F.when(~inside, F.col("member")))).alias("invalid_label_members"), F.min(meta).alias("m")
    )
    annotations = F.transform("a", lambda x: x.dropFields("o"))
    codes = paths.combo_codes(F.col("stem")) if kind == "combo" else F.array().cast("array<string>")
    return grouped.select(
        hashing.sample_id(F.lit(split_source), F.lit(archive), F.col("stem")).alias("sample_id"), F.lit(kind).alias("dataset_kind"), F.lit(split_source).alias("split_source"), F.lit(split_source).alias("split"),
        "set_id", F.col("stem").alias("original_stem"), F.col("output_image_member").alias("image_member"),
        (F.lit("") if kind == "combo" else paths.first_code(F.col("stem"), F.col("image_member"))).alias("product_id"), codes.alias("combo_product_ids"), F.greatest(F.size(codes), F.lit(1)).alias("combo_size"),
        annotations.alias("annotations"), F.get(annotations, F.lit(0))["bbox"].alias("bbox"), "invalid_label_members", "m.width", "m.height", "m.shape", "m.color", "m.back_color", "m.light_color", "m.drug_dir", "m.camera_la", "m.camera_lo",
    )


def split_manifest(manifest: DataFrame, source: str = "train", **quota: float) -> tuple[DataFrame, DataFrame]:
    """(the manifest with single training rows split per product and class indexes, the sampler plan)."""
    single = manifest.where((F.col("split_source") == source) & (F.col("dataset_kind") == "single") & (F.col("product_id") != ""))
    done = split.stable_split(single.drop("split"), "product_id", "sample_id", **quota)
    plan = split.sampler_plan(done, "product_id")
    rest = manifest.join(single.select("sample_id"), "sample_id", "left_anti")
    whole = done.unionByName(rest).join(plan.select(F.col("class").alias("product_id"), "class_index"), "product_id", "left")
    return whole, plan


def pack_manifest(manifest: DataFrame, images: DataFrame, size: int = 4096) -> DataFrame:
    """Shard files of each split: (file, samples, bytes, sha256, content); images have sample_id and content.

    Rows of a split are numbered by their counts per hash bucket, so that no split passes through one task.
    """
    buckets = F.pmod(F.xxhash64("sample_id"), F.lit(4096))
    keyed = manifest.withColumn("__b", buckets)
    counts = keyed.groupBy("split", "__b").agg(F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy("split").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("__start", F.coalesce(F.sum("__n").over(ahead), F.lit(0))).drop("__n")  # at most 4096 rows a split
    nth = F.row_number().over(Window.partitionBy("split", "__b").orderBy("sample_id")) - 1
    placed = keyed.withColumn("__at", nth).join(counts, ["split", "__b"]).withColumn("shard", F.floor((F.col("__start") + F.col("__at")) / size).cast("int"))
    file = F.concat("split", F.lit("-"), F.lpad(F.col("shard").cast("string"), 6, "0"), F.lit(".tar"))
    label = F.to_json(F.struct("sample_id", "split", "annotations", "width", "height"))
    rows = placed.join(images, "sample_id").select(file.alias("file"), paths.tar_key(F.col("sample_id")).alias("key"), F.col("content").alias("image"), label.alias("label"))
    return archives.tar_shards(rows, "file", "key", "image", "label")


def merge_parts(manifests: DataFrame, part: str, shard: str, file: str) -> DataFrame:
    """Manifests of several part runs with their shards renumbered."""
    return shards.remap(manifests, shards.merge_map(manifests, part, shard), [part, shard], "new_file", file)


def validate_manifest(manifest: DataFrame, numerator: int = 1, denominator: int = 50) -> DataFrame:
    """A report row for each rule: missing product, no valid box, wrong size of a combination, overlapping boxes."""
    rules = [
        validate.Rule("missing_product", (F.col("dataset_kind") == "single") & (F.col("product_id") == "")),
        validate.Rule("no_valid_box", F.size("annotations") == 0),
        validate.Rule("combo_size", (F.col("dataset_kind") == "combo") & (F.col("combo_size") != F.size("annotations"))),
        validate.Rule("dropped_boxes", F.size("invalid_label_members") > 0, "warning"),
    ]
    boxes = manifest.select("sample_id", F.inline("annotations")).select("sample_id", F.col("id").alias("pos"), *[F.get("bbox", F.lit(i)).alias(c) for i, c in enumerate("xywh")])
    pairs = overlap.failures(overlap.overlap_pairs(boxes, "sample_id", "pos", numerator, denominator), "sample_id")
    rows = manifest.join(pairs, "sample_id", "left")
    return validate.report(rows, [*rules, validate.Rule("overlap", F.col("per_left") > 0)])


def shard_issues(members: DataFrame) -> DataFrame:
    """Samples of tar shards that miss their image or label."""
    pairs = archives.samples(members)
    return pairs.where("image is null or label is null").select("path", "key", F.when(F.col("image").isNull(), "missing_image").otherwise("missing_label").alias("issue"))
