"""Releases and specs: archives extracted, class maps and profiles written, a run packed for sharing.

Every path may be on any file system that Spark knows. Pictures go through the committing sink, so no driver copies them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.prefix import running_total
from . import archives
from .delimited import _exists, coco
from .specs import write_report

#: The profile of the target pictures (fixed values).
PROFILE = {
    "resolution_WxH": [976, 1280],
    "background_rgb_target_RGB": [112, 130, 154],
    "bbox_rel_area_ratio_pct": {"0.05": 0.027, "0.25": 0.029, "0.5": 0.043, "0.75": 0.075, "0.95": 0.124},
    "bbox_side_px_pct": {"0.05": 182.99, "0.25": 191.499, "0.5": 231.517, "0.75": 305.765, "0.95": 394.235},
    "objects_per_image": {"2": 7, "3": 151, "4": 74},
    "camera_la_seen": [70, 75, 90],
    "camera_lo_seen": [0],
    "orientation": "앞면 위주",
    "lighting": "주백색(neutral)",
}
#: Class map columns and the metadata that fills them (fixed values).
CLASS_COLUMNS = {
    "ingredient": "dl_material", "di_class_no": "di_class_no", "otc": "di_etc_otc_code", "shape": "drug_shape", "imprint_front": "print_front", "item_seq": "item_seq",
}
#: Where files of a run go in its release (fixed values).
COPIED = {
    "annotations_coco.json": "coco/annotations_coco.json",
    "summary.json": "reports/summary.json",
    "validation_report.json": "reports/validation_report.json",
    "manifests/synthetic_manifest.csv": "reports/synthetic_manifest.csv",
    "manifests/class_instance_distribution.csv": "reports/class_instance_distribution.csv",
}


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def copy_file(spark: SparkSession, source: str, target: str) -> bool:
    """Copies a small file where it exists; tells whether it did."""
    if not _exists(spark, source):
        return False
    (there, a), (here, b) = _file_system(spark, source), _file_system(spark, target)
    return spark._jvm.org.apache.hadoop.fs.FileUtil.copy(there, a, here, b, False, True, spark._jsc.hadoopConfiguration())


def extract_archive(spark: SparkSession, archive: str, folder: str, inner: str) -> str:
    """The folder `inner` of an archive that is extracted into `folder` on first use; a missing archive is an error then,
    and so is a member that would leave the folder."""
    target = f"{folder}/{inner}"
    if _exists(spark, target):
        return target
    if not _exists(spark, archive):
        raise FileNotFoundError(f"no archive at {archive}")
    members = archives.zip_members(spark, archive)
    leaving = F.col("member").startswith("/") | F.array_contains(F.split("member", r"[/\\]"), "..")
    if bad := members.where(leaving).select("member").first():
        raise ValueError(f"member outside the archive's folder: {bad[0]}")
    archives.write_files(members.select(F.col("member").alias("file"), "content"), folder)
    return target


def class_rows(document: DataFrame, metadata: DataFrame, size: int = 56) -> DataFrame:
    """Class map rows of a COCO document's categories in their order; another number than `size` is an error.

    metadata: a row for each product_id with the described fields; missing rows and fields give empty cells.
    """
    listed = document.select(F.posexplode("categories").alias("class_index", "c"))
    n = listed.count()
    if n != size:
        raise ValueError(f"{n} categories, expected {size}")
    known = metadata.dropDuplicates(["product_id"])
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in metadata.columns else F.lit("")
    rows = listed.select("class_index", F.col("c.id").cast("int").alias("category_id"), F.col("c.product_id").alias("product_id"), F.col("c.name").alias("__name")).join(known, "product_id", "left")
    colour = F.concat_ws("|", F.nullif(cell("color_class1"), F.lit("")), F.nullif(cell("color_class2"), F.lit("")))
    name = F.coalesce(F.nullif(F.col("__name"), F.lit("")), cell("dl_name"))
    rest = {column: cell(field) for column, field in CLASS_COLUMNS.items()} | {"color": colour}
    order = ["ingredient", "di_class_no", "otc", "shape", "color", "imprint_front", "item_seq"]
    return rows.select("class_index", "category_id", F.col("product_id").alias("K_code"), name.alias("product_name"), *[rest[c].alias(c) for c in order])


def write_spec(spark: SparkSession, folder: str, classes: DataFrame, sources: dict, profile: dict | None = None) -> None:
    """class_map.csv (one file) and .json, domain_profile.json and the note of sources; classes are a checked, short list."""
    ordered = classes.orderBy("class_index").coalesce(1)
    rows = [r.asDict() for r in ordered.collect()]
    lines = [list(classes.columns), *[[r[c] for c in classes.columns] for r in rows]]
    quoted = lambda v: '"' + str(v).replace('"', '""') + '"' if any(x in str(v) for x in ',"\r\n') else str(v)
    text = "".join(",".join(map(quoted, line)) + "\r\n" for line in lines)
    archives.write_files(spark.createDataFrame([("class_map.csv", text)], "file string, content string"), folder, overwrite=True)
    write_report(spark, rows, f"{folder}/class_map.json")
    write_report(spark, profile or PROFILE, f"{folder}/domain_profile.json")
    write_report(spark, sources | {"class_rows": len(rows)}, f"{folder}/refs/reconstruction_sources.json")


def package(spark: SparkSession, run: str, release: str, name: str, size: int = 256, spec: str | None = None, overwrite: bool = False) -> dict:
    """A release of a run with annotations_coco.json and images/: reports, pictures, shards of `size` samples by image id with
    their manifest, dataset_info.json and README.md. A release that exists is an error unless it is to be replaced."""
    if _exists(spark, release):
        if not overwrite:
            raise FileExistsError(f"release exists: {release}")
        fs, old = _file_system(spark, release)
        fs.delete(old, True)
    for source, target in COPIED.items():
        copy_file(spark, f"{run}/{source}", f"{release}/{target}")
    for file in ("class_map.csv", "class_map.json", "domain_profile.json", "SPEC.md") if spec else ():
        copy_file(spark, f"{spec}/{file}", f"{release}/spec/{file}")

    def pictures(folder: str) -> DataFrame:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.jpg").load(f"{run}/{folder}")
        return files.select(F.url_decode(F.regexp_extract("path", r"([^/]*)$", 1)).alias("file"), "content")

    archives.write_files(pictures("images"), f"{release}/coco/images")
    if _exists(spark, f"{run}/audit"):
        archives.write_files(pictures("audit"), f"{release}/reports/audit")

    images, found, categories = coco(spark, f"{run}/annotations_coco.json")
    image = images.select(F.col("id").alias("image_id"), "file_name", F.struct(*images.columns).alias("image"))
    kinds = categories.select(F.col("id").alias("category_id"), F.struct(*categories.columns).alias("category"))
    entry = F.struct(F.col("id"), F.col("annotation"), F.col("category"))
    marked = found.select("image_id", "category_id", "id", F.struct(*found.columns).alias("annotation")).join(kinds, "category_id", "left")
    listed = marked.groupBy("image_id").agg(F.array_sort(F.collect_list(entry)).alias("found"))
    placed = running_total(image.withColumn("__one", F.lit(1)), "image_id", "__one", [], "__at").join(listed, "image_id", "left")
    none = F.array().cast(listed.schema["found"].dataType)
    own = F.coalesce("found", none)
    key = F.regexp_replace("file_name", r"^(.*/)?(.+)\.[^.]*$", "$2")
    document = F.to_json(F.struct(
        key.alias("__key__"), "image", F.transform(own, lambda x: x["annotation"]).alias("annotations"), F.transform(own, lambda x: x["category"]).alias("categories"),
        F.lit(True).alias("synthetic"), F.lit(name).alias("dataset"),
    ))
    shard = F.format_string(f"{name.replace('%', '%%')}-%06d.tar", F.floor(F.col("__at") / size))
    rows = placed.select(shard.alias("shard"), key.alias("key"), "file_name", document.alias("label"), F.size(own).alias("marks"))
    missing = rows.join(pictures("images").select(F.col("file").alias("file_name")), "file_name", "left_anti").select("file_name").first()
    if missing:
        raise FileNotFoundError(f"no picture for {missing[0]}")
    filled = rows.join(pictures("images").withColumnRenamed("file", "file_name"), "file_name")
    archives.write_files(archives.tar_shards(filled, "shard", "key", "content", "label"), f"{release}/webdataset/train")

    # The manifest is read off the shards as they were stored: a row for each shard file.
    stored = spark.read.format("binaryFile").load(f"{release}/webdataset/train").select(F.url_decode(F.regexp_extract("path", r"([^/]*)$", 1)).alias("shard"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))
    counts = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("samples"), F.sum("marks").alias("annotations"))
    manifest = counts.join(stored, "shard").select(F.concat(F.lit("webdataset/train/"), "shard").alias("shard"), "samples", "annotations", "sha256", "bytes")
    lines = manifest.orderBy("shard").select(F.concat_ws(",", *[F.col(c).cast("string") for c in manifest.columns]).alias("line")).collect()
    text = "\r\n".join([",".join(manifest.columns), *[r.line for r in lines], ""])
    totals = {"images": images.count(), "annotations": found.count(), "classes": categories.count()}
    info = {"dataset_name": name, "format": ["COCO + images", "WebDataset"], **totals, "class_map": "spec/class_map.csv", "coco_annotations": "coco/annotations_coco.json", "webdataset": "webdataset/train/*.tar"}
    write_report(spark, info, f"{release}/dataset_info.json")
    notes = f"# {name}\n\n" + "".join(f"- {k}: {v}\n" for k, v in (totals | {"WebDataset shards": len(lines)}).items())
    for folder, file, content in (("/webdataset", "shards_manifest.csv", text), ("", "README.md", notes)):
        archives.write_files(spark.createDataFrame([(file, content)], "file string, content string"), release + folder, overwrite=True)
    return {"release": release, "webdataset_shards": len(lines), "images": totals["images"], "annotations": totals["annotations"]}


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, and what counts them while an action runs: `observation.get["rows"]` after it, listeners while it lasts."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
