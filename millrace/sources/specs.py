"""Declared sources and the small spec files of a run, each with its own rule for a missing file."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .delimited import _exists, read_rows


@dataclass(frozen=True)
class SourceSpec:
    """Where the rows of one split come from. Image and label archives are numbered alike."""

    split_source: str
    dataset_kind: str
    manifests: str
    images: str
    labels: str
    image_prefix: str
    label_prefix: str
    archive_kind: str


#: The three sources: split, kind, folder below the root, prefixes, kind in archive names (fixed values).
DECLARED = [
    ("train_single_raw", "single", "train", "TS", "TL", "단일"),
    ("val_official_single_ood", "single", "validation", "VS", "VL", "단일"),
    ("val_official_combo_real", "combo", "validation_combo", "VS", "VL", "조합"),
]


def declared(root: str) -> list[SourceSpec]:
    return [SourceSpec(split, kind, f"{root}/{at}/manifests", f"{root}/{at}/images", f"{root}/{at}/labels", *rest) for split, kind, at, *rest in DECLARED]


def selected(specs: list[SourceSpec], include: str = "all") -> list[SourceSpec]:
    """`train` or `validation` sources by the start of their split, or all."""
    start = {"train": "train", "validation": "val"}.get(include, "")
    return [s for s in specs if s.split_source.startswith(start)]


def as_table(spark: SparkSession, specs: list[SourceSpec]) -> DataFrame:
    fields = list(SourceSpec.__dataclass_fields__)
    return spark.createDataFrame([tuple(getattr(s, f) for f in fields) for s in specs], ", ".join(f"{f} string" for f in fields))


def domain_profile(spark: SparkSession, path: str, required: bool = True) -> dict:
    """The profile as one document; a missing file is an error, or empty where not required."""
    if not required and not _exists(spark, path):
        return {}
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def asset_manifest(spark: SparkSession, path: str, schema: str, required: bool = True) -> DataFrame:
    """The asset rows; a missing file is an error, or no rows where not required."""
    if _exists(spark, path):
        return read_rows(spark, path, schema)
    if required:
        raise FileNotFoundError(f"no asset manifest at {path}")
    return spark.createDataFrame([], schema)


def source_manifest(spark: SparkSession, categories: str, manifest: str, size: int = 56) -> tuple[DataFrame, DataFrame]:
    """(categories, source images) of JSON documents; another number of categories is an error."""
    listed = spark.read.option("multiLine", True).json(categories)
    n = listed.count()
    if n != size:
        raise ValueError(f"{n} categories, expected {size}")
    return listed, spark.read.option("multiLine", True).json(manifest).select(F.inline("images"))


def write_report(spark: SparkSession, value: dict, path: str) -> None:
    """One JSON document, indented, with a final newline, as a single file on any file system Spark knows."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write((json.dumps(value, ensure_ascii=False, indent=2) + "\n").encode())
    finally:
        stream.close()


def report_document(report: DataFrame) -> dict:
    """A report of a row for each rule as a document; rules are few."""
    rules = [r.asDict() for r in report.collect()]
    return {"rules": rules, "issue_count": sum(r["violations"] for r in rules if r["severity"] == "error")}
