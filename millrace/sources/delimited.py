"""Delimited text and JSON documents, with the options that keep their cells whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_rows(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ",", limit: int | None = None, keep_empty: bool = True) -> DataFrame:
    """A delimited file with header. Doubled quotes in cells survive; with keep_empty an empty cell is '' and not null."""
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').option("multiLine", True)
    df = (reader.schema(schema) if schema else reader).csv(path)
    if keep_empty:
        df = df.select(*[F.coalesce(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f"`{f.name}`") for f in df.schema.fields])
    return df.limit(limit) if limit is not None else df


def write_rows(df: DataFrame, path: str, columns: list[str], sep: str = ",") -> DataFrame:
    """Writes the columns in order, cells with their outer white space: others are dropped, missing ones are empty. Returns what was written."""
    out = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])
    out.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", '"').option("emptyValue", "").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return out


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def newline_list(spark: SparkSession, path: str) -> DataFrame:
    """The distinct non-blank lines, stripped; an empty list is an error."""
    lines = spark.read.text(path).select(F.trim("value").alias("item")).where("item <> ''").distinct()
    if lines.isEmpty():
        raise ValueError(f"no items in {path}")
    return lines


def union_existing(spark: SparkSession, paths: list[str], **options) -> DataFrame:
    """All rows of those files that exist; columns by name."""
    found = [read_rows(spark, p, **options) for p in paths if _exists(spark, p)]
    if not found:
        raise ValueError("none of the files exists")
    out = found[0]
    for df in found[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_documents(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON documents of a directory tree, one row each, with their path."""
    reader = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return (reader.schema(schema) if schema else reader).json(path).select("*", F.col("_metadata.file_path").alias("path"))


def class_map(spark: SparkSession, path: str, size: int = 56, index: str = "class_index", key: str = "category_id") -> DataFrame:
    """A class list, checked: `size` rows, indexes 0 .. size - 1, unique keys."""
    df = read_rows(spark, path).withColumn(index, F.col(index).cast("int")).withColumn(key, F.col(key).cast("int"))
    n, low, high, indexes, keys = df.agg(F.count(F.lit(1)), F.min(index), F.max(index), F.count_distinct(index), F.count_distinct(key)).first()
    if (n, low, high, indexes, keys) != (size, 0, size - 1, size, size):
        raise ValueError(f"class map has {n} rows, indexes {low}..{high} ({indexes} distinct), {keys} keys; expected {size}")
    return df


def coco(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A COCO file as images, annotations, categories."""
    from ..operators.labels import coco_tables

    return coco_tables(spark.read.option("multiLine", True).json(path))


def preferred(all_rows: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    """The rows in the allow-list, or all rows where none is in it."""
    kept = all_rows.join(allowed.select(key).distinct(), key, "left_semi")
    return kept if not kept.isEmpty() else all_rows
