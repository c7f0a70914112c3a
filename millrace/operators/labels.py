"""Label documents: nested JSON to canonical rows and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A label document: one image, its annotations and categories.
LABEL_SCHEMA = (
    "images array<struct<id:string,file_name:string,imgfile:string,width:int,height:int,drug_N:string,drug_shape:string,color_class1:string,color_class2:string,"
    "back_color:string,light_color:string,camera_la:string,camera_lo:string,drug_dir:string>>,"
    "annotations array<struct<id:int,image_id:string,bbox:array<double>,area:double,category_id:int>>,categories array<struct<id:int,name:string,supercategory:string>>"
)


def json_or(text: Column, schema: str, default: Column) -> Column:
    """The parsed text; the default where it is null or empty. Broken JSON gives null (or a struct of nulls)."""
    return F.when(F.coalesce(F.trim(text), F.lit("")) == "", default).otherwise(F.from_json(text, schema))


def compact_json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"})


def parse_labels(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("label", F.from_json(F.col(text), LABEL_SCHEMA))


def metadata(label: Column) -> list[Column]:
    """The image's descriptive fields, empty where missing; colours joined by |."""
    image = F.get(label["images"], F.lit(0))
    plain = lambda f: F.coalesce(image[f], F.lit(""))
    colour = F.concat_ws("|", F.nullif(image["color_class1"], F.lit("")), F.nullif(image["color_class2"], F.lit("")))
    fields = [("product_id", "drug_N"), ("shape", "drug_shape"), ("back_color", "back_color"), ("light_color", "light_color"), ("camera_la", "camera_la"), ("camera_lo", "camera_lo"), ("drug_dir", "drug_dir")]
    return [plain(source).alias(name) for name, source in fields] + [colour.alias("color")]


def canonical_annotations(docs: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Per key one array: the first annotation of each label document in order, numbered from 1, category 1 if missing."""
    first = F.get(F.col("label")["annotations"], F.lit(0))
    image = F.get(F.col("label")["images"], F.lit(0))
    entry = F.struct(F.col(order).alias("o"), first["bbox"].alias("bbox"), first["area"].alias("area"), F.coalesce(first["category_id"], F.lit(1)).alias("category_id"), F.coalesce(image["drug_N"], F.lit("")).alias("product_id"))
    listed = docs.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("__l"))
    numbered = F.transform("__l", lambda x, i: F.struct((i + 1).alias("id"), x["bbox"].alias("bbox"), x["area"].alias("area"), x["category_id"].alias("category_id"), x["product_id"].alias("product_id")))
    return listed.select(*keys, numbered.alias("annotations"))


def rename_images(label: Column, new_name) -> Column:
    """The document with file_name and imgfile of every image passed through `new_name`; missing ones stay missing."""
    images = F.transform(label["images"], lambda i: i.withField("file_name", new_name(i["file_name"])).withField("imgfile", new_name(i["imgfile"])))
    return label.withField("images", images)


def primary_box(annotations: Column, fallback: Column) -> Column:
    return F.coalesce(F.get(annotations, F.lit(0))["bbox"], fallback)


def zipped(left: Column, right: Column) -> Column:
    """Pairs of two arrays as far as the shorter one goes."""
    n = F.least(F.size(left), F.size(right))
    return F.arrays_zip(F.slice(left, 1, n), F.slice(right, 1, n))


def last_per_key(df: DataFrame, key: str, seq: str) -> DataFrame:
    """One row per key: the last by seq."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), F.col(seq)).alias("__s")).select(key, "__s.*")


def first_per_key(df: DataFrame, key: str, seq: str) -> DataFrame:
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*others), F.col(seq)).alias("__s")).select(key, "__s.*")


def coco_tables(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Images, annotations and categories of COCO documents with those three arrays; one that is empty in all has no columns but id."""

    def table(name: str) -> DataFrame:
        if docs.schema[name].dataType.elementType.typeName() == "struct":
            return docs.select(F.inline(name))
        return docs.select(F.explode(name).alias("id")).where("false")

    return table("images"), table("annotations"), table("categories")


def running_ids(df: DataFrame, group: str, pos: str) -> DataFrame:
    """annotation_id from 1 in order of group and position: counts per group give the starts, so no global sort of the rows."""
    from .prefix import running_total

    counts = df.groupBy(F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("__n"))
    starts = running_total(counts, "__g", "__n", [], "__start").select("__g", "__start")
    nth = F.row_number().over(Window.partitionBy(group).orderBy(pos))
    return df.withColumn("__nth", nth).join(starts, F.col(group) == F.col("__g")).withColumn("annotation_id", F.col("__start") + F.col("__nth")).drop("__nth", "__g", "__start")
