"""The metadata of a generated data set: combinations, assets, places, annotations; and documents for each object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_unit
from ..functions.numbers import piecewise
from ..operators import assets, labels, schedule
from ..session import shared_folder

#: The whole set is given up beyond this many layouts of an image (fixed value).
ROUNDS = 30


def generate(sizes: DataFrame, classes: DataFrame, bank: DataFrame, points: list[tuple[float, float]], width: int, height: int, seed: str, prefix: str = "synthetic", rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(images, annotations, combinations without a layout).

    sizes: combo (a number), size; classes: product_id, category_id, class_index; bank: asset_id, product_id, aspect. Products
    are the least used ones, each deals its assets in turn, sides are drawn from the points of an inverse distribution, and an
    image is laid out up to `rounds` times. A combination that finds no layout has no image; images are not renumbered for it.
    The products, the objects and their places are written to the shared folder, so that later steps do not draw them again.
    """
    c, folder = F.col, shared_folder(sizes.sparkSession)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    chosen = schedule.balanced_schedule(sizes, "combo", "size", classes, "product_id").withColumnRenamed("product", "product_id")
    chosen = stored(chosen, "products")
    dealt = schedule.round_robin(chosen, "product_id", ["combo", "slot"], bank.select("product_id", "asset_id"), "asset_id", seed)
    shapes = bank.select(c("asset_id").alias("asset"), c("product_id").alias("__p"), "aspect")
    dealt = dealt.withColumnRenamed("asset", "__a").join(shapes, (c("__a") == c("asset")) & (c("product_id") == c("__p"))).drop("__a", "__p")
    side = piecewise(F.lit(0.05) + F.lit(0.9) * hash_unit(seed, c("combo"), c("slot"), F.lit("side")), points)
    root = F.sqrt(c("aspect").cast("double"))
    sized = dealt.withColumn("w", F.bround(side * root, 0).cast("long")).withColumn("h", F.bround(side / root, 0).cast("long"))
    sized = sized.join(sizes.select("combo", c("size").cast("int").alias("size")), "combo")
    cx, cy = assets.centre(c("combo"), c("size"), c("slot"), width, height, seed)
    sized = stored(sized.withColumn("cx", cx).withColumn("cy", cy), "objects")
    placed = assets.place_objects(sized, "combo", "slot", width, height, seed, rounds=rounds).withColumnRenamed("image", "combo")
    placed = stored(placed.withColumn("__least", F.min("attempt").over(Window.partitionBy("combo"))), "places")
    failed = placed.where("__least < 0").select("combo").distinct()
    kept = placed.where("__least >= 0").drop("__least").join(sized.drop("cx", "cy"), ["combo", "slot"]).join(classes, "product_id")
    numbered = labels.running_ids(kept, "combo", "slot")
    annotations = numbered.select(
        c("annotation_id").alias("id"), c("combo").alias("image_id"), (c("slot") + 1).alias("pos"), "category_id", "class_index", "product_id", "x", "y", "w", "h", (c("w") * c("h")).alias("area"), c("asset").alias("source_asset_id")
    )
    file = F.format_string(f"{prefix}_%06d.jpg", c("combo").cast("long"))
    images = kept.groupBy("combo").agg(F.count(F.lit(1)).cast("int").alias("combo_size")).select(c("combo").alias("image_id"), file.alias("file_name"), F.lit(width).alias("width"), F.lit(height).alias("height"), "combo_size")
    return images, annotations, failed


def object_documents(images: DataFrame, annotations: DataFrame, names: DataFrame) -> DataFrame:
    """Rows (file, content): a label document for each annotation, in a folder of its combination and product.

    images: image_id, file_name, width, height; annotations: image_id, pos, id, product_id, category_id, x, y, w, h; names:
    category_id, name. Stored one file each by the sink `binary_files`.
    """
    c = F.col
    key = annotations.groupBy("image_id").agg(F.concat_ws("-", F.transform(F.array_sort(F.collect_list(F.struct("pos", c("product_id").cast("string").alias("p")))), lambda x: x["p"])).alias("__key"))
    rows = annotations.join(key, "image_id").join(images.select("image_id", "file_name", "width", "height"), "image_id").join(names.select("category_id", "name"), "category_id")
    product = c("product_id").cast("string")
    image = F.struct("file_name", "width", "height", product.alias("drug_N"))
    zero = F.lit(0)
    found = F.struct((c("w") * c("h")).alias("area"), zero.alias("iscrowd"), F.array("x", "y", "w", "h").alias("bbox"), "category_id", zero.alias("ignore"), F.array().cast("array<double>").alias("segmentation"), "id", "image_id")
    category = F.struct(F.lit("pill").alias("supercategory"), c("category_id").alias("id"), "name")
    document = F.struct(F.array(image).alias("images"), F.lit("instances").alias("type"), F.array(found).alias("annotations"), F.array(category).alias("categories"))
    return rows.select(object_path(c("__key"), product, c("file_name")).alias("file"), labels.compact_json(document).alias("content"))


def object_path(key: Column, product: Column, file_name: Column) -> Column:
    stem = F.regexp_replace(file_name, r"\.[^.]*$", "")
    return F.concat(key, F.lit("_json/"), product, F.lit("/"), stem, F.lit(".json"))
