"""Reports on generated and recompressed data sets: a row for each rule with its violations, counted where the rows are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Box
from . import overlap, stats, validate
from .prefix import order_statistics
from .validate import Rule


def _together(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def strict_report(images: DataFrame, annotations: DataFrame, classes: DataFrame, assets: DataFrame | None = None, real: DataFrame | None = None, floor: int = 0, numerator: int = 1, denominator: int = 50) -> DataFrame:
    """Rules on annotations (class mapping, asset, box), images (number, products, overlaps) and classes (use, floor).

    images: image_id, width, height, combo_size; annotations: image_id, pos, product_id, category_id, class_index, x, y, w, h and,
    with assets (asset_id, product_id), source_asset_id; classes: product_id, category_id, class_index; real: product_id.
    An annotation without its image has a faulty box; a class counts its real and generated rows against the floor.
    """
    c = F.col
    expected = classes.select(c("product_id").alias("__product"), c("category_id").alias("__category"), c("class_index").alias("__index"))
    size = images.select(c("image_id").alias("__image"), "width", "height")
    rows = annotations.join(expected, c("product_id") == c("__product"), "left").join(size, c("image_id") == c("__image"), "left")
    known = c("__product").isNotNull()
    rules = [
        Rule("unknown_product", ~known),
        Rule("forbidden_category", known & (c("category_id") == 1)),
        Rule("category_mismatch", known & ~c("category_id").eqNullSafe(c("__category"))),
        Rule("class_index_mismatch", known & ~c("class_index").eqNullSafe(c("__index"))),
        Rule("box", ~Box.of().strict(c("width"), c("height"))),
    ]
    if assets is not None:
        own = assets.select(c("asset_id").alias("__asset"), c("product_id").alias("__of"))
        rows = rows.join(own, c("source_asset_id") == c("__asset"), "left")
        rules.append(Rule("source_asset", known & ~c("__of").eqNullSafe(c("product_id"))))
    per = annotations.groupBy(c("image_id").alias("__i")).agg(F.count(F.lit(1)).alias("__n"), F.count_distinct(F.coalesce(c("product_id").cast("string"), F.lit(""))).alias("__products"))
    pairs = overlap.failures(overlap.overlap_pairs(annotations, "image_id", "pos", numerator, denominator), "image_id").select(c("image_id").alias("__j"), "per_pair")
    pictures = images.join(per, c("image_id") == c("__i"), "left").join(pairs, c("image_id") == c("__j"), "left")
    on_images = [
        Rule("combo_size", ~c("combo_size").eqNullSafe(F.coalesce("__n", F.lit(0)))),
        Rule("duplicate_product", c("__products") < c("__n")),
        Rule("overlap", c("per_pair") > 0),
    ]
    counted = {"__made": (annotations, "product_id")} | ({"__real": (real, "product_id")} if real is not None else {})
    used = stats.class_distribution(classes.select("product_id"), "product_id", counted)
    total = c("__made") + (c("__real") if real is not None else F.lit(0))
    on_classes = [Rule("unused_class", c("__made") == 0), Rule("below_floor", total < floor)]
    return _together([validate.report(rows, rules), validate.report(pictures, on_images), validate.report(used, on_classes)])


def asset_report(assets: DataFrame, classes: DataFrame, quota: int) -> DataFrame:
    """Rules on an asset manifest (asset_id, product_id, category_id, class_index): mapping, duplicates, and the quota of every class."""
    c = F.col
    expected = classes.select(c("product_id").alias("__product"), c("category_id").alias("__category"), c("class_index").alias("__index"))
    known = c("__product").isNotNull()
    mapped = ~(c("category_id").eqNullSafe(c("__category")) & c("class_index").eqNullSafe(c("__index")))
    rows = assets.join(expected, c("product_id") == c("__product"), "left")
    rules = [Rule("unknown_product", ~known), Rule("forbidden_category", known & (c("category_id") == 1)), Rule("mapping", known & mapped)]
    keys = assets.groupBy("asset_id").agg(F.count(F.lit(1)).alias("__n"))
    used = stats.class_distribution(classes.select("product_id"), "product_id", {"__have": (assets, "product_id")})
    return _together([validate.report(rows, rules), validate.report(keys, [Rule("duplicate_asset", c("__n") > 1)]), validate.report(used, [Rule("quota", c("__have") != quota)])])


def compressed_report(expected: DataFrame, actual: DataFrame, before: DataFrame, after: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Per set_id of recompressed archives: missing and extra members, and label documents that changed.

    expected, actual: set_id, member; before, after: set_id, the keys and fields of the label documents.
    """
    by = ["set_id", "member"]
    a, b = expected.select(*by).distinct(), actual.select(*by).distinct()
    found = [
        a.join(b, by, "left_anti").select("set_id", F.lit("missing_member").alias("rule")),
        b.join(a, by, "left_anti").select("set_id", F.lit("extra_member").alias("rule")),
        validate.document_diff(before, after, ["set_id", *keys], fields).select("set_id", F.lit("changed_document").alias("rule")),
    ]
    return _together(found).groupBy("set_id", "rule").agg(F.count(F.lit(1)).alias("violations"))


#: Accepted mean of objects per image and share of the canvas that an object takes (fixed values).
MEAN_OBJECTS, AREA_SHARE, OBJECTS = (3.2, 3.4), (0.02, 0.12), (2, 4)


def distribution_report(annotations: DataFrame, classes: DataFrame, source: DataFrame, width: int, height: int) -> DataFrame:
    """How a generated set matches its source, as rows (rule, value, passed); passed is null where a rule only informs.

    annotations: image_id, category_id, w, h; classes: category_id; source: category_id, one row an instance. Correlations
    are over the classes that the source has.
    """
    c = F.col
    counts = stats.class_distribution(classes.select("category_id"), "category_id", {"__source": (source, "category_id"), "__made": (annotations, "category_id")})
    active = counts.where(c("__source") > 0)
    number = lambda df, rule: df.select(F.lit(rule).alias("rule"), c("correlation").alias("value"))
    per = annotations.groupBy("image_id").agg(F.count(F.lit(1)).alias("__n"))
    sizes = per.agg(F.avg("__n").alias("mean_objects"), F.avg((~c("__n").between(*OBJECTS)).cast("double")).alias("share_of_other_sizes"))
    share = annotations.select((c("w") * c("h") / F.lit(float(width * height))).alias("__share"))
    within = share.agg(F.avg(c("__share").between(*AREA_SHARE).cast("double")).alias("share_within_area"))
    spread = order_statistics(share, [], "__share", [0.05, 0.5, 0.95]).select(*[c("quantiles")[i].alias(f"area_p{p:02d}") for i, p in enumerate((5, 50, 95))])
    wide = [df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), c(n).alias("value")) for n in df.columns]))) for df in (sizes, within, spread)]
    rows = _together([*wide, number(stats.spearman(active, "__source", "__made"), "spearman"), number(stats.correlation(active, "__source", "__made"), "pearson")])
    judged = F.when(c("rule") == "mean_objects", c("value").between(*MEAN_OBJECTS)).when(c("rule") == "share_of_other_sizes", c("value") == 0)
    judged = judged.when(c("rule").isin("area_p05", "area_p95"), c("value").between(*AREA_SHARE))
    return rows.select("rule", F.round("value", 6).alias("value"), judged.alias("passed"))


def dirty_audit(candidates: DataFrame, suspects: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(the candidates that are no suspects, one row with the numbers of candidates, suspects among them, and clean ones)."""
    flagged = suspects.select(*keys).distinct().withColumn("__dirty", F.lit(True))
    marked = candidates.join(flagged, keys, "left")
    counts = marked.agg(F.count(F.lit(1)).alias("candidates"), F.count("__dirty").alias("suspects"), F.count_if(F.col("__dirty").isNull()).alias("clean"))
    return marked.where("__dirty is null").drop("__dirty"), counts


def averaged_views(scores: DataFrame, item: str, label: str, score: str, least: int = 1) -> DataFrame:
    """The mean score of each item's labels over its views, and the best label: ties go to the smaller one."""
    mean = scores.groupBy(item, label).agg(F.avg(score).alias("__s"), F.count(score).alias("__views")).where(F.col("__views") >= least)
    best = mean.groupBy(F.col(item).alias("__item")).agg(F.max("__s").alias("score"))
    top = mean.join(best, (F.col(item) == F.col("__item")) & (F.col("__s") == F.col("score")))
    return top.groupBy(item, "score").agg(F.min(label).alias(label))
