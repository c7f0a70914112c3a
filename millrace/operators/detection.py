"""Evaluation of detections and segmentations, box consensus and promotion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import Box
from ..functions.numbers import wilson_lower
from .prefix import running_totals


def match(truth: DataFrame, found: DataFrame, keys: list[str], pos: str, score: str, percent: int = 50) -> DataFrame:
    """Adds tp to the detections: each takes its best box of the truth; of those that take one box, the first by score is
    true if it overlaps by `percent`, all else is false. Ties go to the smaller position."""
    t = truth.select(*keys, F.col(pos).alias("gt_pos"), *[F.col(c).alias(f"g_{c}") for c in "xywh"])
    pairs = found.join(t, keys)
    a, b = Box.of(), Box.of("g_")
    iou = a.iou(b)
    best = pairs.groupBy(*keys, pos, score).agg(F.max(F.struct(iou.alias("iou"), (-F.col("gt_pos")).alias("o"))).alias("__b"))
    best = best.select(*keys, pos, score, F.col("__b.iou").alias("iou"), (-F.col("__b.o")).alias("gt_pos"))
    # A box of the truth counts once, for the first detection that reaches it.
    reach = best.where(F.col("iou") * 100 >= percent).withColumn("__nth", F.row_number().over(Window.partitionBy(*keys, "gt_pos").orderBy(F.desc(score), pos)))
    hits = reach.where("__nth = 1").select(*keys, pos, F.lit(1).alias("tp"))
    return found.join(hits, [*keys, pos], "left").withColumn("tp", F.coalesce("tp", F.lit(0)))


def pr_curve(matched: DataFrame, truth_counts: DataFrame, by: str, score: str, ties: list[str], bounds: list | None = None) -> DataFrame:
    """Per class and detection by falling score: running true positives, rank, precision and recall.

    bounds: quantiles of the negated score, if known from a cheaper table than `matched`.
    """
    # A class may hold most detections: its sums run in buckets of the score.
    falling = matched.withColumn("__falling", -F.col(score)).withColumn("__one", F.lit(1))
    run = running_totals(falling, "__falling", {"tps": "tp", "rank": "__one"}, ties, [by], bounds)
    run = run.withColumn("tps", F.col("tps") + F.col("tp")).withColumn("rank", F.col("rank") + 1).drop("__falling", "__one")
    run = run.join(truth_counts, by)
    return run.withColumn("precision", F.col("tps") / F.col("rank")).withColumn("recall", F.col("tps") / F.greatest(F.col("n_truth"), F.lit(1)))


def average_precision(curve: DataFrame, truth_counts: DataFrame, by: str) -> DataFrame:
    """Per class: the mean over 101 recalls of the best precision at that recall or beyond; 0 without detections.

    Recalls are compared as integers: 100 * true positives against point * truth.
    """
    # Only the counts that first reach a recall point or lie beyond it matter: a class has at most 101 rows from here on.
    reached = F.floor(100 * F.col("tps") / F.col("n_truth"))
    best = curve.where("n_truth > 0").groupBy(by, reached.alias("__reach")).agg(F.max("precision").alias("p"))
    # Falling recall with the running maximum so far, in place of a look ahead from each row.
    ahead = Window.partitionBy(by).orderBy(F.desc("__reach"))
    beyond = best.withColumn("p", F.max("p").over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
    # Point k takes the row of the least reach that is at least k.
    prior = F.coalesce(F.lead("__reach").over(ahead), F.lit(-1))
    span = beyond.withColumn("__points", F.least(F.col("__reach"), F.lit(100)) - prior)
    ap = span.groupBy(by).agg((F.sum(F.col("p") * F.col("__points")) / 101).alias("__ap"))
    return truth_counts.join(ap, by, "left").select(by, "n_truth", F.round(F.coalesce("__ap", F.lit(0.0)), 6).alias("ap"))


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def overlap_scores(matrix: DataFrame) -> DataFrame:
    """Per class of a confusion matrix: intersection, union, IoU and Dice."""
    t = matrix.groupBy(F.col("truth").alias("class")).agg(F.sum("n").alias("in_truth"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hit"))
    p = matrix.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("in_predicted"))
    both = t.join(p, "class", "full_outer").na.fill(0)
    union = F.col("in_truth") + F.col("in_predicted") - F.col("hit")
    iou = F.col("hit") / F.greatest(union, F.lit(1))
    return both.select("class", "hit", union.alias("union"), F.round(iou, 6).alias("iou"), F.round(2 * iou / (1 + iou), 6).alias("dice"))


def overall_scores(matrix: DataFrame) -> DataFrame:
    """One row: pixel accuracy, mean IoU, and mean Dice."""
    accuracy = matrix.agg(F.round(F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)) / F.greatest(F.sum("n"), F.lit(1)), 6).alias("pixel_accuracy"))
    return accuracy.crossJoin(F.broadcast(overlap_scores(matrix).agg(F.round(F.avg("iou"), 6).alias("mean_iou"), F.round(F.avg("dice"), 6).alias("mean_dice"))))


def panoptic_quality(pairs: DataFrame, n_truth: DataFrame, n_found: DataFrame, by: str) -> DataFrame:
    """Per class, of segment pairs with their iou: pairs above one half are matches; SQ, RQ and their product."""
    hits = pairs.where("iou > 0.5").groupBy(by).agg(F.count(F.lit(1)).alias("tp"), F.sum("iou").alias("s"))
    all_ = n_truth.join(n_found, by, "full_outer").join(hits, by, "left").na.fill(0)
    sq = F.coalesce(F.try_divide(F.col("s"), F.col("tp")), F.lit(0.0))
    rq = F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("n_truth") + F.col("n_found")), F.lit(0.0))
    return all_.select(by, "tp", F.round(sq, 6).alias("sq"), F.round(rq, 6).alias("rq"), F.round(sq * rq, 6).alias("pq"))


def consensus(votes: DataFrame, keys: list[str], method: str, percent: int = 50, least: int = 3) -> DataFrame:
    """Per object the median box of the votes that agree with the best supported vote; objects with too few are dropped.

    Every method has one vote; two votes agree if their IoU is at least `percent`.
    """
    other = votes.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(method).alias("__m"), *[F.col(c).alias(f"o_{c}") for c in "xywh"])
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"__{k}"))
    agree = votes.join(other, same).where(Box.of().iou(Box.of("o_")) * 100 >= percent)
    degree = agree.groupBy(*keys, method).agg(F.count(F.lit(1)).alias("__d"))
    core = degree.groupBy(*keys).agg(F.max(F.struct(F.col("__d"), (-F.col(method)).alias("o"))).alias("__c"))
    core = core.select(*keys, (-F.col("__c.o")).alias("__core"), F.col("__c.__d").alias("support")).where(F.col("support") >= least)
    members = agree.join(core, keys).where(F.col(method) == F.col("__core"))
    middle = [F.expr(f"percentile(o_{c}, 0.5)").alias(c) for c in "xywh"]
    return members.groupBy(*keys, "support").agg(*middle)


def promotion(groups: DataFrame, hits: str, n: str, strategies: str, families: str, quality: str, min_n: int = 500, min_lower: float = 0.995, min_strategies: int = 3, min_families: int = 2, min_quality: float = 0.90, iou: str | None = None, dispersion: str | None = None, min_iou: float = 0.80, max_dispersion: float = 0.035) -> DataFrame:
    """Adds lower (the Wilson bound) and promoted; anything missing fails. The least pairwise IoU and the edge dispersion
    of a group count where their columns are named."""
    lower = wilson_lower(F.col(hits), F.col(n))
    passes = (F.col(n) >= min_n) & (lower >= min_lower) & (F.col(strategies) >= min_strategies) & (F.col(families) >= min_families) & (F.col(quality) >= min_quality)
    if iou:
        passes = passes & ~F.isnan(iou) & (F.col(iou) >= min_iou)
    if dispersion:
        passes = passes & ~F.isnan(dispersion) & (F.col(dispersion) <= max_dispersion)
    return groups.withColumn("lower", F.round(lower, 9)).withColumn("promoted", F.coalesce(passes, F.lit(False)))


def tile_grid(images: DataFrame, width: str, height: str, tile: int, overlap: int) -> DataFrame:
    """Overlapping tiles that cover every image; the last ones end at its edge."""
    step = tile - overlap
    starts = lambda side: F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((F.col(side) - tile) / step)).cast("int"))
    tiles = images.withColumn("tx", F.explode(starts(width))).withColumn("ty", F.explode(starts(height)))
    at = lambda t, side: F.greatest(F.lit(0), F.least(F.col(t) * step, F.col(side) - tile))
    return tiles.withColumn("x0", at("tx", width)).withColumn("y0", at("ty", height)).withColumn("x1", F.least(F.col("x0") + tile, F.col(width))).withColumn("y1", F.least(F.col("y0") + tile, F.col(height)))
