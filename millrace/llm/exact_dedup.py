"""Exact deduplication by a tree merge of sorted digest runs (DataFrame functions only).

Every input partition is reduced to a run: one row for each distinct digest with its best identifier and
count. Runs then meet in binomial rounds: in round r the runs whose numbers agree above their lowest
r * log2(fan_in) bits are merged, sorted by digest, and each digest keeps its best identifier and total. A
digest therefore has at most `fan_in` rows in any merge, however many copies the corpus holds, and no round
gathers a run into one task: rows are dealt by (group of runs, digest). The totals return down the same tree,
so the copies of one text are never joined on the digest alone.

Digests are verified at every level by the byte length and an independent 64-bit hash beside SHA-256.

Nulls: a null text counts as empty; a null identifier is smaller than any other. Ties: of rows equal in text
and identifier exactly one is kept. Empty tables give empty results. Other columns of the input, whatever their
names, are not read by `exact_groups` and come back unchanged from `exact_dedup`.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, fresh

#: What must agree for two texts to be called equal.
PROOF = ["digest", "n_bytes", "check_hash"]


def _digest(text: str) -> list:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return [F.unhex(F.sha2(body, 256)).alias("digest"), F.octet_length(body).alias("n_bytes"), F.xxhash64(body).alias("check_hash")]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in_bits: int = 5) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, and the proof columns."""
    scratch = Scratch(docs.sparkSession, "exact")
    runs = scratch.cut(
        docs.select(
            F.col(f"`{id_col}`").alias("doc_id"), *_digest(text_col), F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("uid")
        ),
        "runs",
    )
    n_runs = (runs.agg(F.max("run")).first()[0] or 0) + 1
    best = F.max(F.struct(F.col("doc_id"), F.col("uid"))).alias("best")
    levels = [runs.groupBy("run", *PROOF).agg(best, F.count(F.lit(1)).alias("n"))]
    while n_runs > 1:
        n_runs = (n_runs + (1 << fan_in_bits) - 1) >> fan_in_bits
        level = scratch.cut(levels[-1], f"level{len(levels)}")
        levels[-1] = level
        merged = level.withColumn("run", F.shiftright("run", fan_in_bits))
        levels.append(merged.groupBy("run", *PROOF).agg(F.max("best").alias("best"), F.sum("n").alias("n")))
    top = levels.pop()

    def down(above: DataFrame, level: DataFrame) -> DataFrame:
        own = level.select("run", *PROOF, F.shiftright("run", fan_in_bits).alias("parent"))
        return own.join(above.withColumnRenamed("run", "parent"), ["parent", *PROOF]).drop("parent")

    found = reduce(down, reversed(levels), top)
    rows = runs.join(found, ["run", *PROOF])
    return rows.select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("uid") == F.col("best.uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        *PROOF,
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key, none, nth, *proof = fresh(docs.columns, "__key", "__none", "__nth", *[f"__{c}" for c in PROOF])
    keys = [key, none, *proof]
    # Plain keys, so that the join's partitioning serves the window too and texts move once.
    named = lambda c: [F.coalesce(c.cast("string"), F.lit("")).alias(key), c.isNull().alias(none)]
    own = [c.alias(name) for c, name in zip(_digest(text_col), proof, strict=True)]
    kept = exact_groups(docs, id_col, text_col).where("kept").select(*named(F.col("doc_id")), *[F.col(c).alias(name) for c, name in zip(PROOF, proof, strict=True)])
    stay = docs.select(*columns, *named(F.col(f"`{id_col}`")), *own).join(kept, keys, "left_semi")
    # Rows equal in identifier and text cannot be told apart by the join; one of them stays.
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(key))
    return stay.withColumn(nth, first).where(F.col(nth) == 1).select(*columns)
