"""Text preparation: cleaning, tokens, stop words, vocabularies, padding, n-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The stop words taken out by default (fixed values).
STOP_WORDS = ["a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with"]


def clean(text: Column) -> Column:
    """Without scripts, styles, tags and character references; symbols as spaces; one space between words; lower case."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    bare = F.regexp_replace(F.regexp_replace(bare, r"<[^>]*>", " "), r"&[a-zA-Z#0-9]+;", " ")
    return F.lower(F.trim(F.regexp_replace(F.regexp_replace(bare, r"[^a-zA-Z0-9 ]", " "), r" +", " ")))


def tokenize(cleaned: Column) -> Column:
    return F.filter(F.split(cleaned, " "), lambda w: w != "")


def without_stop_words(tokens: Column, stop: list[str] = STOP_WORDS) -> Column:
    listed = F.array(*[F.lit(w) for w in stop])
    return F.filter(tokens, lambda w: ~F.array_contains(listed, w))


def vocabulary(df: DataFrame, tokens: str, size: int, first_id: int = 2) -> DataFrame:
    """The most frequent tokens, ties by name, numbered from `first_id` (0 pads, 1 is unknown)."""
    counts = df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "token").limit(size)
    return top.withColumn("id", (F.row_number().over(Window.orderBy(F.desc("n"), "token")) + first_id - 1).cast("int"))


def encode(df: DataFrame, id_col: str, tokens: str, vocab: DataFrame, length: int) -> DataFrame:
    """Per row the ids of its first `length` tokens, 1 for unknown ones, padded with 0."""
    flat = df.select(id_col, F.posexplode_outer(F.slice(tokens, 1, length)).alias("pos", "token"))
    known = flat.join(vocab.select("token", F.col("id").alias("__id")), "token", "left")
    listed = F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("__id", F.lit(1)).alias("id")))))
    ids = known.groupBy(id_col).agg(F.transform(listed, lambda x: x["id"]).alias("__ids"))
    return ids.select(id_col, F.concat("__ids", F.array_repeat(F.lit(0), F.lit(length) - F.size("__ids"))).alias("ids"))


def char_ngrams(word: Column, n: int = 3) -> Column:
    """Character n-grams of the word between < and >."""
    marked = F.concat(F.lit("<"), word, F.lit(">"))
    starts = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substring(marked, i, F.lit(n)))


def has_any(text: Column, needles: list[str]) -> Column:
    """The first needle of the list that the text contains, else null."""
    found = F.lit(None).cast("string")
    for n in reversed(needles):
        found = F.when(F.contains(F.coalesce(text, F.lit("")), F.lit(n)), F.lit(n)).otherwise(found)
    return found


def word_counts(df: DataFrame, id_col: str, tokens: str) -> DataFrame:
    return df.select(id_col, F.explode(tokens).alias("token")).groupBy(id_col, "token").agg(F.count(F.lit(1)).alias("n"))
