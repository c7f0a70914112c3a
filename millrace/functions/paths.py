"""Paths, member names and identifiers in them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A product code (fixed pattern).
CODE = r"K-\d{6}"


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def stem(path: Column) -> Column:
    """The base name without its last suffix; a leading dot begins no suffix."""
    return F.regexp_replace(basename(path), r"^(.+)\.[^.]*$", "$1")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(basename(path), r"^.+(\.[^.]*)$", 1))


def replace_suffix(path: Column, new: str = ".jpg") -> Column:
    """The last suffix replaced, or added where there is none."""
    return F.when(basename(path).rlike(r"^.+\.[^.]*$"), F.regexp_replace(path, r"\.[^./]*$", new)).otherwise(F.concat(path, F.lit(new)))


def png_to(path: Column, new: str = ".jpg") -> Column:
    """.png in any case replaced; all else unchanged."""
    return F.when(F.lower(path).endswith(".png"), F.regexp_replace(path, r"\.[^./]*$", new)).otherwise(path)


def tar_key(text: Column) -> Column:
    """Each run of characters other than letters, digits, _ . - becomes one underscore."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[^A-Za-z0-9_.-]+", "_")


def first_code(*texts: Column) -> Column:
    """The first product code of the first text that has one, or empty."""
    found = [F.nullif(F.regexp_extract(F.coalesce(t, F.lit("")), CODE, 0), F.lit("")) for t in texts]
    return F.coalesce(*found, F.lit(""))


def combo_codes(path: Column) -> Column:
    """The codes of a combination's name: K-a-b-c before the first underscore, or all codes in the name."""
    name = F.coalesce(stem(path), F.lit(""))
    parts = F.split(F.substring_index(name, "_", 1), "-")
    listed = F.transform(F.filter(F.slice(parts, 2, 1_000), lambda p: p.rlike(r"^[0-9]+$")), lambda p: F.concat(F.lit("K-"), p))
    return F.when(F.get(parts, F.lit(0)) == "K", listed).otherwise(F.regexp_extract_all(name, F.lit(f"({CODE})"), F.lit(1)))


def asset_key(product: Column, index: Column) -> Column:
    """Product with / as _, and a five-digit index."""
    return F.concat(F.translate(product, "/", "_"), F.lit("_"), F.format_string("%05d", index))
