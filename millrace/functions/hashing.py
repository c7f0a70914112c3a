"""Deterministic draws: every random choice is a hash of (seed, keys), so it does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_key(*parts: Column | str) -> Column:
    """Parts joined by |; a null part counts as empty, so that it still holds its place."""
    return F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def hash_order(*parts: Column | str) -> Column:
    """The first 16 hex digits of the SHA-1 of the key: sorts like the 64-bit integer."""
    return F.substring(F.sha1(text_key(*parts)), 1, 16)


def hash_int(*parts: Column | str) -> Column:
    """A non-negative integer below 2**52 from the SHA-1 of the key."""
    return F.conv(F.substring(F.sha1(text_key(*parts)), 1, 13), 16, 10).cast("long")


def hash_unit(*parts: Column | str) -> Column:
    """A number in [0, 1) from the SHA-1 of the key."""
    return hash_int(*parts) / F.lit(float(1 << 52))


def sample_id(split_source: Column, *parts: Column) -> Column:
    """split_source + '_' + the first 16 hex digits of the SHA-1 of the parts."""
    return F.concat(F.coalesce(split_source.cast("string"), F.lit("")), F.lit("_"), hash_order(*parts))


def content_digest(content: Column) -> Column:
    return F.sha2(F.coalesce(content, F.lit("")), 256)
