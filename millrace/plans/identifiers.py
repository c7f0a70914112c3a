"""Identifiers, digests, paths and codes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import hashing, paths
from .base import Registry, read, register

REGISTRY: Registry = {}


@register(REGISTRY, "SELECT c_custkey, c_mktsegment || '_' || substr(sha1(coalesce(c_name, '') || '|' || c_custkey || '|' || c_nationkey), 1, 16) AS sample_id FROM customer")
def sample_id(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", hashing.sample_id(F.col("c_mktsegment"), F.col("c_name"), F.col("c_custkey"), F.col("c_nationkey")).alias("sample_id"))


@register(REGISTRY, "SELECT doc_id, sha256(coalesce(text, '')) AS digest FROM documents")
def sha256_digest(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", hashing.content_digest(F.col("text")).alias("digest"))


@register(REGISTRY, "SELECT page_id, regexp_replace(coalesce(url, ''), '[^A-Za-z0-9_.-]+', '_', 'g') AS key FROM pages")
def tar_key(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", paths.tar_key(F.col("url")).alias("key"))


@register(
    REGISTRY,
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '([^/]*)$', 1) AS base FROM pages)
SELECT page_id, regexp_replace(base, '^(.+)\\.[^.]*$', '\\1') AS stem, lower(regexp_extract(base, '^.+(\\.[^.]*)$', 1)) AS suffix,
       CASE WHEN regexp_matches(base, '^.+\\.[^.]*$') THEN regexp_replace(url, '\\.[^./]*$', '.jpg') ELSE url || '.jpg' END AS renamed,
       CASE WHEN ends_with(lower(url), '.png') THEN regexp_replace(url, '\\.[^./]*$', '.jpg') ELSE url END AS png_renamed FROM p""",
)
def path_stem_suffix(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select(
        "page_id", paths.stem(url).alias("stem"), paths.suffix(url).alias("suffix"), paths.replace_suffix(url).alias("renamed"), paths.png_to(url).alias("png_renamed")
    )


@register(
    REGISTRY,
    """WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'x/K-' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || '/y' END AS a,
       'img K-' || lpad(CAST(c_nationkey AS VARCHAR), 6, '0') || '.png' AS b FROM customer)
SELECT c_custkey, coalesce(nullif(regexp_extract(a, 'K-\\d{6}', 0), ''), nullif(regexp_extract(b, 'K-\\d{6}', 0), ''), '') AS code FROM t""",
)
def code_extract(spark, sf_dir):
    key = F.lpad(F.col("c_custkey").cast("string"), 6, "0")
    a = F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.concat(F.lit("x/K-"), key, F.lit("/y")))
    b = F.concat(F.lit("img K-"), F.lpad(F.col("c_nationkey").cast("string"), 6, "0"), F.lit(".png"))
    return read(spark, sf_dir, "customer").select("c_custkey", paths.first_code(a, b).alias("code"))


@register(
    REGISTRY,
    """WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN 'mix_K-' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || '_K-' || lpad(CAST(p_size AS VARCHAR), 6, '0')
       ELSE 'K-' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || '-' || lpad(CAST(p_size AS VARCHAR), 6, '0') || '-x_0_2' END AS name FROM part)
SELECT p_partkey, array_to_string(CASE WHEN string_split(string_split(name, '_')[1], '-')[1] = 'K'
       THEN list_transform(list_filter(string_split(string_split(name, '_')[1], '-')[2:], lambda p: regexp_full_match(p, '[0-9]+')), lambda p: 'K-' || p)
       ELSE regexp_extract_all(name, 'K-\\d{6}') END, ',') AS codes FROM t""",
)
def combo_parse(spark, sf_dir):
    key, size = F.lpad(F.col("p_partkey").cast("string"), 6, "0"), F.lpad(F.col("p_size").cast("string"), 6, "0")
    name = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("mix_K-"), key, F.lit("_K-"), size)).otherwise(F.concat(F.lit("K-"), key, F.lit("-"), size, F.lit("-x_0_2")))
    return read(spark, sf_dir, "part").select("p_partkey", F.concat_ws(",", paths.combo_codes(F.concat(F.lit("dir/"), name, F.lit(".png")))).alias("codes"))


@register(REGISTRY, "SELECT p_partkey, replace(p_brand || '/' || p_type, '/', '_') || '_' || lpad(CAST(p_size AS VARCHAR), 5, '0') AS asset_key FROM part")
def asset_key(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", paths.asset_key(F.concat_ws("/", "p_brand", "p_type"), F.col("p_size")).alias("asset_key"))


@register(REGISTRY, "SELECT event_id, coalesce(CAST(json_extract(CASE WHEN event_id % 5 = 0 THEN '{}' ELSE props END, '$.k') AS BIGINT), -1) AS k FROM events")
def json_extract_default(spark, sf_dir):
    from ..operators.labels import json_or

    text = F.when(F.col("event_id") % 5 == 0, "").otherwise(F.col("props"))
    parsed = json_or(text, "struct<k:bigint>", F.struct(F.lit(-1).cast("long").alias("k")))
    return read(spark, sf_dir, "events").select("event_id", F.coalesce(parsed["k"], F.lit(-1)).alias("k"))
