"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .url_filter import TWO_LABEL_SUFFIXES


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import substring_dedup

    found = substring_dedup(table(spark, sf_dir, "documents"), window=35)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls

    labels = table(spark, sf_dir, "labels").where("quality is not null and toxic is not null")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0).alias("bad"))
    return filter_urls(table(spark, sf_dir, "pages"), outcomes)


_STRENGTH = """SELECT CASE WHEN sum(n * pow(bad / n - prior, 2)) > sum(prior * (1 - prior))
    THEN least(10000.0, greatest(1.0, (sum(n * prior * (1 - prior)) - sum(prior * (1 - prior))) / (sum(n * pow(bad / n - prior, 2)) - sum(prior * (1 - prior))) - 1))
    ELSE 10000.0 END FROM"""

#: Does the host end in a suffix of two labels?
_TWO = f"array_to_string(list_slice(string_split(host, '.'), -2, NULL), '.') IN ({', '.join(repr(s) for s in TWO_LABEL_SUFFIXES)})"

OP2_SQL = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, coalesce(rest, '') AS rest FROM cut)
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/7') THEN 'example.com/en/7'
      WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/de/8') THEN 'example.net/de/8'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/es/') THEN 'org/es/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/de/') THEN 'net/de/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/en/') THEN 'com/en/' END AS rule
  FROM parts
), hosts AS (
  SELECT host, count(*)::DOUBLE AS n, sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1.0 ELSE 0.0 END)::DOUBLE AS bad,
         array_to_string(list_slice(string_split(host, '.'), CASE WHEN {_TWO} THEN -3 ELSE -2 END, NULL), '.') AS domain,
         array_to_string(list_slice(string_split(host, '.'), CASE WHEN {_TWO} THEN -2 ELSE -1 END, NULL), '.') AS suffix
  FROM parts JOIN labels ON labels.doc_id = parts.page_id
  WHERE quality IS NOT NULL AND toxic IS NOT NULL AND host <> '' GROUP BY host
), d0 AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
s0 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT sum(bad) / sum(n) FROM hosts) AS prior FROM d0 GROUP BY suffix),
s1 AS (SELECT suffix, (bad + k * prior) / (n + k) AS mean FROM s0, ({_STRENGTH} s0) AS t(k)),
d1 AS (SELECT d0.*, mean AS prior FROM d0 JOIN s1 USING (suffix)),
d2 AS (SELECT domain, suffix, (bad + k * prior) / (n + k) AS mean FROM d1, ({_STRENGTH} d1) AS t(k)),
h1 AS (SELECT hosts.*, mean AS prior FROM hosts JOIN d2 USING (domain, suffix)),
h2 AS (SELECT host, n, k, (bad + k * prior) / (n + k) AS mean FROM h1, ({_STRENGTH} h1) AS t(k)),
blocked AS (SELECT host FROM h2 WHERE mean - 1.645 * sqrt(mean * (1 - mean) / (n + k + 1)) > 0.5)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/en/', 'example.net/de/8', 'org/es/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract

    return extract(table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import classify

    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return classify(table(spark, sf_dir, "documents"), labels)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify
    from .quality import held_out

    found = identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("__lang_pred").alias("lang_pred"), F.col("__score").alias("score"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_groups

    _, found = near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85)
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(table(spark, sf_dir, "documents"), size=2048).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents are copied and dealt; the digest of a copy's text is taken behind the shuffle."""
    from .mixing import mix_sources

    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "source", F.col("__copy").alias("copy"), F.col("__copies").alias("n_copies"), F.col("__order").alias("order_key"),
        "lang", "n_chars", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


OP9_SQL = """
WITH rates AS (
  SELECT source, n_rows, pow(n_rows, 0.7) * sum(n_rows) OVER () / (sum(pow(n_rows, 0.7)) OVER () * n_rows) AS rate
  FROM (SELECT source, CAST(count(*) AS DOUBLE) AS n_rows FROM documents GROUP BY source)
), steps AS (
  SELECT source, k, sum(ln(rate) * k - rate - lgamma(k + 1)) AS lp
  FROM rates, range(0, 80) AS t(k) GROUP BY source, k, rate
), cdf AS (
  SELECT source, k, sum(exp(lp)) OVER (PARTITION BY source ORDER BY k) AS upto FROM steps
), drawn AS (
  SELECT row_number() OVER () AS nth, doc_id, source, lang, n_chars, sha256(coalesce(text, '')) AS text_sha256,
         CAST('0x' || substr(md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|1'), 1, 13) AS BIGINT) / pow(2, 52) AS u
  FROM documents
), counted AS (
  SELECT nth, count(*) AS n_copies
  FROM drawn d JOIN cdf c ON c.source IS NOT DISTINCT FROM d.source AND d.u >= c.upto
  GROUP BY nth
)
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy, CAST(n_copies AS INTEGER) AS n_copies,
       md5('order17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || copy) AS order_key, lang, n_chars, text_sha256
FROM (SELECT *, unnest(range(1, n_copies + 1)) AS copy FROM drawn JOIN counted USING (nth))
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_substring_dedup": op1_substring_dedup, "op2_url_filter": op2_url_filter, "op3_extract": op3_extract, "op4_quality": op4_quality, "op5_language": op5_language, "op6_minhash_dedup": op6_minhash_dedup, "op7_nearest": op7_nearest, "op8_exact_dedup": op8_exact_dedup, "op9_mix_sources": op9_mix_sources, "op10_pack": op10_pack}


def oracle_sql() -> dict[str, str]:
    return {"op2_url_filter": OP2_SQL, "op8_exact_dedup": OP8_SQL, "op9_mix_sources": OP9_SQL}
