"""Text preparation on pages and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text
from .base import Registry, read, register

REGISTRY: Registry = {}

_CLEAN = r"""c AS (SELECT page_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '&[a-zA-Z#0-9]+;', ' ', 'g'), '[^a-zA-Z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))) AS cleaned FROM pages),
t AS (SELECT page_id, list_filter(string_split(cleaned, ' '), lambda w: w <> '') AS tokens FROM c)"""


def _clean(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", text.clean(F.col("html")).alias("cleaned"))


def _tokens(spark, sf_dir):
    return _clean(spark, sf_dir).select("page_id", text.tokenize(F.col("cleaned")).alias("tokens"))


@register(REGISTRY, f"WITH {_CLEAN} SELECT * FROM c")
def text_clean(spark, sf_dir):
    return _clean(spark, sf_dir)


_STOP = ", ".join(f"'{w}'" for w in text.STOP_WORDS)


@register(REGISTRY, f"WITH {_CLEAN} SELECT page_id, len(tokens) AS n_tokens, len(list_filter(tokens, lambda w: w NOT IN ({_STOP}))) AS n_kept FROM t")
def tokenize_stopword(spark, sf_dir):
    return _tokens(spark, sf_dir).select("page_id", F.size("tokens").cast("long").alias("n_tokens"), F.size(text.without_stop_words(F.col("tokens"))).cast("long").alias("n_kept"))


_VOCAB = f"{_CLEAN}, v AS (SELECT token, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, token) + 1 AS INTEGER) AS id FROM (SELECT unnest(tokens) AS token FROM t) GROUP BY token QUALIFY id <= 501)"


@register(REGISTRY, f"WITH {_VOCAB} SELECT * FROM v")
def vocab_encode(spark, sf_dir):
    return text.vocabulary(_tokens(spark, sf_dir), "tokens", 500)


@register(REGISTRY, f"""WITH {_VOCAB}, f AS (SELECT page_id, unnest(range(1, 33)) AS pos, tokens FROM t)
SELECT page_id, string_agg(CAST(CASE WHEN pos > len(tokens) THEN 0 ELSE coalesce(id, 1) END AS VARCHAR), ',' ORDER BY pos) AS ids FROM f LEFT JOIN v ON v.token = f.tokens[pos] GROUP BY page_id""")
def pad_sequences(spark, sf_dir):
    tokens = _tokens(spark, sf_dir)
    encoded = text.encode(tokens, "page_id", "tokens", text.vocabulary(tokens, "tokens", 500), 32)
    return encoded.select("page_id", F.concat_ws(",", F.transform("ids", lambda i: i.cast("string"))).alias("ids"))


@register(REGISTRY, "WITH w AS (SELECT p_partkey, '<' || lower(p_brand) || '>' AS m FROM part) SELECT p_partkey, array_to_string(list_transform(range(1, length(m) - 1), lambda i: substr(m, i, 3)), ' ') AS grams FROM w")
def char_ngrams(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.concat_ws(" ", text.char_ngrams(F.lower("p_brand"))).alias("grams"))


@register(REGISTRY, f"WITH {_CLEAN} SELECT page_id, token, count(*) AS n FROM (SELECT page_id, unnest(tokens) AS token FROM t) GROUP BY ALL")
def word_counts(spark, sf_dir):
    return text.word_counts(_tokens(spark, sf_dir), "page_id", "tokens")
