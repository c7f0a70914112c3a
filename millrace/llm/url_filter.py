"""URL filter: explicit rules, else the empirical-Bayes reputation of the host (DataFrame functions only).

Labelled pages are good or bad. The bad share of a host is shrunk towards that of its registered domain, that one's
towards its suffix's, and that one's towards the corpus's: each level's prior is a beta distribution with the
parent's posterior mean, and a strength estimated at that level by the method of moments of the beta-binomial. A
host is blocked if the lower bound of its bad share, z posterior standard deviations below the mean, exceeds the limit.

Host: after the first :// up to /, ? or #, with A-Z lower-cased; path: then up to ? or #. Nulls and urls without
:// have an empty host and path, match no rule and are allowed. A host without labelled pages is judged by nothing but
its priors, which cannot exceed the limit unless its domain's do. Repeated rows are judged alike; each labelled row
counts. Null labels do not count. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch

#: (verdict, host and path prefix). The longest that fits wins.
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]
#: Suffixes of two labels under which names are registered; one label otherwise.
TWO_LABEL_SUFFIXES = ["ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "com.tw", "gov.uk", "ne.jp", "or.jp", "org.au", "org.uk"]
#: Blocked hosts are broadcast up to this many, else joined by shuffle.
BROADCAST_HOSTS = 100_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; nulls if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame) -> DataFrame:
    """The prior strength below each level: alpha + beta by moments, between 1 and 10,000."""
    p = F.col("bad") / F.col("n")
    mu = F.col("prior")
    stats = groups.agg(F.sum(F.col("n") * (p - mu) * (p - mu)).alias("s"), F.sum(mu * (1 - mu)).alias("v"), F.sum(F.col("n") * mu * (1 - mu)).alias("w"))
    # E[sum n (p - mu)^2] = sum v (1 + (n - 1) / (k + 1)), with v = mu (1 - mu).
    k = F.try_divide(F.col("w") - F.col("v"), F.col("s") - F.col("v")) - 1
    return stats.select(F.least(F.lit(10000.0), F.greatest(F.lit(1.0), F.when(F.col("s") > F.col("v"), k).otherwise(10000.0))).alias("k"))


def _shrunk(groups: DataFrame) -> DataFrame:
    """Adds the posterior mean of groups that have n, bad and prior."""
    k = F.broadcast(_strength(groups))
    return groups.crossJoin(k).withColumn("mean", (F.col("bad") + F.col("k") * F.col("prior")) / (F.col("n") + F.col("k")))


def host_reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """Of labelled outcomes (host, bad as 0 or 1): host, n, mean, lower - the posterior of the host's bad share."""
    scratch = Scratch(outcomes.sparkSession, "urls")
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("bad")).where("n > 0")
    # Every level is read more than once (its strength, its means), so each is written.
    hosts = scratch.cut(hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg((F.sum("bad") / F.sum("n")).alias("prior"))
    suffixes = _shrunk(scratch.cut(suffixes.crossJoin(F.broadcast(whole)), "suffixes"))
    domains = _shrunk(scratch.cut(domains.join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix"), "domains"))
    hosts = _shrunk(scratch.cut(hosts.join(domains.select("domain", "suffix", F.col("mean").alias("prior")), ["domain", "suffix"]), "priors"))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("k") + 1))
    return hosts.select("host", "n", "mean", (F.col("mean") - F.lit(z) * sd).alias("lower"))


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, page_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str]] = RULES, limit: float = 0.5, z: float = 1.645
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict. `outcomes` has the page id and bad (0 or 1) of labelled pages."""
    host, path = host_and_path(F.col(f"`{url_col}`").cast("string"))
    judged = pages.select(F.col(f"`{page_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = judged.withColumn("rule", rule).withColumn("said", verdict)
    labelled = judged.select("page_id", "host").join(outcomes.select(F.col(f"`{page_col}`").alias("page_id"), "bad"), "page_id")
    blocked = host_reputation(labelled.where("host <> ''"), z).where(F.col("lower") > limit).select("host", F.lit("block").alias("method"))
    few = blocked.limit(BROADCAST_HOSTS + 1).count() <= BROADCAST_HOSTS
    told = judged.join(F.broadcast(blocked) if few else blocked, "host", "left")
    return told.select("page_id", "host", "path", "rule", F.coalesce("said", "method", F.lit("allow")).alias("verdict"))
