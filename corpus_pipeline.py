"""The corpus pipeline: language ID, exact dedup, MinHash near-dedup, mixing of sources, packing.

Each stage works on all rows that its predecessor kept; all but the last return the columns of documents. Nulls,
empty tables, repeated rows and extra columns are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, table
from millrace.llm.exact_dedup import exact_dedup
from millrace.llm.langid import added_names, identify
from millrace.llm.minhash import near_dedup
from millrace.llm.mixing import mix_sources
from millrace.llm.packing import pack


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned go on; those without one (`und`: null, or no letter) are rejected."""
    pred, _ = added_names(docs)
    return identify(docs).where(F.col(pred) != "und").select([F.col(f"`{c}`") for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by shingles of five words at a similarity of 0.8 or more, the one with the least doc_id stays."""
    return near_dedup(docs, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated towards shares proportional to (rows of the source) ** 0.7; rows come in global random order."""
    return mix_sources(docs, temperature=0.7).select([F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of 2048, neighbours along the curve together: a row for each piece of a document."""
    return pack(docs, size=2048).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("minhash_dedup", near), ("mix_sources", mixing), ("pack", packing)]

#: Learned languages, sketches and tokens are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    last = None
    for name, stage in STAGES[:-1]:
        docs = scratch.cut(stage(spark, docs, sf_dir), name)
        if last:
            scratch.drop(last)
        last = name
    return STAGES[-1][1](spark, docs, sf_dir)
