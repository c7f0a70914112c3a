"""The registered corpus queries on the smallest tables: contract columns, and SQL where there is some."""

import os

import duckdb
import pytest

from millrace.llm import queries as llm

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op2_url_filter": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op3_extract": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op4_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_language": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6_minhash_dedup": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op7_nearest": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "double"},
    "op8_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
    "op10_pack": {"doc_id": "bigint", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "doc_tokens": "bigint", "sequence_id": "bigint", "offset": "bigint"},
}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.mark.parametrize("name", sorted(llm.queries()))
def test_query(spark, name):
    df = llm.queries()[name](spark, SF)
    kinds = dict(df.dtypes)
    assert {c: kinds[c] for c in COLUMNS.get(name, {})} == COLUMNS.get(name, {})
    got = sorted(repr([r[c] for c in sorted(kinds)]) for r in df.collect())
    if sql := llm.oracle_sql().get(name):
        connection = duckdb.connect()
        for t in ("documents", "pages", "labels"):
            connection.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
        found = connection.sql(sql)
        order = [found.columns.index(c) for c in sorted(kinds)]
        assert got == sorted(repr([r[i] for i in order]) for r in found.fetchall())
    else:
        assert got
