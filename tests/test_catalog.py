"""Every registered query of the library against its SQL in DuckDB, on the smallest tables."""

import decimal
import os

import duckdb
import pytest

from millrace import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, float | decimal.Decimal):
        return f"{float(value):.9g}"
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    return repr(value)


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return connection


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, oracle, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted([plain(r[c]) for c in columns] for r in df.collect())
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    found = oracle.sql(sql)
    assert sorted(found.columns) == columns
    order = [found.columns.index(c) for c in columns]
    assert got == sorted([plain(r[i]) for i in order] for r in found.fetchall())
