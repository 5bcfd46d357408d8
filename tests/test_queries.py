"""Every query with SQL against DuckDB, on the smallest tables; the others give rows."""

import duckdb
import pytest

from millrace.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.sql(registry.ORACLES[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_queries_without_sql_give_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
