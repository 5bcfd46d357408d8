import duckdb
import pytest

from millrace.llm import registry
from tests.llm.conftest import SF


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = registry.queries()[name](spark, SF)
    want = con.sql(registry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == sorted((tuple(r[i] for i in at) for r in want.fetchall()), key=repr)
