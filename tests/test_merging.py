import duckdb

from millrace.plans import registry


def test_lines_of_equal_page_keep_the_order_of_the_file(spark, tmp_path):
    con = duckdb.connect()
    con.execute("SET threads = 1")
    con.execute("CREATE TABLE lineitem AS SELECT (i % 500)::BIGINT AS l_orderkey, (1 + i // 1000)::INTEGER AS l_linenumber, 7::BIGINT AS l_partkey, CASE WHEN hash(i) % 2 = 0 THEN 'F' ELSE 'O' END AS l_linestatus FROM range(3000) t(i) ORDER BY i")
    con.execute(f"COPY lineitem TO '{tmp_path}/lineitem.parquet'")
    got = registry.QUERIES["page_merge"](spark, str(tmp_path)).select("l_orderkey", "first", "declared", "differ").collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(f"SELECT l_orderkey, first, declared, differ FROM ({registry.ORACLES['page_merge']})").fetchall())
    assert len(got) == 500


def test_orders_lines_and_parts_that_are_null_as_in_sql(spark, tmp_path):
    con = duckdb.connect()
    con.execute("CREATE TABLE lineitem (l_orderkey BIGINT, l_linenumber INTEGER, l_partkey BIGINT, l_linestatus VARCHAR)")
    con.execute("INSERT INTO lineitem VALUES (1, 1, 1, NULL), (1, 1, 2, 'F'), (2, 1, NULL, 'O'), (2, 2, 5, 'F'), (3, 1, 1, NULL), (4, NULL, 3, 'F'), (5, NULL, 3, 'F'), (5, 3, 3, 'O'), (NULL, 1, 1, 'F'), (NULL, 2, 1, 'O'), (6, 2, NULL, 'O'), (6, 1, 1, 'F'), (6, 2, 9, NULL), (7, 1, 4, 'F'), (7, 2, 1, 'O')")
    con.execute(f"COPY lineitem TO '{tmp_path}/lineitem.parquet'")
    got = registry.queries()["page_merge"](spark, str(tmp_path)).select("l_orderkey", "first", "declared", "differ").collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(con.sql(f"SELECT l_orderkey, first, declared, differ FROM ({registry.oracle_sql()['page_merge']})").fetchall(), key=key)
    assert len(got) == 8
