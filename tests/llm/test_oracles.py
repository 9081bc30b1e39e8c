import os

import duckdb
import pytest

from chartloom.llm import queries

TABLES = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")
@pytest.mark.parametrize("name", queries.oracle_sql())
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{TABLES}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, TABLES)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(str, map(tuple, got.select(*want.columns).collect()))) == sorted(map(str, want.fetchall()))
