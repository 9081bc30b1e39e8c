import os

import duckdb
import pandas as pd
import pytest

from chartloom.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations"


def shape(df):
    df = df[sorted(df.columns)]
    return sorted(str([None if pd.isna(x) else round(x, 6) if isinstance(x, float) else str(x)[:10] if hasattr(x, "year") else x for x in r]) for r in df.astype(object).values.tolist())


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = catalog.queries()[name](spark, SF).toPandas(), con.sql(catalog.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert shape(got) == shape(want)


def test_every_query_but_descriptions_has_an_oracle():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == {"schema_describe"}
