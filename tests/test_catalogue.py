"""Every catalogue query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from framewright.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(tuple, df[cols].astype(str).values.tolist())), cols


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_sql(spark, con, name):
    got, cols = rows(catalogue.QUERIES[name](spark, SF).toPandas())
    want, wanted = rows(con.execute(catalogue.ORACLE_SQL[name]).df())
    assert cols == wanted
    assert got == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["video", "lr_frame", "lr_ts", "hr_frame", "hr_ts", "score"]
    assert set(e.oracle_sql()) <= set(e.queries())
