"""Every query with SQL gives the SQL's rows on the smallest tables."""

import math
import os

import duckdb
import pytest

from orrery.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return f"{float(value):.4f}".replace("-0.0000", "0.0000")
    return str(value)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, duck, name):
    df = catalog.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    ours = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in result.description]
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert sorted(names) == columns
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, DATA).count() > 0
