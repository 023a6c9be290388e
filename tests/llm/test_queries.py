"""Queries with SQL give the SQL's rows; every query and the pipeline are registered."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from orrery.llm import queries

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    result = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in result.description]
    df = queries.queries()[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert sorted(tuple(r[c] for c in names) for r in df.collect()) == sorted(result.fetchall())


def test_registered():
    known = entry.queries()
    assert "pipeline" in known and {n.split("_")[0] for n in queries.queries()} == {f"op{i}" for i in range(1, 11)}
    assert set(entry.oracle_sql()) <= set(known)


@pytest.mark.parametrize("name", ["op2_quality_rules", "op4_source_mix", "op5_toxicity", "op6_token_planes", "op8_language_id", "op10_ring_sharding"])
def test_one_row_for_each_document(spark, name):
    df = queries.queries()[name](spark, DATA)
    ids = [r["doc_id"] for r in df.collect()]
    assert sorted(ids) == sorted(r[0] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect())
