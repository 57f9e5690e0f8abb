"""Queries that SQL can express, against DuckDB; and that every one is there."""

import duckdb
import pytest

import __spark_entry__ as E
from cofreq.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def test_all_operators_and_the_pipeline_are_registered():
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries() and set(names) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(res.fetchall()) == sorted(tuple(r) for r in df.select(*cols).collect())
