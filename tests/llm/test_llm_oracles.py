"""Registered queries against their DuckDB SQL on whole small tables."""

import duckdb
import pandas as pd
import pytest

from corpusforge.llm import queries, sql

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "conversations", "embeddings", "benchmark")


def norm(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)].astype(object)
    rows = df.where(df.notna(), None).itertuples(index=False)
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got, want = queries.QUERIES[name](spark, SF).toPandas(), duck.execute(sql.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert norm(got) == norm(want)


def test_every_operator_has_a_query():
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES if q.startswith("op")}
    assert "pipeline" in queries.QUERIES
