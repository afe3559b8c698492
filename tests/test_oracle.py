"""Every registered query against its DuckDB oracle on the smallest fixture."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from corpusforge.plans.queries import SQL
from conftest import SF_SMALL, needs

TABLES = ("documents", "pages", "labels", "events")


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].astype(object)
    df = df.where(df.notna(), None).map(lambda v: None if v is None else str(v))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@needs(SF_SMALL)
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    assert len(got)
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _norm(got).equals(_norm(want))


def test_every_query_has_sql():
    from corpusforge.plans.queries import QUERIES

    # the learnt segmenter is tested against brute force in test_segment.py
    assert set(QUERIES) - {"segment_words"} == set(SQL)


@needs(SF_SMALL)
def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["split", "category", "n"]
    assert df.count() > 0
