"""Every named query against its DuckDB oracle on the smallest test tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SMOKE = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item() if hasattr(v, "dtype") else v
    if isinstance(v, float):
        if math.isnan(v):
            return None
        v = round(v, 6)
        return int(v) if v.is_integer() else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(pdf):
    cols = sorted(pdf.columns)
    rows = sorted(tuple(repr(_norm(x)) for x in r) for r in pdf[cols].itertuples(index=False))
    return cols, rows


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SMOKE).toPandas()
    assert _canon(got) == _canon(duck.sql(entry.oracle_sql()[name]).df())


def test_every_survey_query_has_an_oracle():
    from wavepanel.plans import all_queries, all_sql
    assert set(all_queries()) == set(all_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
