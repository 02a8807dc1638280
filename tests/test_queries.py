"""Each query with SQL gives what DuckDB gives for it, on the smallest tables."""

import datetime
import math

import duckdb
import pandas as pd
import pytest

from corpusmill import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if v is None or v is pd.NaT or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return round(v, 6)
    return str(pd.Timestamp(v).tz_localize(None)) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=key)
    q = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in q.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in q.fetchall()), key=key)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_other_queries_give_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0
