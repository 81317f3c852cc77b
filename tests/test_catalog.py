from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from tempora import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rel = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in rel.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_sql_runs(spark, name):
    assert catalog.queries()[name](spark, SF).columns


def test_entry(spark):
    assert entry.entry(spark).count() > 0
