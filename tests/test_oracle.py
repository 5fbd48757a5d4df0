"""Every query of the catalogue against its SQL on the same tables."""

import math

import duckdb
import pytest

from lexgrid.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "-"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return str(round(v, 6))
    return str(v)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, sf, duck, name):
    df = catalog.queries()[name](spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert df.columns
        return
    found = duck.execute(sql)
    assert got == rows([c[0] for c in found.description], found.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
