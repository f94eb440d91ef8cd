"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

CHECKED = sorted(entry.oracle_sql())
UNCHECKED = sorted(set(entry.queries()) - set(CHECKED))


@pytest.fixture(scope="module")
def engine(sf):
    con = duckdb.connect()
    for file in os.listdir(sf):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf}/{file}'")
    return con


def ordered(rows):
    same = lambda v: round(v, 12) if isinstance(v, float) else v
    return sorted((tuple(same(v) for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, sf, engine, name):
    df = entry.queries()[name](spark, sf)
    columns = sorted(df.columns)
    found = engine.sql(entry.oracle_sql()[name])
    assert sorted(found.columns) == columns
    want = found.project(", ".join(f'"{c}"' for c in columns)).fetchall()
    got = [tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect()]
    assert ordered(got) == ordered(want)
    assert len(got) > 0


@pytest.mark.parametrize("name", UNCHECKED)
def test_query_without_sql_runs(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 49
