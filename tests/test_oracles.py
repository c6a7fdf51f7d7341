"""Every registered query against its SQL in DuckDB."""

import os
import sys

import duckdb
import pytest

from tidewright import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{p if os.path.isfile(p) else p + '/*.parquet'}')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, sf, duck, name):
    frame = catalog.QUERIES[name](spark, sf)
    columns = sorted(frame.columns)
    found = duck.execute(catalog.ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == columns
    expected = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in found.fetchall())
    assert sorted(repr(tuple(r)) for r in frame.select(*columns).collect()) == expected


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert not any(m.startswith("tidewright.llm") for m in sys.modules) or "op1_sentencepiece_dropout" in entry.queries()
