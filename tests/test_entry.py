"""The driver contract, and every registered query with SQL against DuckDB."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from kithlink.plans import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _rows(columns, rows):
    clean = lambda v: round(v, 5) if isinstance(v, float) and not math.isnan(v) else v
    return sorted((tuple(clean(v) for _, v in sorted(zip(columns, r))) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    want = db.sql(catalog.oracle_sql()[name])
    got = entry.queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got.columns, map(tuple, got.collect())) == _rows(want.columns, want.fetchall())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
