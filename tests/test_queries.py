"""Every registered query against its SQL on the smallest folder of the given tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from fichario.catalog.inputs import TABLES

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    base = duckdb.connect()
    for t in TABLES:
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return base


def by_name(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, database, name):
    frame = queries()[name](spark, FOLDER)
    mine = by_name([tuple(r) for r in frame.collect()], frame.columns)
    if name not in oracle_sql():
        assert mine
        return
    cursor = database.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns)
    assert mine == by_name(cursor.fetchall(), names)


def test_entry(spark):
    assert entry(spark).count() > 0
