"""Every registered query with SQL gives the same rows as DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from cellpulse.catalog import ORACLES, QUERIES


def cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, float):
        return repr(value + 0.0)
    return str(value)


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="session")
def db(sf):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[:-8]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    cursor = db.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert canon([tuple(r) for r in df.collect()], df.columns) == canon(cursor.fetchall(), names)
