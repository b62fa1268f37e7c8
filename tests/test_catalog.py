"""Every registered query against the same query in SQL, value for value."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from barloom.plans import catalog

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(float(value)) if isinstance(value, (int, float)) else str(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(names)
    expected = canonical(names, result.fetchall())
    assert expected, "a check on no rows shows nothing"
    assert canonical(frame.columns, [tuple(r) for r in frame.collect()]) == expected


def test_entry(spark):
    assert entry.entry(spark).count() > 0
