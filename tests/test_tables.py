"""Bars by SQL: tables that know their partitions, functions that prune them."""

import uuid

import pytest

from barloom import operators as op, sinks, sources
from barloom.schema import BAR_COLUMNS
from test_dated import bars  # noqa: F401
from test_files import triples


@pytest.fixture
def table(spark):
    name = f"bars_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"drop table if exists {name}")


def test_sql_equals_the_scan(spark, bars, tmp_path, table):  # noqa: F811
    out = str(tmp_path / "it's bars")
    sinks.write_dated_bars(bars, out)
    assert sources.create_bar_table(spark, table, out) == 8
    between, of = sources.create_bar_functions(spark, table, "known")
    one = spark.sql(f"select * from {of}('S123', '5m', date'2025-01-06', date'2025-01-06')")
    expected = sources.read_dated_bars(spark, out, timeframe="5m", symbols=["S123"], start="2025-01-06", end="2025-01-06")
    assert one.columns == list(BAR_COLUMNS)
    assert triples(one, *BAR_COLUMNS) == triples(expected, *BAR_COLUMNS) and one.count() == 288
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(timeframe" in plan and "EqualTo(symbol,S123)" in plan
    assert "InMemoryFileIndex(1 paths)" in plan, "the catalog lists the one folder asked for"
    assert spark.sql(f"select count(*) n from {between}('1d', date'2025-01-01', date'2025-12-31')").first().n == 600


def test_later_writes_and_dropped_dates(spark, bars, tmp_path, table):  # noqa: F811
    out = str(tmp_path / "bars")
    sinks.write_dated_bars(op.on_session_date(bars, "2025-01-06"), out)
    assert sources.create_bar_table(spark, table, out) == 4
    sinks.write_dated_bars(op.on_session_date(bars, "2025-01-07"), out)
    assert spark.table(table).select("date").distinct().count() == 1, "not registered yet"
    assert sources.sync_bar_table(spark, table) == 8
    assert spark.table(table).count() == bars.count()
    sinks.write_dated_bars(op.on_session_date(bars, "2025-01-07"), out, mode="static")
    assert sources.sync_bar_table(spark, table) == 4
    assert sources.create_bar_table(spark, table, out, replace=True) == 4
    with pytest.raises(ValueError, match="drop"):
        sources.create_bar_table(spark, "x; drop table y", out)
