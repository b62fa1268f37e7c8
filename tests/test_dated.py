"""Bars by width and date: folders, pruning, row groups that are skipped."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from barloom import operators as op, sinks, sources
from barloom.plans.day_job import aggregate_day
from barloom.schema import DEFAULT_EXCHANGE
from barloom.sources.dated import month_folders

from test_files import B, candle, land, triples

B_DAY = 1736101800  # 2025-01-06 00:00 IST


@pytest.fixture
def bars(spark):
    """Two local days of 300 series, a candle every five minutes."""
    rows = spark.range(300 * 576).select(
        F.format_string("S%03d", F.col("id") % 300).alias("symbol"), F.lit(DEFAULT_EXCHANGE).alias("exchange"),
        (F.lit(B_DAY) + F.floor(F.col("id") / 300) * 300).alias("ts"),
        *[(F.col("id") % 97).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    return op.all_timeframes(rows, unique_ts=True)


def scanned_rows(frame):
    """Rows that the Parquet scan handed on, and files it opened, as its metrics say."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    leaves = (plan.executedPlan() if plan.getClass().getSimpleName().startswith("Adaptive") else plan).collectLeaves()
    metrics = leaves.head().metrics()
    return metrics.apply("numOutputRows").value(), metrics.apply("numFiles").value()


def test_four_folders_a_day(spark, bars, tmp_path):
    out = tmp_path / "bars"
    sinks.write_dated_bars(bars, str(out))
    folders = sorted(f"{p.parent.name}/{p.name}" for p in out.glob("timeframe=*/date=*"))
    assert folders == [f"timeframe={t}/date=2025-01-0{d}" for t in ("15m", "1d", "1m", "5m") for d in (6, 7)]
    columns = bars.columns
    found = sources.read_dated_bars(spark, str(out))
    assert found.columns == columns
    assert found.exceptAll(bars).isEmpty() and bars.exceptAll(found).isEmpty()
    assert all(".snappy." in p.name for p in out.rglob("*.parquet"))


def test_row_groups_and_folders_are_skipped(spark, bars, tmp_path):
    out = str(tmp_path / "bars")
    sinks.write_dated_bars(bars, out, files=4, row_group_bytes=32_768)
    all_rows, all_files = scanned_rows(sources.read_dated_bars(spark, out))
    assert all_rows == bars.count()
    one = sources.read_dated_bars(spark, out, timeframe="1m", start="2025-01-06", end="2025-01-06", symbols=["S123"])
    rows, files = scanned_rows(one)
    assert one.count() == 288 and files < all_files
    assert rows < 300 * 288 / 10, "row groups of other symbols are not read"
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(timeframe" in plan and "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,S123)]" in plan
    assert sources.read_dated_bars(spark, out, symbols=["S1234"]).count() == 0


def test_ranges(spark, bars, tmp_path):
    out = str(tmp_path / "bars")
    sinks.write_dated_bars(bars.where("timeframe = '1d'"), out)
    read = sources.read_dated_bars
    assert read(spark, out, start="2025-01-07").count() == read(spark, out, end=date(2025, 1, 6)).count() == 300
    assert read(spark, out, timeframe="1d", start="2024-12-31", end="2025-01-06").count() == 300
    assert read(spark, out, start="2025-01-08", end="2025-01-01").count() == read(spark, out, symbols=[]).count() == 0
    assert read(spark, out, timeframe="5m").count() == read(spark, out, exchange="BSE").count() == 0
    read(spark, out, view="dated").count()
    assert spark.sql("select count(distinct symbol) n from dated").first().n == 300
    assert month_folders(date(2024, 11, 30), date(2025, 1, 1)) == ["date=2024-11-*", "date=2024-12-*", "date=2025-01-*"]
    with pytest.raises(ValueError, match="append"):
        sinks.write_dated_bars(bars, out, mode="append")


def test_day_job_in_either_layout(spark, tmp_path):
    raw = tmp_path / "raw"
    for symbol in "AB":
        land(raw, f"NSE_{symbol}-EQ", "v1", {"candles": [candle(B + 60 * i, 100 + i) for i in range(30)]})
    reports = [aggregate_day(spark, str(raw), str(tmp_path / layout), "2025-01-06", layout=layout) for layout in ("series", "dated")]
    assert reports[0] == reports[1] and reports[0].candles == 60
    series, dated = sources.read_bars(spark, str(tmp_path / "series")), sources.read_dated_bars(spark, str(tmp_path / "dated"))
    assert triples(series, *series.columns) == triples(dated, *series.columns)
    with pytest.raises(ValueError, match="flat"):
        aggregate_day(spark, str(raw), str(tmp_path / "flat"), "2025-01-06", layout="flat")
