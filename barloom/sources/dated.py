"""Scan of bars that lie by width and date."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.functions import as_date
from barloom.schema import BAR_COLUMNS, DATED_BAR
from barloom.sources.files import empty_frame, load_matching


def month_folders(first: date | None, last: date | None) -> list[str]:
    """Globs of the date folders of a range: by month if both ends are given, else all."""
    if not (first and last):
        return ["date=*"]
    months = range(first.year * 12 + first.month - 1, last.year * 12 + last.month)
    return [f"date={m // 12:04d}-{m % 12 + 1:02d}-*" for m in months]


def dated_columns(bars: DataFrame) -> DataFrame:
    """The columns of bars, date strings included, from those of the layout."""
    parts = {name: F.substring("date", *at) for name, at in (("year", (1, 4)), ("month", (6, 2)), ("day", (9, 2)))}
    return bars.withColumns(parts).select(*BAR_COLUMNS)


def read_dated_bars(
    spark: SparkSession,
    base: str,
    *,
    timeframe: str | None = None,
    exchange: str | None = None,
    symbols: Iterable[str] | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
    view: str | None = None,
) -> DataFrame:
    """Bars written by ``write_dated_bars``; dates are local and inclusive.

    Width and dates prune folders. Exchange and symbols are pushed down to Parquet, where row groups
    are skipped by their statistics and Bloom filters. ``view`` registers the result for SQL.
    """
    first = None if start is None else as_date(start)
    last = None if end is None else as_date(end)
    wanted = None if symbols is None else sorted(set(symbols))
    if wanted == [] or (first and last and first > last):
        found = None
    else:
        width = "*" if timeframe is None else timeframe
        narrowed = timeframe is not None or (first and last)
        patterns = [f"timeframe={width}/{folder}" for folder in month_folders(first, last)] if narrowed else []
        found = load_matching(spark, spark.read.schema(DATED_BAR), "parquet", base, patterns)
    if found is None:
        found = empty_frame(spark, DATED_BAR)
    for name, value in (("timeframe", timeframe), ("exchange", exchange)):
        if value is not None:
            found = found.where(F.col(name) == value)
    if wanted is not None:
        found = found.where(F.col("symbol").isin(wanted))
    if first:
        found = found.where(F.col("date") >= f"{first:%Y-%m-%d}")
    if last:
        found = found.where(F.col("date") <= f"{last:%Y-%m-%d}")
    bars = dated_columns(found)
    if view:
        bars.createOrReplaceTempView(view)
    return bars
