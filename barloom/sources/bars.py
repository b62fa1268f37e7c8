"""Scan of written bars."""

from __future__ import annotations

import re
from calendar import monthrange
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.functions import as_date
from barloom.schema import BAR, BAR_COLUMNS, BAR_PARTITIONS
from barloom.sources.files import empty_frame, load_matching

_PLAIN_NAME = re.compile(r"[A-Za-z0-9_.&-]+")  # the same in a folder name as in the value
_SYMBOLS_IN_A_GLOB = 500  # a longer list becomes several globs


def _any_of(values: Iterable[str]) -> str:
    names = sorted(set(values))
    return names[0] if len(names) == 1 else "{" + ",".join(names) + "}"


def _later_numbers(number: str) -> list[str]:
    """Globs of all numbers of as many digits that are larger."""
    return [
        number[:i] + (f"[{int(d) + 1}-9]" if d < "8" else "9") + "?" * (len(number) - i - 1)
        for i, d in enumerate(number) if d < "9"
    ]


def _earlier_numbers(number: str) -> list[str]:
    return [
        number[:i] + (f"[0-{int(d) - 1}]" if d > "1" else "0") + "?" * (len(number) - i - 1)
        for i, d in enumerate(number) if d > "0"
    ]


def _month_days(year: int, month: int, first: int, last: int) -> str:
    """One month's folder, or those of some of its days."""
    folder = f"year={year:04d}/month={month:02d}"
    if first == 1 and last == monthrange(year, month)[1]:
        return folder
    return f"{folder}/day={_any_of(f'{d:02d}' for d in range(first, last + 1))}"


def date_folders(first: date | None, last: date | None) -> list[str]:
    """Globs of the date folders of a range, either end open: whole years, months, then days."""
    if first and last and first.year == last.year:
        return [
            _month_days(
                first.year, month, first.day if month == first.month else 1,
                last.day if month == last.month else monthrange(first.year, month)[1],
            )
            for month in range(first.month, last.month + 1)
        ]
    found = []
    if first:
        found += date_folders(first, date(first.year, 12, 31))
    if first and last:
        found += [f"year={y:04d}" for y in range(first.year + 1, last.year)]
    elif first:
        found += [f"year={y}" for y in _later_numbers(f"{first.year:04d}")]
    elif last:
        found += [f"year={y}" for y in _earlier_numbers(f"{last.year:04d}")]
    if last:
        found += date_folders(date(last.year, 1, 1), last)
    return found


def _folder_patterns(wanted: dict[str, list[str]], first: date | None, last: date | None) -> list[str]:
    """Globs of the partition folders, down to the last level that is narrowed."""
    names = BAR_PARTITIONS[:3]
    plain = {
        name: values for name, values in wanted.items() if all(map(_PLAIN_NAME.fullmatch, values))
    }
    if not plain and not (first or last):
        return []
    symbols = plain.pop("symbol", [])
    parts = [symbols[i : i + _SYMBOLS_IN_A_GLOB] for i in range(0, len(symbols), _SYMBOLS_IN_A_GLOB)]
    dates = date_folders(first, last)
    depth = 3 if symbols or dates else 1 + max(names.index(n) for n in plain)
    found = []
    for some in parts or [[]]:
        values = plain | ({"symbol": some} if some else {})
        series = "/".join(f"{n}={_any_of(values[n]) if n in values else '*'}" for n in names[:depth])
        found += [f"{series}/{folder}" for folder in dates] or [series]
    return found


def read_bars(
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
    """Bars of a folder, pruned by partition; dates are local and inclusive.

    Every argument is a filter on partition columns, so unwanted files are never opened, and a
    set of globs, so that unwanted folders are never listed either: one day of a long archive
    costs the listing of that day, and a list of symbols that of those symbols, however many.
    ``view`` registers the result for SQL.
    """
    wanted = {
        "timeframe": None if timeframe is None else [timeframe],
        "exchange": None if exchange is None else [exchange],
        "symbol": None if symbols is None else sorted(set(symbols)),
    }
    wanted = {name: values for name, values in wanted.items() if values is not None}
    first = None if start is None else as_date(start)
    last = None if end is None else as_date(end)
    if any(not values for values in wanted.values()) or (first and last and first > last):
        bars = None
    else:
        patterns = _folder_patterns(wanted, first, last)
        bars = load_matching(spark, spark.read.schema(BAR), "parquet", base, patterns)
    if bars is None:
        bars = empty_frame(spark, BAR)
    for name, values in wanted.items():
        bars = bars.where(F.col(name).isin(values))
    local_day = F.concat("year", "month", "day")
    if first:
        bars = bars.where(local_day >= f"{first:%Y%m%d}")
    if last:
        bars = bars.where(local_day <= f"{last:%Y%m%d}")
    bars = bars.select(*BAR_COLUMNS)
    if view:
        bars.createOrReplaceTempView(view)
    return bars
