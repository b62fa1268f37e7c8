"""OHLCV bars from candles or ticks."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.functions import as_date, date_parts, interval_epoch, nests, wall_clock
from barloom.schema import BAR_COLUMNS, DEFAULT_ZONE, SERIES, TIMEFRAMES, Timeframe

ROWS_OF_TASK = 250_000
VALUES = ("open", "high", "low", "close", "volume")


def ohlcv(order: str | Column = "ts") -> list[Column]:
    """The bar aggregates. Open and close are those of the first and last row, null or not."""
    return [
        F.min_by("open", order).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", order).alias("close"),
        F.sum("volume").alias("volume"),
    ]


def _row_order(tie_break: Sequence[str]) -> str | Column:
    return F.struct("ts", *tie_break) if tie_break else "ts"


def with_interval(
    rows: DataFrame, timeframe: Timeframe, zone: str = DEFAULT_ZONE
) -> DataFrame:
    """Add ``interval_start_epoch``, the start of the bucket that holds ``ts``."""
    return rows.withColumn("interval_start_epoch", interval_epoch(F.col("ts"), timeframe, zone))


def with_date_parts(bars: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Add the wall clock ``interval_start`` and its ``year``, ``month``, ``day`` strings."""
    clocked = bars.withColumn("interval_start", wall_clock(F.col("interval_start_epoch"), zone))
    return clocked.withColumns(date_parts(F.col("interval_start")))


def as_bars(aggregated: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Finish aggregates into bars with the fixed column order."""
    return with_date_parts(aggregated, zone).select(*BAR_COLUMNS)


def _aggregate(
    rows: DataFrame, timeframe: Timeframe, zone: str, tie_break: Sequence[str]
) -> DataFrame:
    return (
        with_interval(rows, timeframe, zone)
        .groupBy(*SERIES, "interval_start_epoch")
        .agg(*ohlcv(_row_order(tie_break)))
    )


def resample(
    rows: DataFrame,
    timeframe: Timeframe,
    zone: str = DEFAULT_ZONE,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Bars of one width in one aggregation, combined map-side before its only shuffle.

    ``zone`` sets the wall clock and where days begin. Rows of one series may share a ``ts``;
    name ``tie_break`` columns to fix which of them opens and closes a bar.
    """
    bars = _aggregate(rows, timeframe, zone, tie_break)
    return as_bars(bars.withColumn("timeframe", F.lit(timeframe.label)), zone)


def union_timeframes(parts: Sequence[DataFrame]) -> DataFrame:
    """Stack bars of several widths by column name; nothing is deduplicated."""
    return reduce(DataFrame.unionByName, parts)


def common_home(timeframes: Sequence[Timeframe], zone: str = DEFAULT_ZONE) -> Timeframe | None:
    """The widest width if all others nest in it, else None."""
    home = max(timeframes, key=lambda t: t.seconds)
    return home if all(nests(t, home, zone) for t in timeframes) else None


def placement_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks for the placement of ``all_timeframes`` that bound what one task aggregates, by the number of rows.

    A row becomes one of every width there, which takes many times the bytes that it was moved with.
    More rows than are placed, such as those with copies, do no harm.
    """
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / ROWS_OF_TASK))


def all_timeframes(
    rows: DataFrame,
    timeframes: Sequence[Timeframe] = TIMEFRAMES,
    zone: str = DEFAULT_ZONE,
    tie_break: Sequence[str] = (),
    unique_ts: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Bars of every width.

    If all widths nest in the widest, rows are placed once by (symbol, widest bucket) and every
    width is aggregated from that placement without another shuffle; the result then also lies
    as the bar folders do. What is placed is bounded per group: either ``unique_ts`` promises at
    most one row per series and second, as after ``dedup_latest``, or the rows are first
    combined into the narrowest bars by a map-side aggregation. Where widths do not nest, each
    row goes to its bucket of every width in one aggregation, combined before its only shuffle.

    ``partitions`` fixes the number of tasks of the placement, which adaptive execution would
    otherwise choose by size, from as many as the session has for any shuffle; see
    ``placement_tasks`` for many rows and ``sinks.folder_writers`` for many folders.
    """
    home = common_home(timeframes, zone)
    finest = min(timeframes, key=lambda t: t.seconds)
    cascades = all(nests(finest, t, zone) for t in timeframes)
    frames = F.array(*[
        F.struct(
            F.lit(t.label).alias("timeframe"),
            interval_epoch(F.col("ts"), t, zone).alias("interval_start_epoch"),
        )
        for t in timeframes
    ])
    if home is None or not (unique_ts or cascades):
        spread = rows.select(*SERIES, "ts", *tie_break, *VALUES, F.inline(frames))
        keys = (*SERIES, "timeframe", "interval_start_epoch")
        return as_bars(spread.groupBy(*keys).agg(*ohlcv(_row_order(tie_break))), zone)

    if unique_ts:
        base = rows.select(*SERIES, "ts", *VALUES)
    else:
        base = _aggregate(rows, finest, zone, tie_break).withColumnRenamed(
            "interval_start_epoch", "ts"
        )
    target = ("symbol", "_home") if partitions is None else (partitions, "symbol", "_home")
    placed = base.withColumn("_home", interval_epoch(F.col("ts"), home, zone)).repartition(*target)
    aggregated = (
        placed.select("*", F.inline(frames))
        .groupBy(*SERIES, "_home", "timeframe", "interval_start_epoch")
        .agg(*ohlcv())
    )
    return as_bars(aggregated, zone)


def on_session_date(bars: DataFrame, days: date | str | Iterable[date | str]) -> DataFrame:
    """Bars that start on one of some local dates."""
    wanted = sorted({as_date(d) for d in ([days] if isinstance(days, (date, str)) else days)})
    return bars.where(F.concat("year", "month", "day").isin([f"{d:%Y%m%d}" for d in wanted]))
