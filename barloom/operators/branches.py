"""The parts of a bar as separate steps: windows, first-row filters and joins.

``bars.resample`` gives the same bars from one aggregation and is the one to use. These steps
are for when only one of them is wanted. A rank-1 filter is pushed before the shuffle by
Spark, and every step is keyed alike, so the joins find their sides already placed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.functions import interval_epoch
from barloom.operators.bars import VALUES, as_bars, common_home, with_interval
from barloom.schema import DAY_SECONDS, DEFAULT_ZONE, SERIES, Timeframe

BUCKET = (*SERIES, "interval_start_epoch")


def row_numbers(
    rows: DataFrame, keys: Sequence[str] = BUCKET, order: Sequence[str | Column] = ("ts",)
) -> DataFrame:
    """Number the rows of each key group as ``rn``, from 1."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def first_of_group(
    rows: DataFrame, keys: Sequence[str] = BUCKET, order: Sequence[str | Column] = ("ts",)
) -> DataFrame:
    """The first row of each key group."""
    return row_numbers(rows, keys, order).where("rn = 1").drop("rn")


def bucket_opens(rows: DataFrame, tie_break: Sequence[str] = (), keys: Sequence[str] = BUCKET) -> DataFrame:
    firsts = first_of_group(rows, keys, order=["ts", *tie_break])
    return firsts.select(*keys, "open")


def bucket_closes(rows: DataFrame, tie_break: Sequence[str] = (), keys: Sequence[str] = BUCKET) -> DataFrame:
    lasts = first_of_group(rows, keys, order=[F.desc(c) for c in ("ts", *tie_break)])
    return lasts.select(*keys, "close")


def bucket_aggregates(rows: DataFrame, keys: Sequence[str] = BUCKET) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.max("high").alias("high"), F.min("low").alias("low"), F.sum("volume").alias("volume")
    )


def attach(aggregates: DataFrame, values: DataFrame, keys: Sequence[str] = BUCKET) -> DataFrame:
    """Left equi-join of one value per bucket onto the aggregates."""
    return aggregates.join(values, list(keys), "left")


def home_keys(home: Timeframe, zone: str = DEFAULT_ZONE) -> dict[str, Column]:
    """The symbol and ``_home``, the start of the bucket of ``home``: rows that lie by them have those of a narrower bucket together."""
    return {"symbol": F.col("symbol"), "_home": interval_epoch(F.col("ts"), home, zone)}


def resample_by_joins(
    rows: DataFrame,
    timeframe: Timeframe,
    zone: str = DEFAULT_ZONE,
    tie_break: Sequence[str] = (),
    unique_ts: bool = False,
    home: Timeframe | None = None,
) -> DataFrame:
    """The bars of ``bars.resample``, put together from three branches and two joins.

    ``unique_ts`` promises at most one row per series and second, as after ``dedup_latest``. Rows are
    then placed by (symbol, local day) before the branches, which find them there. Without the
    promise each branch is reduced first.

    Rows that have the ``home_keys`` of ``home`` and lie by them are not moved before the branches, so bars of several widths share
    their place. The joins too find their sides there in a plan of
    ``session.joined_in_place``; otherwise Spark moves both sides to lie by all keys.
    """
    keys = BUCKET
    if home is not None and common_home((timeframe, home), zone) != home:
        raise ValueError(f"{timeframe.label} does not nest in {home.label}")
    if unique_ts and home is None:
        home = common_home((timeframe, Timeframe("1d", DAY_SECONDS)), zone) or timeframe
        rows = rows.select(*SERIES, "ts", *VALUES).withColumns(home_keys(home, zone)).repartition("symbol", "_home")
    if home is not None:
        keys = ("interval_start_epoch", "_home", *SERIES)
    bucketed = with_interval(rows, timeframe, zone)
    bars = attach(bucket_aggregates(bucketed, keys), bucket_opens(bucketed, tie_break, keys), keys)
    bars = attach(bars, bucket_closes(bucketed, tie_break, keys), keys)
    return as_bars(bars.withColumn("timeframe", F.lit(timeframe.label)), zone)
