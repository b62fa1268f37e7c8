"""From landed documents to clean one-row-per-minute candles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StringType

from barloom.functions import as_date, day_bounds, interval_epoch, wall_clock
from barloom.schema import (
    CANDLE_FIELDS, CANDLE_KEY, CANDLE_VERSION, DEFAULT_ZONE, ENVELOPE, TS_RANGE, Timeframe,
)

JSON_NUMBER = r"^-?(0|[1-9][0-9]*)(\.[0-9]+)?([eE][+-]?[0-9]+)?$"


def nested_candles(raw: DataFrame) -> DataFrame:
    """Lift the candle array out of the envelope."""
    return raw.select(
        "symbol", "exchange", "ingest_ts", F.col(f"{ENVELOPE}.candles").alias("candles")
    )


def with_candles(documents: DataFrame) -> DataFrame:
    """Documents whose candle array is there and not empty."""
    return documents.where(F.col("candles").isNotNull() & (F.size("candles") > 0))


def explode_candles(documents: DataFrame) -> DataFrame:
    """One row per candle, with its position in the document."""
    return documents.select(
        "symbol", "exchange", "ingest_ts", F.posexplode("candles").alias("pos", "candle")
    )


def complete_candles(exploded: DataFrame) -> DataFrame:
    """Candles with all six elements; more are allowed and ignored."""
    return exploded.where(F.size("candle") >= len(CANDLE_FIELDS))


def element(position: int, type_name: str, text: bool = False) -> Column:
    """An element by position. Of one held as text only the number form of JSON counts."""
    value = F.get("candle", F.lit(position))
    if text:  # the cast alone would take 7d or 0x1p3 for numbers
        value = F.when(value.rlike(JSON_NUMBER), value)
    return value.try_cast(type_name)


def candle_fields(exploded: DataFrame) -> DataFrame:
    """Name and type the elements: ``ts`` as whole epoch seconds, the rest as double.

    A ``ts`` no calendar can show, such as one in microseconds, becomes null.
    """
    ts, *values = CANDLE_FIELDS
    text = isinstance(exploded.schema["candle"].dataType.elementType, StringType)
    # via double: the element may be text such as 1.7361351E9
    seconds = element(0, "double", text).try_cast("bigint")
    return exploded.select(
        *[c for c in exploded.columns if c != "candle"],
        F.when(seconds.between(*TS_RANGE), seconds).alias(ts),
        *[element(i, "double", text).alias(name) for i, name in enumerate(values, start=1)],
    )


def with_wall_clock(candles: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Add ``ts_ts``, the local wall clock of ``ts``."""
    return candles.withColumn("ts_ts", wall_clock(F.col("ts"), zone))


def dedup_latest(
    rows: DataFrame,
    keys: Sequence[str] = CANDLE_KEY,
    latest_by: Sequence[str] = CANDLE_VERSION,
) -> DataFrame:
    """One row per key: the newest by those of ``latest_by`` that the rows have.

    Rows without any of them are refused, as no copy would be the newest. Remaining ties go by the other columns, so every run and every retried task keeps the same
    row. The rank-1 filter is applied before the shuffle too: copies of a key, however many,
    shrink to one row per task first.
    """
    versions = [c for c in latest_by if c in rows.columns]
    if not versions:
        raise ValueError(f"no version column: the rows have none of {', '.join(latest_by)}")
    others = [c for c in rows.columns if c not in (*keys, *versions)]
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*versions, *others)])
    return rows.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def found_candles(raw: DataFrame) -> DataFrame:
    """Every candle of the documents, usable or not. Narrow: no shuffle."""
    return explode_candles(with_candles(nested_candles(raw)))


def usable_candles(exploded: DataFrame) -> DataFrame:
    """The candles with all elements and a possible ``ts``, typed."""
    return candle_fields(complete_candles(exploded)).where(F.col("ts").isNotNull())


def base_rows(raw: DataFrame) -> DataFrame:
    """Every usable candle of the documents, copies included. Narrow: no shuffle."""
    return usable_candles(found_candles(raw))


def clean_candles(
    raw: DataFrame, zone: str = DEFAULT_ZONE, keys: Sequence[str] = CANDLE_KEY
) -> DataFrame:
    """Documents to base candles: explode, type, keep the newest copy of each key."""
    newest = dedup_latest(base_rows(raw), keys)
    return with_wall_clock(newest, zone).select("symbol", "exchange", *CANDLE_FIELDS, "ts_ts")


def on_session(
    candles: DataFrame,
    days: date | str | Iterable[date | str],
    timeframes: Sequence[Timeframe],
    zone: str = DEFAULT_ZONE,
) -> DataFrame:
    """Candles that take part in a bar starting on one of some local dates.

    A bar that starts just before midnight may reach past it, so what counts is the start of
    the candle's bar, in any of the widths.
    """
    wanted = sorted({as_date(d) for d in ([days] if isinstance(days, (date, str)) else days)})
    bounds = [day_bounds(d, zone) for d in wanted]
    ts = F.col("ts")

    def inside(start: Column) -> Column:
        return reduce(Column.__or__, [(start >= a) & (start < b) for a, b in bounds], F.lit(False))

    return candles.where(reduce(
        Column.__or__, [inside(interval_epoch(ts, t, zone)) for t in timeframes], F.lit(False)
    ))


@contextmanager
def cached(rows: DataFrame) -> Iterator[DataFrame]:
    """Keep rows for several uses, e.g. one ``resample`` per width, and free them afterwards."""
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
