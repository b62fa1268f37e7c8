"""Time arithmetic that gives the same answer under every session time zone.

Instants are UTC epoch seconds (bigint); wall clocks are TIMESTAMP_NTZ.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta
from functools import lru_cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column, functions as F

from barloom.schema import DAY_SECONDS, DEFAULT_ZONE, Timeframe

_EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


@lru_cache(maxsize=None)
def zone_offsets(zone: str) -> frozenset[int]:
    """UTC offsets (seconds) a zone uses from 1970 on, looked up month by month."""
    tz = ZoneInfo(zone)
    months = (datetime(y, m, 1, tzinfo=tz) for y in range(1970, 2070) for m in range(1, 13))
    return frozenset(int(t.utcoffset().total_seconds()) for t in months)


def fixed_offset(zone: str) -> int | None:
    """The offset of a zone that never changes its clocks, else None."""
    offsets = zone_offsets(zone)
    return next(iter(offsets)) if len(offsets) == 1 else None


def utc_clock(epoch: Column) -> Column:
    return F.timestamp_add("SECOND", epoch, F.expr(_EPOCH_NTZ))


def wall_clock(epoch: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Local wall clock of an epoch."""
    offset = fixed_offset(zone)
    if offset is not None:
        return utc_clock(epoch + F.lit(offset))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock(epoch))


def clock_epoch(clock: Column) -> Column:
    """Epoch seconds of a TIMESTAMP_NTZ read as UTC; fractions are floored."""
    days = F.unix_date(F.to_date(clock)).cast("bigint")
    return days * DAY_SECONDS + F.hour(clock) * 3600 + F.minute(clock) * 60 + F.second(clock)


def bucket_epoch(ts: Column, seconds: int, offset: int = 0) -> Column:
    """Left edge of the half-open bucket ``[b, b + seconds)`` that holds ``ts``."""
    return ts - F.pmod(ts + F.lit(offset), F.lit(seconds).cast("bigint"))


def day_start_epoch(ts: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Epoch of the local midnight that starts the day of ``ts``."""
    offset = fixed_offset(zone)
    if offset is not None:
        return bucket_epoch(ts, DAY_SECONDS, offset)
    midnight = F.to_date(wall_clock(ts, zone)).cast("timestamp_ntz")
    return clock_epoch(F.convert_timezone(F.lit(zone), F.lit("UTC"), midnight))


def interval_epoch(ts: Column, timeframe: Timeframe, zone: str = DEFAULT_ZONE) -> Column:
    """Bucket start of ``ts`` for a timeframe: local days, everything else epoch-aligned."""
    if timeframe.is_day:
        return day_start_epoch(ts, zone)
    return bucket_epoch(ts, timeframe.seconds)


def nests(inner: Timeframe, outer: Timeframe, zone: str = DEFAULT_ZONE) -> bool:
    """True if every ``inner`` bucket lies inside one ``outer`` bucket."""
    if inner == outer:
        return True
    if inner.is_day:
        return False
    if outer.is_day:
        return DAY_SECONDS % inner.seconds == 0 and all(
            o % inner.seconds == 0 for o in zone_offsets(zone)
        )
    return outer.seconds % inner.seconds == 0


def date_parts(clock: Column) -> dict[str, Column]:
    """Partition strings of a wall clock: ``yyyy``, zero-padded ``MM`` and ``dd``."""
    return {
        "year": F.year(clock).cast("string"),
        "month": F.lpad(F.month(clock).cast("string"), 2, "0"),
        "day": F.lpad(F.day(clock).cast("string"), 2, "0"),
    }


def local_date(zone: str = DEFAULT_ZONE, days_back: int = 0, now: datetime | None = None) -> date:
    """Today's date in a zone, or an earlier one."""
    now = now or datetime.now(ZoneInfo("UTC"))
    return now.astimezone(ZoneInfo(zone)).date() - timedelta(days=days_back)


def as_date(value: date | str) -> date:
    """A date from a date or a ``YYYY-MM-DD`` string; anything else is an error."""
    return value if isinstance(value, date) else date.fromisoformat(value)


def day_bounds(day: date, zone: str = DEFAULT_ZONE) -> tuple[int, int]:
    """Epochs of the local midnights before and after a date."""
    tz = ZoneInfo(zone)
    start, end = (
        datetime(d.year, d.month, d.day, tzinfo=tz) for d in (day, day + timedelta(days=1))
    )
    return int(start.timestamp()), int(end.timestamp())
