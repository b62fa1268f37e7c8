from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from barloom import Timeframe
from barloom.functions import (
    bucket_epoch, clock_epoch, date_parts, day_bounds, day_start_epoch, fixed_offset, local_date,
    nests, wall_clock,
)
from barloom.functions import as_date, ingest_version, iso_date_parts, iso_instant, symbol_key
from barloom.operators import all_timeframes
from barloom.schema import TIMEFRAMES

SESSION_ZONES = ["UTC", "Asia/Kolkata", "America/New_York"]
# 2025-01-06 09:15 IST, both sides of IST midnight, both sides of New York clock changes
EPOCHS = [1736135100, 1736188199, 1736188200, 1741503599, 1741503600, 1762063199, 1762063200,
          0, -1, 5_000_000_000]


def naive(epoch, zone):
    return datetime.fromtimestamp(epoch, ZoneInfo(zone)).replace(tzinfo=None)


@pytest.mark.parametrize("session", SESSION_ZONES)
@pytest.mark.parametrize("zone", ["Asia/Kolkata", "UTC", "America/New_York"])
def test_wall_clock_and_day_start_do_not_depend_on_the_session(spark, session_zone, session, zone):
    session_zone(session)
    clock = wall_clock(F.col("e"), zone)
    rows = spark.createDataFrame([(e,) for e in EPOCHS], "e bigint").select(
        "e", clock.alias("clock"), day_start_epoch(F.col("e"), zone).alias("day_start"),
        clock_epoch(wall_clock(F.col("e"), "UTC")).alias("back"),
        *[c.alias(n) for n, c in date_parts(clock).items()],
    ).collect()
    for r in rows:
        expected = naive(r.e, zone)
        assert r.clock == expected
        assert r.back == r.e
        assert (r.year, r.month, r.day) == tuple(f"{expected:%Y-%m-%d}".split("-"))
        midnight = expected.replace(hour=0, minute=0, second=0, tzinfo=ZoneInfo(zone))
        assert r.day_start == int(midnight.timestamp())


def test_bucket_epoch_floors_negatives_too(spark):
    rows = spark.createDataFrame([(e,) for e in (*EPOCHS, -61, 59, 60)], "e bigint").select(
        "e", bucket_epoch(F.col("e"), 60).alias("m"),
        bucket_epoch(F.col("e"), 86400, 19800).alias("d"),
    ).collect()
    for r in rows:
        assert r.m == r.e // 60 * 60
        assert r.d == (r.e + 19800) // 86400 * 86400 - 19800


def test_zone_helpers():
    assert fixed_offset("Asia/Kolkata") == 19800
    assert fixed_offset("UTC") == 0
    assert fixed_offset("America/New_York") is None
    assert day_bounds(date(2025, 1, 6), "Asia/Kolkata") == (1736101800, 1736188200)
    start, end = day_bounds(date(2025, 3, 9), "America/New_York")
    assert end - start == 23 * 3600
    m1, m5, m15, d1 = TIMEFRAMES
    hour = Timeframe("1h", 3600)
    assert nests(m1, d1) and nests(m5, m15) and not nests(m15, m5)
    assert not nests(hour, d1, "Asia/Kolkata") and nests(hour, d1, "UTC")
    assert not nests(d1, hour)


def test_dates():
    evening = datetime(2025, 1, 6, 20, 0, tzinfo=timezone.utc)
    assert local_date("Asia/Kolkata", now=evening) == date(2025, 1, 7)
    assert local_date("UTC", now=evening) == date(2025, 1, 6)
    assert local_date("Asia/Kolkata", days_back=1, now=evening) == date(2025, 1, 6)
    assert as_date("2025-01-06") == date(2025, 1, 6)
    with pytest.raises(ValueError):
        as_date("06/01/2025")


def test_keys(spark):
    row = spark.createDataFrame(
        [("NSE:X/Y-BE", "2025-01-06T03:45:00Z", "ingest-2025-01-06T03:45:00Z.json",
          datetime(2025, 1, 6, 3, 45, 0, 999999), "part-0001.json")],
        "symbol string, iso string, name string, clock timestamp_ntz, other string",
    ).select(
        symbol_key(F.col("symbol")).alias("key"),
        *[c.alias(n) for n, c in iso_date_parts(F.col("iso")).items()],
        ingest_version(F.col("name")).alias("version"),
        ingest_version(F.col("other")).alias("none"),
        iso_instant(F.col("clock")).alias("instant"),
    ).first()
    assert row.key == "NSE_X_Y-BE"
    assert (row.year, row.month, row.day) == ("2025", "01", "06")
    assert row.version == row.instant == "2025-01-06T03:45:00Z"
    assert row.none is None


def test_dst_zone_days_have_their_own_length(spark):
    start, end = day_bounds(date(2025, 11, 2), "America/New_York")
    rows = spark.range(start, end, 60).select(
        F.lit("S").alias("symbol"), F.lit("X").alias("exchange"), F.col("id").alias("ts"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    days = all_timeframes(rows, zone="America/New_York", unique_ts=True).where("timeframe = '1d'")
    (bar,) = days.collect()
    assert bar.interval_start_epoch == start and bar.volume == 25 * 60
    assert (bar.year, bar.month, bar.day) == ("2025", "11", "02")
