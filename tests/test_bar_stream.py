"""Streamed bars against batch bars: revisions, restarts, late rows, bounded state."""

import pytest

from barloom import operators as op, sources
from barloom.schema import TIMEFRAMES, Timeframe
from barloom.streaming.bars import start_bar_stream, stream_bars
from test_files import B, candle, land, triples

M1, M5, M15, D1 = TIMEFRAMES


def run(spark, tmp_path, width=M15, name="bars", **kwargs):
    query = start_bar_stream(
        spark, str(tmp_path / "raw"), str(tmp_path / name), str(tmp_path / f"{name}-check"), width, **kwargs
    )
    assert query.awaitTermination(240) and query.exception() is None
    return [p for p in query.recentProgress]


def streamed(spark, tmp_path, name="bars"):
    bars = sources.read_dated_bars(spark, str(tmp_path / name))
    return triples(bars, *bars.columns)


def batch(spark, tmp_path, width=M15, zone="Asia/Kolkata", before=None):
    candles = op.clean_candles(sources.read_raw(spark, str(tmp_path / "raw")))
    bars = op.resample(candles, width, zone)
    return triples(bars.where(f"interval_start_epoch < {before or 2**60}"), *bars.columns)


def close(tmp_path, at, day="20"):
    """A candle far ahead, so that the watermark passes all others; its own bar stays open."""
    land(tmp_path / "raw", "Z", "v0", {"candles": [candle(at, 1)]}, day=day)


def test_revisions_and_a_restart(spark, tmp_path):
    raw = tmp_path / "raw"
    land(raw, "A", "v1", {"candles": [candle(B + 60 * i, i) for i in range(40)]})
    land(raw, "B", "v1", {"candles": [candle(B + 60 * i, 50 + i) for i in range(40)]})
    run(spark, tmp_path, delay="2 hours")
    # revisions within the delay, one of the candle that opens a bar; an older copy changes nothing
    land(raw, "A", "v2", {"candles": [candle(B, 900), candle(B + 60 * 31, 901)]}, day="07")
    land(raw, "B", "v0", {"candles": [candle(B, 1)]}, day="07")
    land(raw, "A", "v2", {"candles": [candle(B + 7200 + 60 * i, i) for i in range(40)]}, day="08")
    run(spark, tmp_path, delay="2 hours", files_per_batch=1)
    assert {r[4] for r in streamed(spark, tmp_path)} <= {B, B + 900}, "only bars that the watermark has passed"
    close(tmp_path, B + 86_400)
    run(spark, tmp_path, delay="2 hours")
    found = streamed(spark, tmp_path)
    assert found == batch(spark, tmp_path, before=B + 80_000)
    assert [r[8] for r in found if r[0] == "A" and r[4] == B] == [900.0]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    again = run(spark, tmp_path, delay="2 hours", state_partitions=3)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert streamed(spark, tmp_path) == found and not any(p.numInputRows for p in again)


@pytest.mark.parametrize(("width", "zone"), [
    (D1, "Asia/Kolkata"), (D1, "America/New_York"), (Timeframe("1h", 3600), "Asia/Kolkata"),
])
def test_widths_and_zones(spark, tmp_path, width, zone):
    """Local days, of 23 hours too, and clock hours across a local midnight."""
    start = 1741410000  # 2025-03-08 00:00 in New York, the day before its clocks change
    land(tmp_path / "raw", "A", "v1", {"candles": [candle(start + 1800 * i, i) for i in range(-20, 150)]})
    land(tmp_path / "raw", "A", "v2", {"candles": [candle(start + 1800 * i, 2 * i) for i in range(0, 150, 7)]})
    close(tmp_path, start + 9 * 86_400)
    run(spark, tmp_path, width, zone=zone, delay="3 days")
    found = streamed(spark, tmp_path)
    assert found and found == batch(spark, tmp_path, width, zone, before=start + 5 * 86_400)


def test_state_is_bounded_and_late_rows_are_counted(spark, tmp_path):
    raw = tmp_path / "raw"
    sizes = []
    for d in range(5):
        land(raw, "A", f"v{d}", {"candles": [candle(B + d * 86_400 + 60 * i, i) for i in range(120)]}, day=f"0{d + 1}")
        sizes.append([s.numRowsTotal for s in run(spark, tmp_path, delay="1 hour")[-1].stateOperators])
    assert all(0 < sum(s) <= 61 + 6 for s in sizes), "an hour of candles and the open bars"
    before = streamed(spark, tmp_path)
    land(raw, "A", "v9", {"candles": [candle(B, 5000)]}, day="09")
    progress = run(spark, tmp_path, delay="1 hour")
    assert sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators) == 1
    assert streamed(spark, tmp_path) == before


def test_same_bars_from_a_batch(spark, tmp_path):
    land(tmp_path / "raw", "A", "v1", {"candles": [candle(B + 60 * i, i) for i in range(40)]})
    land(tmp_path / "raw", "A", "v2", {"candles": [candle(B, 7), candle(None, 1)]})
    rows = op.base_rows(sources.read_raw(spark, str(tmp_path / "raw")))
    bars = stream_bars(rows, M5, "1 hour")
    assert triples(bars, *bars.columns) == batch(spark, tmp_path, M5)
    with pytest.raises(ValueError, match="ingest_ts"):
        stream_bars(rows.drop("ingest_ts", "pos"), M5, "1 hour")
