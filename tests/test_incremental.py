"""Bars merged batch by batch equal those of one job over all documents."""

import random
import shutil

import pytest
from pyspark.sql import functions as F

from barloom import sources
from barloom.plans import incremental
from barloom.plans.day_job import ALL_DATES, aggregate_day
from barloom.plans.incremental import MergeReport, merge_arrivals, squash_candles, stored_candles
from barloom.schema import RAW, Timeframe
from barloom.streaming.arrivals import merge_on_arrival
from test_files import B, candle, land, triples

DAY = 86_400


def documents(spark, rows):
    """(symbol, exchange, version, candles) rows as landed documents."""
    made = [(s, e, "2025", "01", "06", v, (candles and [[float(x) for x in c] for c in candles],)) for s, e, v, candles in rows]
    return spark.createDataFrame(made, RAW)


def rebuilt(spark, tmp_path, rows, zone="Asia/Kolkata", name="whole", **kwargs):
    """All documents through one merge into nothing: what the bars have to be."""
    store, output = str(tmp_path / f"{name}-store"), str(tmp_path / f"{name}-bars")
    merge_arrivals(spark, documents(spark, rows), store, output, "all", zone=zone, **kwargs)
    bars = sources.read_dated_bars(spark, output)
    return triples(bars, *bars.columns)


def all_of(spark, output):
    bars = sources.read_dated_bars(spark, output)
    return triples(bars, *bars.columns)


def random_rows(seed):
    draw = random.Random(seed)
    return [
        (draw.choice(["A", "B"]), draw.choice(["NSE", "NSE", "BSE"]), f"v{draw.randint(0, 9)}", [
            candle(B + draw.choice([-DAY, 0, 0, DAY]) + 60 * draw.randint(-600, 900), draw.randint(1, 99)) for _ in range(draw.randint(0, 6))
        ] or None) for _ in range(24)
    ]


def test_against_the_job(spark, tmp_path):
    """One merge of all documents gives what the job gives from raw."""
    base = tmp_path / "raw"
    for n, (symbol, _, version, candles) in enumerate(random_rows(1)):
        land(base, symbol, f"{version}-{n}", {"candles": candles})
    raw = sources.read_raw(spark, str(base))
    report = merge_arrivals(spark, raw, str(tmp_path / "store"), str(tmp_path / "bars"), 0)
    job = aggregate_day(spark, str(base), str(tmp_path / "job"), ALL_DATES, ALL_DATES)
    assert (report.candles, report.bars) == (job.candles, job.bars)
    expected = sources.read_bars(spark, str(tmp_path / "job"))
    assert all_of(spark, str(tmp_path / "bars")) == triples(expected, *expected.columns)


@pytest.mark.parametrize("seed", [2])
def test_batches_in_any_order(spark, tmp_path, seed):
    """Revisions, exchanges that change, the same candle in several batches."""
    rows = random_rows(seed)
    store, output = str(tmp_path / "store"), str(tmp_path / "bars")
    for n in range(3):
        merge_arrivals(spark, documents(spark, rows[n::3]), store, output, n)
    assert all_of(spark, output) == rebuilt(spark, tmp_path, rows)


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/New_York"])
def test_buckets_across_midnight(spark, tmp_path, zone):
    """Clock hours that cross the local midnight of a half-hour zone; days of 23 hours."""
    widths = [Timeframe("15m", 900), Timeframe("1h", 3600), Timeframe("1d", DAY)]
    start = 1741498200 if zone != "Asia/Kolkata" else 1736101800  # 2025-03-09 00:30 there, or midnight
    rows = [("A", "NSE", f"v{n}", [candle(start + 600 * i, i + n) for i in range(-9 + n, 150, 3)]) for n in range(3)]
    store, output = str(tmp_path / "store"), str(tmp_path / "bars")
    for n, row in enumerate(rows):
        merge_arrivals(spark, documents(spark, [row]), store, output, n, zone=zone, timeframes=widths)
    assert all_of(spark, output) == rebuilt(spark, tmp_path, rows, zone, timeframes=widths)


def test_one_late_candle_touches_four_buckets(spark, tmp_path):
    store, output = str(tmp_path / "store"), str(tmp_path / "bars")
    rows = [(s, "NSE", "v1", [candle(B + 60 * i, i) for i in range(40)]) for s in "ABCDE"]
    merge_arrivals(spark, documents(spark, rows), store, output, 0)
    before = all_of(spark, output)
    late = ("C", "NSE", "v2", [candle(B + 60 * 7, 500)])
    report = merge_arrivals(spark, documents(spark, [late]), store, output, 1)
    assert (report.candles, report.buckets, report.dates, report.bars) == (1, 4, 1, len(before))
    after = all_of(spark, output)
    changed = set(after) - set(before)
    assert {(r[0], r[2]) for r in changed} == {("C", t) for t in ("1m", "5m", "15m", "1d")} and len(changed) == 4
    assert after == rebuilt(spark, tmp_path, [*rows, late])


def test_stream_restarts_and_reads_no_raw_again(spark, tmp_path):
    base, store, output, check = tmp_path / "raw", str(tmp_path / "store"), str(tmp_path / "bars"), str(tmp_path / "check")

    def run(files=None):
        query = merge_on_arrival(spark, str(base), store, output, check, files_per_batch=files)
        assert query.awaitTermination(240) and query.exception() is None

    land(base, "A", "v1", {"candles": [candle(B + 60 * i, i) for i in range(20)]})
    land(base, "B", "v1", {"candles": [candle(B + 60 * i, i) for i in range(5)]})
    run()
    kept = tmp_path / "kept"
    shutil.copytree(base, kept)
    for file in base.rglob("*.json"):  # what was merged is not needed any more
        file.write_text("")
    land(base, "A", "v2", {"candles": [candle(B + 60 * 3, 900), candle(B - 60, 7)]}, day="09")
    land(kept, "A", "v2", {"candles": [candle(B + 60 * 3, 900), candle(B - 60, 7)]}, day="09")
    land(base, "C", "v1", {"candles": []}, day="09")
    run(files=1)
    run()
    aggregate_day(spark, str(kept), str(tmp_path / "job"), ALL_DATES, ALL_DATES)
    expected = sources.read_bars(spark, str(tmp_path / "job"))
    assert all_of(spark, output) == triples(expected, *expected.columns)


@pytest.mark.parametrize("breaks", ["keep_candles", "write_dated_bars", "_finish", "touch"])
def test_a_run_that_ends_half_way(spark, tmp_path, monkeypatch, breaks):
    """Whatever step a run ends after, the same batch or the next one sets things right."""
    store, output = str(tmp_path / "store"), str(tmp_path / "bars")
    rows = random_rows(4)
    merge_arrivals(spark, documents(spark, rows[:8]), store, output, 0)
    step = getattr(incremental, breaks)

    def broken(*args, **kwargs):
        if breaks in ("keep_candles", "write_dated_bars"):
            step(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(incremental, breaks, broken)
        merge_arrivals(spark, documents(spark, rows[8:16]), store, output, 1)
    merge_arrivals(spark, documents(spark, rows[8:16]), store, output, 1)
    merge_arrivals(spark, documents(spark, rows[16:]), store, output, 2)
    expected = rebuilt(spark, tmp_path, rows)
    assert all_of(spark, output) == expected
    again = merge_arrivals(spark, documents(spark, rows[:8]), store, output, 0)
    assert again == MergeReport(done_before=True) and all_of(spark, output) == expected


def test_squashed_candles(spark, tmp_path):
    store, output = str(tmp_path / "store"), str(tmp_path / "bars")
    rows = random_rows(5)
    for n in range(4):
        merge_arrivals(spark, documents(spark, rows[n::4]), store, output, n)
    before = triples(stored_candles(spark, store), "symbol", "ts", "open", "exchange")
    days = [f"2025-01-0{d}" for d in (5, 6, 7, 8)]
    assert squash_candles(spark, store, days) > 3 and squash_candles(spark, store, ["2030-01-01"]) == 0
    copies = spark.read.parquet(f"{store}/candles")
    assert copies.count() == copies.select("symbol", "ts").distinct().count()
    assert triples(stored_candles(spark, store), "symbol", "ts", "open", "exchange") == before
    late = [("A", "NSE", "v99", [candle(B, 1000)])]
    merge_arrivals(spark, documents(spark, late), store, output, 9)
    assert all_of(spark, output) == rebuilt(spark, tmp_path, rows + late)


def test_empty_batches_and_names(spark, tmp_path):
    store, output = str(tmp_path / "store"), str(tmp_path / "bars")
    assert merge_arrivals(spark, documents(spark, []), store, output, 0) == MergeReport()
    assert merge_arrivals(spark, documents(spark, [("A", "NSE", "v1", None)]), store, output, 1) == MergeReport()
    assert stored_candles(spark, store).count() == stored_candles(spark, store, []).count() == 0
    assert merge_arrivals(spark, documents(spark, []), store, output, 0).done_before
    with pytest.raises(ValueError, match="a/b"):
        merge_arrivals(spark, documents(spark, []), store, output, "a/b")
    assert stored_candles(spark, store).select(F.count("*")).first()[0] == 0


def test_bars_of_a_batch_are_made_once(spark, tmp_path, monkeypatch):
    """Neither the ranges of the write nor the counts of the report make bars or buckets again."""
    plans = []
    write = incremental.write_dated_bars

    def seen(bars, *args, **kwargs):
        plans.append(bars._jdf.queryExecution().executedPlan().toString())
        return write(bars, *args, **kwargs)

    monkeypatch.setattr(incremental, "write_dated_bars", seen)
    for batch in range(2):
        merge_arrivals(spark, documents(spark, random_rows(batch)), str(tmp_path / "store"), str(tmp_path / "bars"), batch)
    assert len(plans) == 4 and not any("Aggregate" in p or "Window" in p for p in plans)
    assert not (tmp_path / "store" / "work").exists()
