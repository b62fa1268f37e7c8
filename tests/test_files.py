"""Landing folders, scans, sinks and the job, on real folders."""

import json
from datetime import date

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from barloom import operators as op, sinks, sources
from barloom.plans.day_job import aggregate_day, main
from barloom.schema import ENVELOPE, OUTCOME
from barloom.sources import bars
from barloom.streaming.arrivals import rebuild_on_arrival

B = 1736135100  # 2025-01-06 09:15 IST
ZONES = ["UTC", "Asia/Kolkata", "America/New_York"]


def land(base, symbol, name, text, day="06"):
    folder = base / f"symbol={symbol}" / "exchange=NSE" / "year=2025" / "month=01" / f"day={day}"
    folder.mkdir(parents=True, exist_ok=True)
    text = text if isinstance(text, str) else json.dumps({ENVELOPE: text}, indent=2)
    # the local file system cannot read names with colons, object stores can
    (folder / f"ingest-{name}.json").write_text(text)


def candle(ts, price, *more):
    return [ts, price, price + 2, price - 2, price + 1, 10, *more]


@pytest.fixture
def landed(tmp_path):
    base = tmp_path / "raw"
    land(base, "NSE_A-EQ", "v1", {"s": "ok", "candles": [candle(B, 100), candle(B + 60, 101)]})
    land(base, "NSE_A-EQ", "v2", {"s": "ok", "candles": [
        candle(B, 100), candle(B + 60, 201, 7), candle(B + 300, 102), [B, 1, 2], None,
        candle(None, 1), [B + 360, None, 9, 1, 5, 4], candle(B * 10**6, 1),
    ]})
    land(base, "NSE_B-EQ", "v1", {"s": "no_data", "candles": []})
    land(base, "NSE_C-EQ", "v1", {"raw_text": "oops"})
    land(base, "NSE_D-EQ", "v1", {"candles": [candle(B, 50), [B + 60, "x", 1, 1, 1, 1]]})
    land(base, "NSE_E-EQ", "v1", '{"%s": {"candles": [[17361' % ENVELOPE)
    land(base, "NSE_F-EQ", "v1", {"s": "ok"})
    land(base, "NSE_A-EQ", "v1", {"candles": [candle(B + 86_400, 500)]}, day="07")
    return str(base)


def triples(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_scan_has_string_partitions_and_versions(spark, landed):
    raw = sources.read_raw(spark, landed, "2025-01-06")
    assert dict(raw.dtypes)["month"] == "string"
    seen = triples(raw, "symbol", "year", "month", "day", "ingest_ts")
    assert ("NSE_A-EQ", "2025", "01", "06", "v2") in seen
    assert len(seen) == 7
    assert sources.read_raw(spark, landed).count() == 8
    filtered = sources.on_raw_date(sources.read_raw(spark, landed), date(2025, 1, 6))
    assert "PartitionFilters: [isnotnull(year" in filtered._jdf.queryExecution().toString()
    assert triples(filtered, "symbol", "ingest_ts") == triples(raw, "symbol", "ingest_ts")


def test_missing_date_is_empty_and_missing_base_an_error(spark, landed, tmp_path):
    assert sources.read_raw(spark, landed, "2031-01-01").isEmpty()
    with pytest.raises(AnalysisException):
        sources.read_raw(spark, str(tmp_path / "nowhere"), "2025-01-06")


def test_clean_candles(spark, landed):
    raw = sources.read_raw(spark, landed, "2025-01-06")
    clean = triples(op.clean_candles(raw), "symbol", "ts", "open", "close", "ts_ts")
    assert [(s, t - B, o, c) for s, t, o, c, _ in clean] == [
        ("NSE_A-EQ", 0, 100.0, 101.0), ("NSE_A-EQ", 60, 201.0, 202.0),
        ("NSE_A-EQ", 300, 102.0, 103.0), ("NSE_A-EQ", 360, None, 5.0),
    ]
    assert str(clean[0][4]) == "2025-01-06 09:15:00"


def test_triage_and_rejects(spark, landed):
    text = sources.read_raw(spark, landed, "2025-01-06", text=True)
    assert triples(op.triage_raw(text), "symbol", "class") == [
        ("NSE_A-EQ", "ok"), ("NSE_A-EQ", "ok"), ("NSE_B-EQ", "empty"), ("NSE_C-EQ", "raw_text"),
        ("NSE_D-EQ", "ok"), ("NSE_E-EQ", "corrupt"), ("NSE_F-EQ", "no_candles"),
    ]
    assert {r["class"]: r.documents for r in op.triage_counts(op.triage_raw(text)).collect()} == {
        "ok": 3, "empty": 1, "raw_text": 1, "corrupt": 1, "no_candles": 1,
    }
    assert triples(op.rejected_candles(text), "symbol", "pos", "reason") == [
        ("NSE_A-EQ", 3, "short_candle"), ("NSE_A-EQ", 4, "null_candle"), ("NSE_A-EQ", 5, "null_ts"),
        ("NSE_A-EQ", 7, "bad_ts"),
        ("NSE_D-EQ", 1, "bad_open"),
    ]
    saved = op.dedup_latest(op.salvaged_rows(text))
    assert triples(saved.where("symbol = 'NSE_D-EQ'"), "ts", "open") == [(B, 50.0)]
    usual = op.dedup_latest(op.base_rows(sources.read_raw(spark, landed, "2025-01-06")))
    assert triples(saved.where("symbol <> 'NSE_D-EQ'"), "symbol", "ts", "volume") == triples(
        usual, "symbol", "ts", "volume"
    )


@pytest.mark.parametrize("zone", ZONES)
def test_day_job(spark, session_zone, landed, tmp_path, zone):
    session_zone(zone)
    out = str(tmp_path / "bars")
    report = aggregate_day(spark, landed, out, "2025-01-06")
    assert (report.candles, report.bars) == (4, 4 + 2 + 1 + 1)
    bars = sources.read_bars(spark, out)
    assert triples(bars.where("timeframe = '5m'"), "interval_start_epoch", "open", "high", "low",
                   "close", "volume") == [
        (B, 100.0, 203.0, 98.0, 202.0, 20.0), (B + 300, 102.0, 104.0, 1.0, 5.0, 14.0),
    ]
    (day,) = bars.where("timeframe = '1d'").collect()
    assert str(day.interval_start) == "2025-01-06 00:00:00"
    assert (day.year, day.month, day.day, day.volume) == ("2025", "01", "06", 34.0)
    folders = sorted(p.parent for p in (tmp_path / "bars").rglob("*.parquet"))
    assert len(folders) == len(set(folders)) == 4, "one file per folder"
    assert all(".snappy." in p.name for p in (tmp_path / "bars").rglob("*.parquet"))


def test_reruns_are_idempotent_and_leave_other_days(spark, landed, tmp_path):
    out = str(tmp_path / "bars")
    aggregate_day(spark, landed, out, "2025-01-07")
    aggregate_day(spark, landed, out, "2025-01-06")
    before = triples(sources.read_bars(spark, out), *sinks.BAR_PARTITIONS, "interval_start_epoch",
                     "volume")
    aggregate_day(spark, landed, out, "2025-01-06")
    after = triples(sources.read_bars(spark, out), *sinks.BAR_PARTITIONS, "interval_start_epoch",
                    "volume")
    assert before == after and {r[5] for r in after} == {"06", "07"}
    whole = str(tmp_path / "whole")
    aggregate_day(spark, landed, whole, "all", "all")
    assert triples(sources.read_bars(spark, whole), *sinks.BAR_PARTITIONS,
                   "interval_start_epoch", "volume") == after


@pytest.mark.parametrize("mode", ["dynamic", "static"])
def test_no_candles_touches_nothing(spark, landed, tmp_path, mode):
    out = str(tmp_path / "bars")
    aggregate_day(spark, landed, out, "2025-01-06")
    before = sources.read_bars(spark, out).count()
    assert aggregate_day(spark, landed, out, "2030-01-01", mode=mode).is_empty
    assert aggregate_day(spark, landed, out, "2025-01-06", "2025-01-07", mode=mode).is_empty
    assert sources.read_bars(spark, out).count() == before


@pytest.mark.parametrize("mode", ["dynamic", "static"])
def test_candles_of_another_local_date_touch_nothing(spark, tmp_path, mode):
    """18:31 UTC is past the local midnight: the run of its landing date yields no bar."""
    base, out = tmp_path / "raw", str(tmp_path / "bars")
    land(base, "NSE_A-EQ", "v1", {"candles": [candle(B, 100)]})
    aggregate_day(spark, str(base), out, "2025-01-06")
    before = triples(sources.read_bars(spark, out), *sinks.BAR_PARTITIONS, "close")
    assert len(before) == 4
    late = tmp_path / "late"
    land(late, "NSE_A-EQ", "v1", {"candles": [candle(B + 14 * 3600 + 46 * 60, 7)]})
    report = aggregate_day(spark, str(late), out, "2025-01-06", mode=mode)
    assert (report.candles, report.bars, report.is_empty) == (0, 0, True)
    assert triples(sources.read_bars(spark, out), *sinks.BAR_PARTITIONS, "close") == before
    both = aggregate_day(spark, str(late), out, ["2025-01-06", "2025-01-07"], "2025-01-06")
    assert (both.candles, both.bars) == (1, 4)


def test_report_tells_what_was_left_out(spark, landed, tmp_path):
    report = aggregate_day(spark, landed, str(tmp_path / "bars"), "2025-01-06", "all")
    assert (report.documents, report.empty_documents) == (8, 5)
    assert (report.rejected, report.out_of_date, report.candles) == (4, 1, 4)


def test_keys_that_leave_copies_still_give_whole_bars(spark, landed, tmp_path):
    out = str(tmp_path / "bars")
    aggregate_day(spark, landed, out, "2025-01-06", keys=("ts", "symbol", "pos"), writers=3)
    (day,) = sources.read_bars(spark, out, timeframe="1d").collect()
    assert day.volume == 10 + 10 + 10 + 4


def test_salvage_and_command_line(spark, landed, tmp_path, capsys):
    out = str(tmp_path / "bars")
    report = main(["--INPUT_PREFIX", landed + "/", "--OUTPUT_PREFIX", out, "--date", "2025-01-06",
                   "--salvage"])
    assert report.candles == 5
    assert "2025-01-06: 5 candles" in capsys.readouterr().out
    with pytest.raises(ValueError):
        main(["--INPUT_PREFIX", landed, "--OUTPUT_PREFIX", out, "--date", "6.1.2025"])


def test_static_and_dynamic_overwrite(spark, tmp_path):
    out = str(tmp_path / "bars")
    rows = spark.range(10).select(
        F.lit("A").alias("symbol"), F.lit("X").alias("exchange"),
        (B + F.col("id") * 43_200).alias("ts"),
        *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close", "volume")],
    )
    bars = op.all_timeframes(rows, unique_ts=True)
    sinks.write_bars(bars, out, clustered=True)
    total = sources.read_bars(spark, out).count()
    one = op.on_session_date(bars, "2025-01-07").where("timeframe = '15m'").limit(1)
    sinks.write_bars(one, out)
    assert sources.read_bars(spark, out).count() == total - 1
    sinks.write_bars(one, out, mode="static")
    assert sources.read_bars(spark, out).count() == 1
    with pytest.raises(ValueError):
        sinks.write_bars(one, out, mode="append")


def test_bar_scan_prunes(spark, landed, tmp_path):
    out = str(tmp_path / "bars")
    aggregate_day(spark, landed, out, "all", "all")
    day = dict(start="2025-01-07", end="2025-01-07")
    bars = sources.read_bars(spark, out, timeframe="1m", exchange="NSE", symbols=["NSE_A-EQ"],
                             view="bars", **day)
    assert spark.sql("select count(*) from bars").first()[0] == 1
    assert len(bars.inputFiles()) == 1  # the listing holds nothing else
    plan = bars._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(timeframe" in plan
    whole = sources.read_bars(spark, out)
    assert len(whole.inputFiles()) == 8
    many = ["NSE_A-EQ", *(f"S{i}" for i in range(1200))]
    assert len(sources.read_bars(spark, out, timeframe="1m", symbols=many, **day).inputFiles()) == 1
    assert len(sources.read_bars(spark, out, start="2025-01-07").inputFiles()) == 4
    assert len(sources.read_bars(spark, out, end="2025-01-06").inputFiles()) == 4
    assert len(sources.read_bars(spark, out, start="2024-12-31", end="2025-01-06").inputFiles()) == 4
    assert len(sources.read_bars(spark, out, **day).inputFiles()) == 4
    for start, end in [("2025-01-07", None), (None, "2025-01-06"), ("2025-01-01", "2025-01-06"),
                       ("2024-12-31", "2025-01-06"), ("2025-01-07", "2025-03-01")]:
        picked = sources.read_bars(spark, out, start=start, end=end)
        expected = whole.where(
            f"concat_ws('-', year, month, day) between '{start or '0'}' and '{end or '9'}'"
        )
        assert triples(picked, *sinks.BAR_PARTITIONS, "interval_start_epoch") == triples(
            expected, *sinks.BAR_PARTITIONS, "interval_start_epoch"
        ) != []
    for nothing in (dict(timeframe="2h"), dict(exchange="N*"), dict(symbols=[]),
                    dict(symbols=["NSE_{A}-EQ"]), dict(start="2025-01-07", end="2025-01-06")):
        assert sources.read_bars(spark, out, **nothing).isEmpty()


@pytest.mark.parametrize("one_per_file", [True, False])
def test_landing_round_trip(spark, tmp_path, one_per_file):
    base = str(tmp_path / "raw")
    payloads = spark.createDataFrame(
        [("NSE:M&M-EQ", "2025-01-06T04:00:00Z", ([[float(B), 1.0, 3.0, 0.5, 2.0, 5.0]], "ok")),
         ("NSE:M&M-EQ", "2025-01-06T04:30:00Z", ([[float(B), 1.0, 4.0, 0.5, 3.0, 6.0]], "ok")),
         ("NSE:X/Y-BE", "2025-01-06T04:00:00Z", ([[float(B), 7.0, 8.0, 6.0, 7.0, 1.0]], None)),
         ("NSE:BAD-EQ", "2025-01-06T04:00:00Z", (None, "error"))],
        "symbol string, ingest_ts string, "
        f"{ENVELOPE} struct<candles: array<array<double>>, s: string>",
    )
    sinks.land_raw(payloads.coalesce(1), base, one_per_file=one_per_file)
    files = list((tmp_path / "raw").rglob("*.json"))
    assert len(files) == (3 if one_per_file else 2)
    raw = sources.read_raw(spark, base, "2025-01-06", multi_line=one_per_file)
    assert triples(raw, "symbol", "ingest_ts")[0] == ("NSE_M&M-EQ", "2025-01-06T04:00:00Z")
    clean = op.clean_candles(raw)
    assert triples(clean, "symbol", "exchange", "ts", "volume") == [
        ("NSE_M&M-EQ", "NSE", B, 6.0), ("NSE_X_Y-BE", "NSE", B, 1.0),
    ]
    assert '"ticker":"NSE:' in files[0].read_text()


def test_dead_letters_of_both_layouts(spark, tmp_path):
    base = tmp_path / "errors"
    folder = base / "symbol=NSE_Z-EQ" / "year=2025" / "month=01" / "day" / "06"
    folder.mkdir(parents=True)
    (folder / "failed-t.json").write_text(json.dumps({
        "symbol": "NSE:Z-EQ", "failed_at": "2025-01-06T04:00:00Z", "attempts": 5,
        "note": "Exhausted 5 attempts", "params_sent": {"symbol": "NSE:Z-EQ", "resolution": "1"},
    }, indent=2))
    assert triples(sources.read_dead_letters(spark, str(base)), "symbol", "day",
                   "params_sent.symbol") == [("NSE_Z-EQ", "06", "NSE:Z-EQ")]
    outcomes = spark.createDataFrame(
        [("NSE:A-EQ", True, 1, 200, None, None), ("NSE:B-EQ", False, 5, None, "gave up", True),
         ("NSE:C-EQ", False, 1, None, "missing_credentials", False),
         ("NSE:D-EQ", False, 1, None, "Exhausted, but will try again", False),
         (None, False, 0, None, "boom", True)],
        OUTCOME,
    )
    letters = op.dead_letters(outcomes, F.lit("2025-01-07T04:00:00Z"), F.lit("2025-01-07"))
    sinks.write_dead_letters(letters, str(base))
    both = sources.read_dead_letters(spark, str(base))
    assert triples(both, "symbol", "year", "month", "day", "attempts", "params_sent.range_to") == [
        ("NSE_B-EQ", "2025", "01", "07", 5, "2025-01-07"),
        ("NSE_Z-EQ", "2025", "01", "06", 5, None),
    ]
    assert sources.read_dead_letters(spark, str(base), "2025-01-06").count() == 1
    assert sources.read_dead_letters(spark, str(base), "2025-01-09").isEmpty()


def test_outcomes_and_tickers(spark, tmp_path):
    path = tmp_path / "tickers.txt"
    path.write_text("NSE:A-EQ\n\n NSE:M&M-EQ \r\nNSE:BAJAJ-AUTO-EQ\n\t\nNSE:A-EQ\n")
    tickers = sources.read_tickers(spark, str(path))
    assert [r.symbol for r in tickers.collect()] == [
        "NSE:A-EQ", "NSE:M&M-EQ", "NSE:BAJAJ-AUTO-EQ", "NSE:A-EQ",
    ]
    outcomes = spark.createDataFrame(
        [("NSE:A-EQ", True, 1, 200, None, None),
         ("NSE:B-EQ", False, 5, None, "Exhausted 5 attempts", True),
         ("NSE:C-EQ", False, 1, None, "missing_credentials", None),
         ("NSE:D-EQ", None, 1, None, None, None)],
        OUTCOME,
    )
    assert tuple(op.run_summary(outcomes, tickers).first()) == (1, 3, 4)
    assert tuple(op.run_summary(outcomes.limit(0), tickers.limit(0)).first()) == (0, 0, 0)
    assert triples(op.run_metrics(outcomes, tickers), "metric", "symbol", "value")[:2] == [
        ("IngestFailed", "NSE:B-EQ", 1), ("IngestRunFailedCount", None, 3),
    ]
    assert triples(op.run_metrics(outcomes.limit(0), tickers), "metric", "symbol", "value") == [
        ("IngestRunFailedCount", None, 0), ("IngestRunSuccessCount", None, 0),
        ("IngestRunSymbolsTotal", None, 4),
    ]
    reasons = op.failure_reasons(outcomes).collect()
    assert {(r.error, r.failures, r.max_attempts) for r in reasons} == {
        ("Exhausted 5 attempts", 1, 5), ("missing_credentials", 1, 1), (None, 1, 1),
    }


def test_cached_rows_are_freed(spark):
    rows = spark.range(5)
    with op.cached(rows) as kept:
        assert kept.count() == 5 and kept.is_cached
    assert not kept.is_cached


def test_ranges_become_narrow_folder_globs():
    day = date(2025, 1, 1)
    assert bars.date_folders(date(2024, 12, 31), day) == [
        "year=2024/month=12/day=31", "year=2025/month=01/day=01",
    ]
    assert bars.date_folders(date(2025, 1, 31), date(2025, 2, 1)) == [
        "year=2025/month=01/day=31", "year=2025/month=02/day=01",
    ]
    assert bars.date_folders(date(2025, 11, 30), None) == [
        "year=2025/month=11/day=30", "year=2025/month=12",
        "year=[3-9]???", "year=2[1-9]??", "year=20[3-9]?", "year=202[6-9]",
    ]
    assert bars.date_folders(None, date(2019, 1, 1)) == [
        "year=[0-1]???", "year=200?", "year=201[0-8]", "year=2019/month=01/day=01",
    ]
    assert bars.date_folders(None, None) == []


def test_stream_covers_both_sides_of_local_midnight(spark, tmp_path):
    base, out = tmp_path / "raw", str(tmp_path / "bars")
    late = B + 14 * 3600 + 46 * 60
    land(base, "NSE_A-EQ", "v1", {"candles": [candle(B, 100), candle(late, 7)]})
    (base / "symbol=NSE_A-EQ" / "exchange=NSE" / "year=abc" / "month=01" / "day=06").mkdir(parents=True)
    (base / "symbol=NSE_A-EQ" / "exchange=NSE" / "year=abc" / "month=01" / "day=06" / "x.json").write_text(
        json.dumps({ENVELOPE: {"candles": []}}))
    query = rebuild_on_arrival(spark, str(base), out, str(tmp_path / "checkpoint"))
    assert query.awaitTermination(120)
    whole = str(tmp_path / "whole")
    aggregate_day(spark, str(base), whole, "all", "all")
    columns = (*sinks.BAR_PARTITIONS, "interval_start_epoch", "close", "volume")
    assert triples(sources.read_bars(spark, out), *columns) == triples(sources.read_bars(spark, whole), *columns)


def test_each_document_is_parsed_once(spark):
    lines = spark.createDataFrame(
        [("NSE:A-EQ", "NSE", "v1", '{"%s": {"candles": [[1, "7d", 1, 1, 1, 1], [60, 1, 1, 1, 1, 1e0]]}}' % ENVELOPE)],
        "symbol string, exchange string, ingest_ts string, value string",
    )
    parsed = sources.parse_raw(lines)
    assert triples(op.rejected_candles(parsed), "pos", "reason") == [(0, "bad_open")]
    assert triples(op.salvaged_rows(parsed), "pos", "ts") == [(1, 60)]
    for rows in (op.triage_raw(parsed), op.triage_counts(op.triage_raw(parsed)),
                 op.rejected_candles(parsed), op.salvaged_rows(parsed)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1


def test_stream_rebuilds_touched_days(spark, landed, tmp_path):
    out, checkpoint = str(tmp_path / "bars"), str(tmp_path / "checkpoint")

    def run():
        query = rebuild_on_arrival(spark, landed, out, checkpoint)
        assert query.awaitTermination(120)
        return triples(sources.read_bars(spark, out), *sinks.BAR_PARTITIONS,
                       "interval_start_epoch", "close", "volume")

    first = run()
    whole = str(tmp_path / "whole")
    aggregate_day(spark, landed, whole, "all", "all")
    batch = sources.read_bars(spark, whole)
    assert first == triples(batch, *sinks.BAR_PARTITIONS, "interval_start_epoch", "close", "volume")
    land(tmp_path / "raw", "NSE_A-EQ", "v9", {"candles": [candle(B + 86_400, 900)]}, day="07")
    second = run()
    assert [r for r in second if r[5] == "06"] == [r for r in first if r[5] == "06"]
    assert {r[7] for r in second if r[5] == "07"} == {901.0}


def test_stream_keeps_what_landed_long_after(spark, tmp_path):
    """Two backfills of one local day, landed days apart in batches of their own."""
    base, out, checkpoint = tmp_path / "raw", str(tmp_path / "bars"), str(tmp_path / "checkpoint")
    for day, ts in (("06", B), ("11", B + 600), ("15", B + 1200)):
        land(base, "NSE_A-EQ", f"v{day}", {"candles": [candle(ts, int(day))]}, day=day)
        assert rebuild_on_arrival(spark, str(base), out, checkpoint).awaitTermination(120)
    whole = str(tmp_path / "whole")
    aggregate_day(spark, str(base), whole, "all", "all")
    columns = (*sinks.BAR_PARTITIONS, "interval_start_epoch", "close", "volume")
    assert triples(sources.read_bars(spark, out), *columns) == triples(sources.read_bars(spark, whole), *columns)
