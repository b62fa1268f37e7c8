"""Compacted landings: the same documents, whatever has been taken in."""

import pytest

from barloom import sources
from barloom.plans import landing
from barloom.plans.day_job import ALL_DATES, aggregate_day
from barloom.plans.landing import CompactionReport, compact_landing, read_landed, tail_files
from test_files import B, candle, land, triples


@pytest.fixture
def folders(tmp_path):
    raw = tmp_path / "raw"
    for day in ("06", "07"):
        for symbol in "ABC":
            land(raw, f"NSE_{symbol}&{{1}}-EQ", f"v{day}", {"s": "ok", "candles": [candle(B + int(day), 1), candle(B + 60, 2)]}, day=day)
    land(raw, "BAD", "v1", "{", day="06")
    return raw, tmp_path / "compacted"


def rows(frame):
    return sorted(map(str, frame.select(*sorted(frame.columns)).collect()))


def same(spark, raw, compacted, **kwargs):
    """Archive and tail give what the files alone give, for any dates."""
    for days in (None, "2025-01-06", ["2025-01-07", "2025-01-09"], "2030-01-01", []):
        assert rows(read_landed(spark, str(raw), str(compacted), days, **kwargs)) == rows(sources.read_raw(spark, str(raw), days, **kwargs)), days


@pytest.mark.parametrize("text", [False, True])
def test_documents_stay_the_same(spark, folders, text):
    raw, compacted = folders
    same(spark, raw, compacted, text=text)  # nothing is compacted yet
    assert compact_landing(spark, str(raw), str(compacted), text=text) == CompactionReport(7, 1)
    assert tail_files(spark, str(raw), str(compacted)).isEmpty()
    same(spark, raw, compacted, text=text)
    land(raw, "NSE_A&{1}-EQ", "v9", {"candles": [candle(B, 5)]}, day="07")
    land(raw, "NEW", "v9", {"candles": []}, day="09")
    assert tail_files(spark, str(raw), str(compacted)).count() == 2
    same(spark, raw, compacted, text=text)
    assert compact_landing(spark, str(raw), str(compacted), text=text) == CompactionReport(2, 1)
    same(spark, raw, compacted, text=text)


def test_a_rerun_changes_nothing(spark, folders):
    raw, compacted = folders
    assert compact_landing(spark, str(raw), str(compacted), files=3) == CompactionReport(7, 3)
    before = sorted(p for p in compacted.rglob("*"))
    assert compact_landing(spark, str(raw), str(compacted)) == CompactionReport()
    assert sorted(p for p in compacted.rglob("*")) == before
    same(spark, raw, compacted)


def test_archived_files_are_not_read_again(spark, folders):
    raw, compacted = folders
    compact_landing(spark, str(raw), str(compacted))
    expected = rows(sources.read_raw(spark, str(raw)))
    for file in raw.rglob("*.json"):
        file.write_text("")
    assert rows(read_landed(spark, str(raw), str(compacted))) == expected


def test_one_date_at_a_time(spark, folders):
    raw, compacted = folders
    assert compact_landing(spark, str(raw), str(compacted), "2025-01-06") == CompactionReport(4, 1)
    assert compact_landing(spark, str(raw), str(compacted), ["2025-01-06", "2030-01-01"]) == CompactionReport()
    same(spark, raw, compacted)


def test_a_run_that_ends_half_way(spark, folders, monkeypatch):
    """Documents without a ledger do not count, and are written again with what landed since."""
    raw, compacted = folders
    compact_landing(spark, str(raw), str(compacted), "2025-01-06")
    made = spark.createDataFrame

    def broken(data, schema=None, **kwargs):
        if schema == "path string":
            raise RuntimeError("lost")
        return made(data, schema, **kwargs)

    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(spark, "createDataFrame", broken)
        compact_landing(spark, str(raw), str(compacted))
    assert list((compacted / "documents").rglob("batch=2")) and landing.last_batch(spark, str(compacted)) == 1
    same(spark, raw, compacted)
    land(raw, "NEW", "v9", {"candles": [candle(B, 1)]}, day="09")
    assert compact_landing(spark, str(raw), str(compacted)) == CompactionReport(4, 1)
    same(spark, raw, compacted)


def test_day_job_from_the_archive(spark, folders, tmp_path):
    raw, compacted = folders
    compact_landing(spark, str(raw), str(compacted), "2025-01-06")
    found = []
    for archive in (None, str(compacted)):
        out = str(tmp_path / f"bars-{archive is None}")
        report = aggregate_day(spark, str(raw), out, ALL_DATES, ALL_DATES, compacted=archive)
        bars = sources.read_bars(spark, out)
        found.append((report, triples(bars, *bars.columns)))
    assert found[0] == found[1] and found[0][0].candles == 9
