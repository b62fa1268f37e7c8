"""The bar job: landed documents of some days, or of the whole archive, to bar folders."""

from __future__ import annotations

import argparse
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from barloom.functions import as_date, local_date
from barloom.operators import (
    all_timeframes, common_home, dedup_latest, found_candles, judged, on_session, on_session_date,
    usable_candles,
)
from barloom.plans.landing import read_landed
from barloom.schema import CANDLE_KEY, DEFAULT_ZONE, ENVELOPE, SERIES, TIMEFRAMES, Timeframe
from barloom.session import get_session
from barloom.sinks import folder_writers, write_bars, write_dated_bars
from barloom.sources import load_raw

ALL_DATES = "all"
Dates = date | str | Iterable[date | str] | None


@dataclass(frozen=True)
class DayReport:
    """What a run read, dropped and wrote. No candles means that no bar was touched."""

    candles: int = 0  # unique ones, in the bars written
    bars: int = 0
    documents: int = 0
    empty_documents: int = 0  # without candles, or with one that cannot be read
    rejected: int = 0  # candles without a usable ts or elements
    out_of_date: int = 0  # usable candles in bars of other dates

    @property
    def is_empty(self) -> bool:
        return self.candles == 0


def _days(dates: Dates, default: date | str | None = None) -> list[date] | None:
    """Some dates, sorted; None for all of them."""
    if isinstance(dates, str) and dates == ALL_DATES:
        return None
    if dates is None:
        dates = default
    return sorted({as_date(d) for d in ([dates] if isinstance(dates, (date, str)) else dates)})


def day_bars(
    candles: DataFrame,
    session_date: Dates,
    timeframes: Sequence[Timeframe] = TIMEFRAMES,
    zone: str = DEFAULT_ZONE,
    unique_ts: bool = True,
    writers: int | None = None,
) -> DataFrame:
    """Bars of candles, only those of some local dates if given, placed for writing.

    ``unique_ts`` promises one candle per series and second. ``writers`` is the number of tasks
    that write folders.
    """
    writers = writers or folder_writers(candles.sparkSession)
    bars = all_timeframes(candles, timeframes, zone, unique_ts=unique_ts, partitions=writers)
    return bars if session_date is None else on_session_date(bars, session_date)


def aggregate_day(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    session_date: Dates = None,
    raw_date: Dates = None,
    *,
    zone: str = DEFAULT_ZONE,
    timeframes: Sequence[Timeframe] = TIMEFRAMES,
    keys: Sequence[str] = CANDLE_KEY,
    mode: str = "dynamic",
    salvage: bool = False,
    multi_line: bool = True,
    writers: int | None = None,
    layout: str = "series",
    compacted: str | None = None,
) -> DayReport:
    """Read landed documents, build every bar width, replace the bar folders they fall in.

    ``session_date`` picks the bars written (one local date or several, default today in
    ``zone``); ``raw_date`` picks the landing folders read (default the same dates). ``"all"``
    lifts either filter, so one run can rebuild the whole archive. ``salvage`` keeps the good
    candles of documents with bad ones, which otherwise count as empty. Only candles of bars
    that will be written go on; where there is none, no bar is touched, whatever the mode.
    ``layout`` is ``"series"`` for a folder a series and day (``write_bars``) or ``"dated"`` for one a
    width and day (``write_dated_bars``), whose dates are replaced with all their symbols.
    ``compacted`` is an archive of ``compact_landing``, from which all but the newest documents come.

    Two shuffles in all: copies of a candle meet by (symbol, ts), then each local day of a
    series meets once for all widths and the write. A dynamic run reads its input once; a static
    one, which would replace the whole target, first asks whether there is a candle at all.
    """
    if layout not in ("series", "dated"):
        raise ValueError(f"unknown layout {layout!r}")
    days = _days(session_date, local_date(zone))
    landed = _days(raw_date, days if days is not None else local_date(zone))
    if compacted is not None:
        raw = read_landed(spark, input_path, compacted, landed, text=salvage, multi_line=multi_line)
    else:
        raw = load_raw(spark, input_path, landed, text=salvage, multi_line=multi_line)
    if raw is None or days == []:
        return DayReport()

    count = F.count(F.lit(1))
    read, found, usable, kept = (Observation(n) for n in ("read", "found", "usable", "kept"))
    size = F.coalesce(F.size(F.col(f"{ENVELOPE}.candles")), F.lit(0))
    raw = raw.observe(read, count.alias("rows"), F.count_if(size <= 0).alias("empty"))
    candles = found_candles(raw).observe(found, count.alias("rows"))
    if salvage:
        rows = judged(candles).where("reason IS NULL").drop("reason", "source")
    else:
        rows = usable_candles(candles)
    rows = rows.observe(usable, count.alias("rows"))
    if days is not None:
        rows = on_session(rows, days, timeframes, zone)
    if mode == "static" and rows.isEmpty():
        return DayReport()
    rows = rows.observe(kept, count.alias("rows"))

    # above a shuffle; reported only if some row gets there
    candle_count, bar_count = Observation("candles"), Observation("bars")
    newest = dedup_latest(rows, keys).observe(candle_count, count.alias("rows"))
    unique = set(keys) <= {"ts", *SERIES}
    bars = day_bars(newest, days, timeframes, zone, unique, writers)
    if layout == "dated":
        write_dated_bars(bars, output_path, mode, files=writers, counted=bar_count)
    else:
        bars = bars.observe(bar_count, count.alias("rows"))
        clustered = unique and common_home(timeframes, zone) is not None
        write_bars(bars, output_path, mode, clustered=clustered, writers=writers)
    some = kept.get["rows"] > 0
    return DayReport(
        candles=candle_count.get["rows"] if some else 0,
        bars=bar_count.get["rows"] if some else 0,
        documents=read.get["rows"],
        empty_documents=read.get["empty"],
        rejected=found.get["rows"] - usable.get["rows"],
        out_of_date=usable.get["rows"] - kept.get["rows"],
    )


def main(argv: Sequence[str] | None = None) -> DayReport:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--INPUT_PREFIX", required=True, help="landing folder")
    parser.add_argument("--OUTPUT_PREFIX", required=True, help="bar folder")
    parser.add_argument("--date", help="local dates YYYY-MM-DD,... or 'all' (default: today)")
    parser.add_argument("--raw-date", help="landing dates YYYY-MM-DD,... or 'all' (default: --date)")
    parser.add_argument("--days-back", type=int, default=0, help="start from an earlier today")
    parser.add_argument("--zone", default=DEFAULT_ZONE)
    parser.add_argument("--mode", choices=("dynamic", "static"), default="dynamic")
    parser.add_argument("--salvage", action="store_true")
    parser.add_argument("--json-lines", action="store_true", help="documents are JSON Lines")
    parser.add_argument("--writers", type=int, help="tasks that write folders")
    parser.add_argument("--compacted", help="archive of compacted landings")
    parser.add_argument("--layout", choices=("series", "dated"), default="series")
    args = parser.parse_args(argv)
    session_date = args.date or local_date(args.zone, args.days_back)

    def dates(given: date | str) -> Dates:
        return given.split(",") if isinstance(given, str) and given != ALL_DATES else given

    report = aggregate_day(
        get_session(f"bars-{session_date}"),
        args.INPUT_PREFIX.rstrip("/"),
        args.OUTPUT_PREFIX.rstrip("/"),
        dates(session_date),
        dates(args.raw_date or session_date),
        zone=args.zone,
        mode=args.mode,
        salvage=args.salvage,
        multi_line=not args.json_lines,
        writers=args.writers,
        layout=args.layout,
        compacted=args.compacted,
    )
    print(
        f"{session_date}: {report.candles} candles, {report.bars} bars from {report.documents} documents; "
        f"left out: {report.empty_documents} empty documents, {report.rejected} unusable candles, "
        f"{report.out_of_date} candles of other dates"
    )
    return report


if __name__ == "__main__":
    main()
