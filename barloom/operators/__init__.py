"""DataFrame operators."""

from barloom.operators.bars import (
    all_timeframes, as_bars, common_home, ohlcv, on_session_date, placement_tasks, resample, union_timeframes,
    with_date_parts, with_interval,
)
from barloom.operators.branches import (
    attach, bucket_aggregates, bucket_closes, bucket_opens, first_of_group, home_keys, resample_by_joins,
    row_numbers,
)
from barloom.operators.candles import (
    base_rows, cached, candle_fields, clean_candles, complete_candles, dedup_latest,
    explode_candles, found_candles, nested_candles, on_session, usable_candles, with_candles,
    with_wall_clock,
)
from barloom.operators.coverage import absences, coverage_counts, coverage_tasks, expected_runs, run_coverage, run_of
from barloom.operators.outcomes import (
    dead_letters, failure_reasons, failures, run_metrics, run_summary, successes, symbol_counts,
)
from barloom.operators.quality import (
    judged, judged_candles, rejected_candles, salvaged_rows, triage_counts, triage_raw,
)
from barloom.operators.sessions import in_sessions, outside_sessions, session_bars, session_counts
from barloom.operators.versions import as_of, as_of_each, candle_versions, changes_between

__all__ = [
    "absences", "all_timeframes", "as_bars", "as_of", "as_of_each", "attach", "base_rows", "bucket_aggregates", "bucket_closes",
    "bucket_opens", "cached", "candle_fields", "candle_versions", "changes_between", "clean_candles", "common_home",
    "complete_candles", "coverage_counts", "coverage_tasks", "dead_letters", "dedup_latest", "expected_runs", "explode_candles", "failure_reasons", "failures",
    "first_of_group", "found_candles", "home_keys", "in_sessions", "judged", "judged_candles", "nested_candles", "ohlcv", "on_session",
    "on_session_date", "outside_sessions", "placement_tasks", "rejected_candles", "resample", "resample_by_joins", "row_numbers",
    "run_coverage", "run_metrics", "run_of", "run_summary", "salvaged_rows", "session_bars", "session_counts", "successes", "symbol_counts",
    "triage_counts", "triage_raw", "union_timeframes", "usable_candles", "with_candles", "with_date_parts",
    "with_interval", "with_wall_clock",
]
