"""Column functions."""

from barloom.functions.clock import (
    as_date,
    bucket_epoch,
    clock_epoch,
    date_parts,
    day_bounds,
    day_start_epoch,
    fixed_offset,
    interval_epoch,
    local_date,
    nests,
    utc_clock,
    wall_clock,
)
from barloom.functions.keys import ingest_version, iso_date_parts, iso_instant, symbol_key

__all__ = [
    "as_date", "bucket_epoch", "clock_epoch", "date_parts", "day_bounds", "day_start_epoch",
    "fixed_offset", "ingest_version", "interval_epoch", "iso_date_parts", "iso_instant",
    "local_date", "nests", "symbol_key", "utc_clock", "wall_clock",
]
