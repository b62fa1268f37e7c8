"""Names used in folders: symbol keys and partition values of a landing instant."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def symbol_key(symbol: Column) -> Column:
    """Folder-safe symbol: ``:`` and ``/`` become ``_``. Lossy, so keep the symbol beside it."""
    return F.translate(symbol, ":/", "__")


def iso_date_parts(instant: Column) -> dict[str, Column]:
    """``year``, ``month``, ``day`` strings of an ISO instant, in the instant's own zone."""
    parts = F.split(F.split(instant, "T").getItem(0), "-")
    return {name: F.get(parts, F.lit(i)) for i, name in enumerate(("year", "month", "day"))}


def iso_instant(clock: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SSZ`` of a UTC wall clock, fractions cut off."""
    return F.concat(F.translate(F.left(clock.cast("string"), F.lit(19)), " ", "T"), F.lit("Z"))


def ingest_version(file_name: Column) -> Column:
    """The landing instant in an ``ingest-<instant>.json`` file name, else null."""
    return F.nullif(F.regexp_extract(file_name, r"^ingest-(.*)[.]json$", 1), F.lit(""))
