"""Scans."""

from barloom.sources.bars import read_bars
from barloom.sources.dated import read_dated_bars
from barloom.sources.lists import parse_tickers, read_dead_letters, read_tickers
from barloom.sources.raw import load_raw, on_raw_date, parse_raw, read_raw
from barloom.sources.tables import create_bar_functions, create_bar_table, sync_bar_table

__all__ = [
    "create_bar_functions", "create_bar_table", "load_raw", "on_raw_date", "parse_raw", "parse_tickers", "read_bars", "read_dated_bars", "read_dead_letters", "read_raw",
    "read_tickers", "sync_bar_table",
]
