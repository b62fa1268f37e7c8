"""OHLCV bars on Spark: landed candle documents to partitioned bars, and the tables around it."""

from barloom.schema import TIMEFRAMES, Timeframe

__all__ = ["TIMEFRAMES", "Timeframe"]
