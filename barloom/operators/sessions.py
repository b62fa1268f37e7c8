"""Bars by a calendar of trading sessions: any opening hours, half days, buckets from the open.

A session is a row ``(exchange, session, opens, closes)``, epochs of a half-open interval; sessions of
one exchange do not overlap.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barloom.functions import wall_clock
from barloom.operators.bars import ohlcv
from barloom.schema import DAY_SECONDS, DEFAULT_ZONE, SERIES

SESSION = ("exchange", "session", "opens", "closes")


def _bin(ts: Column, width: int) -> Column:
    return F.floor(ts / width)


def _by_bin(sessions: DataFrame, width: int) -> DataFrame:
    """Each session once for every bin of time that it reaches into."""
    last = F.greatest(F.col("closes") - 1, F.col("opens"))
    bins = F.sequence(_bin(F.col("opens"), width), _bin(last, width))
    return sessions.select(F.col("exchange").alias("of"), "session", "opens", "closes", F.explode(bins).alias("bin"))


def _meet(ts: Column) -> Column:
    return (F.col("exchange") == F.col("of")) & (F.col("at") == F.col("bin")) & (ts >= F.col("opens")) & (ts < F.col("closes"))


def in_sessions(rows: DataFrame, sessions: DataFrame, bin_seconds: int = DAY_SECONDS) -> DataFrame:
    """Rows inside a session, with ``session``, ``opens`` and ``closes``.

    An equi-join by exchange and bin of time, filtered by the interval inside it. Where a bin is
    hot, adaptive execution splits its rows; with sessions of minutes take narrower bins.
    """
    binned = rows.withColumn("at", _bin(F.col("ts"), bin_seconds))
    return binned.join(_by_bin(sessions, bin_seconds), _meet(F.col("ts"))).drop("of", "bin", "at")


def outside_sessions(rows: DataFrame, sessions: DataFrame, bin_seconds: int = DAY_SECONDS) -> DataFrame:
    """The other rows: those that no session of their exchange holds, or without exchange or ``ts``."""
    binned = rows.withColumn("at", _bin(F.col("ts"), bin_seconds))
    return binned.join(_by_bin(sessions, bin_seconds), _meet(F.col("ts")), "left_anti").drop("at")


def session_bars(
    rows: DataFrame, sessions: DataFrame, seconds: int | None = None, zone: str = DEFAULT_ZONE, bin_seconds: int = DAY_SECONDS
) -> DataFrame:
    """Bars of buckets that begin at the open of a session, or of whole sessions without ``seconds``.

    The last bucket of a session ends with it, so it may be shorter. Columns: ``symbol``, ``exchange``,
    ``session``, ``interval_start`` (wall clock), ``interval_start_epoch``, ``interval_end_epoch`` and
    the values. Rows outside every session take no part; rows of one series do not share a ``ts``.
    """
    placed = in_sessions(rows, sessions, bin_seconds)
    start = F.col("opens")
    end = F.col("closes")
    if seconds is not None:
        start = start + F.floor((F.col("ts") - start) / seconds) * seconds
        end = F.least(start + seconds, end)
    keyed = placed.withColumns({"interval_start_epoch": start, "interval_end_epoch": end})
    bars = keyed.groupBy(*SERIES, "session", "interval_start_epoch", "interval_end_epoch").agg(*ohlcv())
    clocked = bars.withColumn("interval_start", wall_clock(F.col("interval_start_epoch"), zone))
    return clocked.select(
        *SERIES, "session", "interval_start", "interval_start_epoch", "interval_end_epoch", "open", "high", "low", "close", "volume"
    )


def session_counts(rows: DataFrame, sessions: DataFrame, bin_seconds: int = DAY_SECONDS) -> DataFrame:
    """Rows inside and outside of sessions by exchange: what a calendar leaves out."""
    inside = in_sessions(rows, sessions, bin_seconds).select("exchange", F.lit(True).alias("inside"))
    outside = outside_sessions(rows, sessions, bin_seconds).select("exchange", F.lit(False).alias("inside"))
    return inside.unionByName(outside).groupBy("exchange").agg(
        F.count_if("inside").alias("inside"), F.count_if(~F.col("inside")).alias("outside")
    )
