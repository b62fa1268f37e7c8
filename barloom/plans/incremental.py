"""Bars kept up to date batch by batch, from stored candles and without the raw documents.

Every batch of documents is parsed once. Its candles are added to a store by local date; the bars
whose buckets they fall in, and no others, are made again from the stored candles and put among
the bars of their dates (layout by width and date). The newest copy of a candle wins whatever the
order of the batches, so the bars equal those of one job over all documents.

The store holds ``candles/date=/batch=``, ``staged/<batch>`` and ``done/<batch>``, and ``work`` while a
batch is merged: what several steps read is made once and written there. The bars of the
touched dates are staged as a whole before any folder of the output is replaced, so a run that
ends half-way is finished by the next one, and a batch that was done is not done again.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from barloom.functions import as_date, interval_epoch, wall_clock
from barloom.operators import as_bars, base_rows, common_home, dedup_latest, ohlcv
from barloom.schema import BAR, DEFAULT_ZONE, SERIES, STORED_CANDLE, TIMEFRAMES, Timeframe
from barloom.sinks import write_dated_bars
from barloom.sources import read_dated_bars
from barloom.sources.files import child_names, delete_path, empty_frame, load_matching, path_exists, touch

_PLAIN_NAME = re.compile(r"[A-Za-z0-9_.-]+")
BUCKET = ("symbol", "timeframe", "interval_start_epoch")


@dataclass(frozen=True)
class MergeReport:
    """What a batch brought. Nothing is read or written for a batch that was done before."""

    candles: int = 0  # its own, one for each (symbol, ts)
    buckets: int = 0  # that they fall in, over all widths
    dates: int = 0  # of the bars of these buckets
    bars: int = 0  # written: all of these dates
    done_before: bool = False


def _batch_name(batch: int | str) -> str:
    name = f"{batch:012d}" if isinstance(batch, int) else batch
    if not _PLAIN_NAME.fullmatch(name):
        raise ValueError(f"not the name of a batch: {batch!r}")
    return name


def keep_candles(documents: DataFrame, store: str, batch: int | str, zone: str = DEFAULT_ZONE) -> None:
    """Add the newest copies within a batch to the store. Done again, it replaces what it wrote."""
    rows = dedup_latest(base_rows(documents))
    dated = rows.withColumn("date", wall_clock(F.col("ts"), zone).cast("date").cast("string"))
    (
        dated.withColumn("batch", F.lit(_batch_name(batch)))
        .repartition("date").sortWithinPartitions("date", "symbol", "ts")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", "batch").parquet(f"{store}/candles")
    )


def _copies(spark: SparkSession, store: str, patterns: Sequence[str]) -> DataFrame:
    found = None
    if path_exists(spark, f"{store}/candles"):
        found = load_matching(spark, spark.read.schema(STORED_CANDLE), "parquet", f"{store}/candles", patterns)
    return empty_frame(spark, STORED_CANDLE) if found is None else found


def stored_candles(spark: SparkSession, store: str, dates: Iterable[date | str] | None = None) -> DataFrame:
    """The newest copy of every stored candle, of some local dates or all; only their folders are listed."""
    patterns = [] if dates is None else [f"date={as_date(d):%Y-%m-%d}" for d in sorted({as_date(d) for d in dates})]
    copies = empty_frame(spark, STORED_CANDLE) if dates is not None and not patterns else _copies(spark, store, patterns)
    return dedup_latest(copies.drop("date", "batch"))


def _in_buckets(rows: DataFrame, timeframes: Sequence[Timeframe], zone: str) -> DataFrame:
    """Each row once for every width, with the bucket that holds it."""
    frames = F.array(*[
        F.struct(F.lit(t.label).alias("timeframe"), interval_epoch(F.col("ts"), t, zone).alias("interval_start_epoch"))
        for t in timeframes
    ])
    return rows.select("*", F.inline(frames))


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _finish(spark: SparkSession, store: str, output: str, name: str) -> None:
    """Put staged bars in place; may be done any number of times."""
    staged = f"{store}/staged/{name}"
    write_dated_bars(read_dated_bars(spark, staged), output)
    touch(spark, f"{store}/done/{name}")
    delete_path(spark, staged)


def merge_arrivals(
    spark: SparkSession,
    documents: DataFrame,
    store: str,
    output: str,
    batch: int | str,
    *,
    zone: str = DEFAULT_ZONE,
    timeframes: Sequence[Timeframe] = TIMEFRAMES,
) -> MergeReport:
    """Merge a batch of landed documents into the stored candles and the bars that they touch.

    Batches go one at a time; ``batch`` names this one, and a name is used once. The stored candles
    of the touched dates (and their neighbours where a bucket may cross midnight) are read, those of
    touched buckets are picked by a semi-join and aggregated, and the other bars of these dates stay
    as they are. Only the touched dates come to the driver.
    """
    store, output, name = store.rstrip("/"), output.rstrip("/"), _batch_name(batch)
    done = set(child_names(spark, f"{store}/done"))
    for earlier in child_names(spark, f"{store}/staged"):
        if earlier in done or not path_exists(spark, f"{store}/staged/{earlier}/_SUCCESS"):
            delete_path(spark, f"{store}/staged/{earlier}")  # put in place already, or not staged to the end
        else:
            _finish(spark, store, output, earlier)
            done.add(earlier)
    if name in done:
        return MergeReport(done_before=True)

    keep_candles(documents, store, name, zone)
    new = _copies(spark, store, [f"date=*/batch={name}"])
    days = [as_date(r.date) for r in new.select("date").distinct().collect()]
    if not days:
        touch(spark, f"{store}/done/{name}")
        return MergeReport()
    touched = _kept(_in_buckets(new.select("symbol", "ts"), timeframes, zone).select(*BUCKET).distinct(), f"{store}/work/touched")
    home = common_home(timeframes, zone)
    reach = 0 if home is not None and home.is_day else 1
    around = {d + timedelta(days=i) for d in days for i in range(-reach, reach + 1)}
    rows = _in_buckets(stored_candles(spark, store, around), timeframes, zone).join(touched, list(BUCKET), "left_semi")
    # the ranges of the write are found by a pass of their own, which would make the bars twice
    bars = _kept(as_bars(rows.groupBy(*SERIES, "timeframe", "interval_start_epoch").agg(*ohlcv()), zone), f"{store}/work/bars")

    # a bucket belongs to the date on which it starts
    started = wall_clock(F.col("interval_start_epoch"), zone).cast("date").alias("date")
    bar_days = [r.date for r in touched.select(started).distinct().collect()]
    old = empty_frame(spark, BAR)
    if path_exists(spark, output):
        old = read_dated_bars(spark, output, start=min(bar_days), end=max(bar_days))
        old = old.where(F.concat_ws("-", "year", "month", "day").isin([f"{d:%Y-%m-%d}" for d in bar_days]))
        old = old.where(F.col("timeframe").isin([t.label for t in timeframes])).join(touched, list(BUCKET), "left_anti")
    counted = Observation("bars")
    write_dated_bars(old.unionByName(bars), f"{store}/staged/{name}", mode="static", counted=counted)
    _finish(spark, store, output, name)
    report = MergeReport(new.count(), touched.count(), len(bar_days), counted.get["rows"])
    delete_path(spark, f"{store}/work")
    return report


def squash_candles(spark: SparkSession, store: str, dates: Iterable[date | str]) -> int:
    """Rewrite the batches of some dates as one, without superseded copies; the number of folders dropped.

    The new folder is written before the old ones go. What ends half-way leaves copies of the
    same candles, of which one counts.
    """
    store, days = store.rstrip("/"), sorted({as_date(d) for d in dates})
    old = [
        f"{store}/candles/date={d:%Y-%m-%d}/{name}" for d in days
        for name in child_names(spark, f"{store}/candles/date={d:%Y-%m-%d}") if name.startswith("batch=")
    ]
    if not old:
        return 0
    copies = _copies(spark, store, [f"date={d:%Y-%m-%d}" for d in days]).drop("batch")
    (
        dedup_latest(copies).withColumn("batch", F.lit(f"squashed-{uuid.uuid4().hex}"))
        .repartition("date").sortWithinPartitions("date", "symbol", "ts")
        .write.mode("append").partitionBy("date", "batch").parquet(f"{store}/candles")
    )
    for folder in old:
        delete_path(spark, folder)
    return len(old)
