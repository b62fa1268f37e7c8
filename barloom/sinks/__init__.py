"""Partitioned writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.functions import iso_date_parts, symbol_key
from barloom.schema import (
    BAR_PARTITIONS, DEAD_LETTER_PARTITIONS, DEFAULT_EXCHANGE, ENVELOPE, RAW_PARTITIONS,
)
from barloom.sinks.dated import write_dated_bars


def folder_writers(spark: SparkSession) -> int:
    """Tasks to spread many small folders over.

    A bar folder holds one day of one series, so writing costs by folder and not by byte.
    Merging small shuffle partitions by size would line thousands of folders up in a few tasks.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_bars(
    bars: DataFrame, path: str, mode: str = "dynamic", clustered: bool = False,
    writers: int | None = None,
) -> None:
    """Write bars as snappy Parquet under their six partition folders.

    ``dynamic`` replaces only the folders present in ``bars``, so a rerun of a day leaves other
    days alone; ``static`` replaces the whole target. Rows are brought together by folder first,
    which is safe as a folder holds at most one day of bars; ``clustered`` says that they
    already are, as after ``all_timeframes``. ``writers`` is the number of tasks otherwise.
    """
    if mode not in ("dynamic", "static"):
        raise ValueError(f"unknown overwrite mode {mode!r}")
    if not clustered:
        bars = bars.repartition(writers or folder_writers(bars.sparkSession), *BAR_PARTITIONS)
    (
        # the writer needs this order by folder anyway; time last makes row-group ranges narrow
        bars.sortWithinPartitions(*BAR_PARTITIONS, "interval_start_epoch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("compression", "snappy")
        .partitionBy(*BAR_PARTITIONS)
        .parquet(path)
    )


def land_raw(documents: DataFrame, path: str, one_per_file: bool = True) -> None:
    """Append payloads ``(symbol, ingest_ts, envelope[, exchange])`` to the landing folder.

    Payloads that report an error are not landed. The original symbol stays in the document as
    ``ticker``, since its folder name is lossy, and ``ingest_ts`` as a field, since Spark names
    the files. ``one_per_file`` matches readers that take each file as one document; without it
    documents become JSON Lines, which suits large volumes.
    """
    if "exchange" not in documents.columns:
        documents = documents.withColumn("exchange", F.lit(DEFAULT_EXCHANGE))
    if "s" in documents.select(f"{ENVELOPE}.*").columns:
        status = F.col(f"{ENVELOPE}.s")
        documents = documents.where(status.isNull() | (status != "error"))
    landed = documents.withColumns({
        "ticker": F.col("symbol"),
        "symbol": symbol_key(F.col("symbol")),
        **iso_date_parts(F.col("ingest_ts")),
    })
    _append_json(landed, path, RAW_PARTITIONS, one_per_file)


def write_dead_letters(letters: DataFrame, path: str, one_per_file: bool = True) -> None:
    """Append dead letters by symbol and UTC date of failure, laid out as in ``land_raw``."""
    keyed = letters.withColumns({
        "symbol": symbol_key(F.col("symbol")), **iso_date_parts(F.col("failed_at")),
    })
    _append_json(keyed, path, DEAD_LETTER_PARTITIONS, one_per_file)


def _append_json(rows: DataFrame, path: str, folders: Sequence[str], one_per_file: bool) -> None:
    if not one_per_file:  # folders may be hot here: adaptive execution splits the large ones
        rows = rows.hint("rebalance", *[F.col(c) for c in folders])
    (
        rows.write.mode("append")
        .option("maxRecordsPerFile", 1 if one_per_file else 0)
        .partitionBy(*folders)
        .json(path)
    )


__all__ = ["folder_writers", "land_raw", "write_bars", "write_dated_bars", "write_dead_letters"]
