"""Bars by width and date: few folders, files sorted by symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from barloom.schema import DATED_COLUMNS, DATED_PARTITIONS


def with_date(bars: DataFrame) -> DataFrame:
    """Bars in the columns of this layout: the three date strings as one ``date``."""
    return bars.withColumn("date", F.concat_ws("-", "year", "month", "day")).select(*DATED_COLUMNS)


def write_dated_bars(
    bars: DataFrame,
    path: str,
    mode: str = "dynamic",
    files: int | None = None,
    row_group_bytes: int | None = None,
    symbols: int = 10_000,
    counted: Observation | None = None,
) -> None:
    """Write bars as snappy Parquet under ``timeframe=/date=``, one folder a width and day.

    ``dynamic`` replaces only the dates present in ``bars``, each with all its symbols; ``static``
    replaces the whole target. Rows are dealt out by ranges of (width, date, symbol), so a hot width
    is spread over files, each of which holds a narrow range of symbols that its statistics tell;
    a Bloom filter, sized for ``symbols`` a row group, rules out those inside the range.
    ``files`` fixes the number of ranges, which adaptive execution would otherwise choose by size.
    ``counted`` gets the number of ``rows`` written; an observation of ``bars`` would also see those
    that are looked at to find the ranges.
    """
    if mode not in ("dynamic", "static"):
        raise ValueError(f"unknown overwrite mode {mode!r}")
    dated = with_date(bars)
    order = (*DATED_PARTITIONS, "symbol", "exchange", "interval_start_epoch")
    keys = order[:-1] if files is None else (files, *order[:-1])
    placed = dated.repartitionByRange(*keys)
    if counted is not None:
        placed = placed.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = (
        placed.sortWithinPartitions(*order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("compression", "snappy")
        .option("parquet.bloom.filter.enabled#symbol", "true")
        .option("parquet.bloom.filter.expected.ndv#symbol", str(symbols))
    )
    if row_group_bytes is not None:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.partitionBy(*DATED_PARTITIONS).parquet(path)
