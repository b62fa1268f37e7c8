"""Scans of the ticker list and of dead letters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from barloom.functions import as_date
from barloom.schema import DEAD_LETTER, DEAD_LETTER_PARTITIONS
from barloom.sources.files import empty_frame, load_matching


def parse_tickers(lines: DataFrame, column: str = "value") -> DataFrame:
    """Trimmed, non-blank lines as ``symbol``; repeats are kept."""
    symbol = F.regexp_replace(column, r"^\s+|\s+$", "")
    return lines.select(symbol.alias("symbol")).where("symbol <> ''")


def read_tickers(spark: SparkSession, path: str) -> DataFrame:
    """The ticker universe: a text file with one symbol per line."""
    return parse_tickers(spark.read.text(path))


def read_dead_letters(
    spark: SparkSession,
    base: str,
    failed_date: date | str | None = None,
    *,
    multi_line: bool = True,
) -> DataFrame:
    """Dead letters with partition strings; ``params_sent.symbol`` is the original symbol.

    Day folders named ``day=DD`` and ``day/DD`` are both read. ``multi_line`` fits one letter
    per file; pass False for JSON Lines.
    """
    patterns = []
    if failed_date is not None:
        year, month, day = f"{as_date(failed_date):%Y-%m-%d}".split("-")
        parent = f"symbol=*/year={year}/month={month}"
        patterns = [f"{parent}/day={day}", f"{parent}/day/{day}"]
    body = StructType([f for f in DEAD_LETTER.fields if f.name not in DEAD_LETTER_PARTITIONS])
    reader = spark.read.schema(body).option("multiLine", multi_line)
    # one listing whatever the layout: folder names are read off each letter's path
    reader = reader.option("recursiveFileLookup", True)
    letters = load_matching(spark, reader, "json", base, patterns)
    if letters is None:
        return empty_frame(spark, DEAD_LETTER)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    named = {n: F.regexp_extract(path, f"/{n}[=/]([^/]+)/", 1) for n in DEAD_LETTER_PARTITIONS}
    return letters.withColumns(named).select(*DEAD_LETTER.fieldNames())
