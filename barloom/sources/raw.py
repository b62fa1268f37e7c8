"""Scan of landed candle documents."""

from __future__ import annotations

import re
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from barloom.functions import as_date, ingest_version
from barloom.schema import ENVELOPE, RAW, RAW_TEXT
from barloom.sources.files import empty_frame, load_matching

_PLAIN_NAME = re.compile(r"[A-Za-z0-9_.&-]+")


def load_raw(
    spark: SparkSession,
    base: str,
    raw_date: date | str | Iterable[date | str] | None = None,
    *,
    exchange: str | None = None,
    text: bool = False,
    multi_line: bool = True,
) -> DataFrame | None:
    """``read_raw``, or None where no such folder has landed."""
    schema: StructType = RAW_TEXT if text else RAW
    if exchange is not None and not _PLAIN_NAME.fullmatch(exchange):
        raise ValueError(f"not the name of an exchange: {exchange!r}")
    series = f"symbol=*/exchange={exchange or '*'}"
    patterns = [] if exchange is None else [series]
    if raw_date is not None:
        one = isinstance(raw_date, (date, str))
        days = sorted({as_date(d) for d in ([raw_date] if one else raw_date)})
        patterns = [f"{series}/year={d:%Y}/month={d:%m}/day={d:%d}" for d in days]
        if not patterns:
            return None
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    documents = load_matching(spark, reader, "json", base, patterns)
    if documents is None:
        return None
    version = F.coalesce("ingest_ts", ingest_version(F.col("_metadata.file_name")))
    return documents.withColumn("ingest_ts", version)


def read_raw(
    spark: SparkSession,
    base: str,
    raw_date: date | str | Iterable[date | str] | None = None,
    *,
    exchange: str | None = None,
    text: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Landed documents with their partition strings and their version ``ingest_ts``.

    ``raw_date`` picks one or several landing days by folder; without it the whole archive is
    read. ``text`` keeps candle elements as strings and adds the triage fields.
    ``multi_line`` fits one document per file; pass False for JSON Lines, which can be split.
    ``ingest_ts`` is the document's own field or, without one, comes from its file name.
    """
    found = load_raw(
        spark, base, raw_date, exchange=exchange, text=text, multi_line=multi_line
    )
    return empty_frame(spark, RAW_TEXT if text else RAW) if found is None else found


def parse_raw(lines: DataFrame, column: str = "value") -> DataFrame:
    """Documents held as text in a column, parsed as ``read_raw(text=True)`` reads files."""
    body = [f for f in RAW_TEXT.fields if f.name in (ENVELOPE, "_corrupt_record")]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = F.from_json(column, StructType(body), options)
    # behind a generator of one row, so that no later step can repeat the parsing
    return lines.select(*[c for c in lines.columns if c != column], F.inline(F.array(parsed)))


def on_raw_date(raw: DataFrame, raw_date: date | str) -> DataFrame:
    """Documents landed on a date: a filter on the partition columns."""
    d = as_date(raw_date)
    return raw.where(
        (F.col("year") == f"{d:%Y}") & (F.col("month") == f"{d:%m}") & (F.col("day") == f"{d:%d}")
    )
