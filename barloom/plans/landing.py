"""Compaction of landings of one file a fetch into Parquet, with a ledger of the files taken in.

``documents/year=/month=/day=/batch=N`` holds the documents, ``ledger/batch=N`` the files they came
from. A batch counts once its ledger is there, which is written last; batches are numbered without
gaps, so whatever has a higher number than the last ledger was left by a run that ended half-way and
is written again. What has landed since, the tail, is read from its files.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from barloom.functions import as_date, ingest_version
from barloom.schema import RAW, RAW_TEXT
from barloom.sources.files import child_names, delete_path, empty_frame, literal_path, load_matching, matching_folders, path_exists

Dates = date | str | Iterable[date | str] | None
#: Files of one batch; a batch's names come to the driver, which lists them anyway.
FILES = 100_000
_BATCH = "batch="


@dataclass(frozen=True)
class CompactionReport:
    """What a run took in. Without new files it writes nothing."""

    files: int = 0
    batches: int = 0


def _days(raw_date: Dates) -> list[date] | None:
    if raw_date is None:
        return None
    return sorted({as_date(d) for d in ([raw_date] if isinstance(raw_date, (date, str)) else raw_date)})


def last_batch(spark: SparkSession, compacted: str) -> int:
    """The number of the last batch that counts; 0 without any."""
    numbers = [int(n.removeprefix(_BATCH)) for n in child_names(spark, f"{compacted}/ledger") if n.startswith(_BATCH)]
    whole = [n for n in numbers if path_exists(spark, f"{compacted}/ledger/{_BATCH}{n}/_SUCCESS")]
    return max(whole, default=0)


def _ledger(spark: SparkSession, compacted: str) -> DataFrame:
    last = last_batch(spark, compacted)
    if not last:
        return empty_frame(spark, StructType([StructField("path", StringType())]))
    return spark.read.schema("path string, batch int").parquet(f"{compacted}/ledger").where(F.col("batch") <= last).select("path")


def tail_files(spark: SparkSession, raw: str, compacted: str, raw_date: Dates = None) -> DataFrame:
    """Landed files that no batch has taken in, by ``path``: a listing, no file is opened."""
    days = _days(raw_date)
    patterns = [] if days is None else [f"symbol=*/exchange=*/year={d:%Y}/month={d:%m}/day={d:%d}" for d in days]
    found = None if days == [] else load_matching(spark, spark.read, "binaryFile", raw, patterns)
    if found is None:
        return _ledger(spark, compacted).limit(0)
    landed = found.where(F.col("path").endswith(".json")).select("path")
    return landed.join(_ledger(spark, compacted), "path", "left_anti")


def _read_files(spark: SparkSession, raw: str, paths: list[str], text: bool, multi_line: bool) -> DataFrame:
    reader = spark.read.schema(RAW_TEXT if text else RAW).option("multiLine", multi_line).option("basePath", raw)
    documents = reader.json([literal_path(p) for p in paths])
    return documents.withColumn("ingest_ts", F.coalesce("ingest_ts", ingest_version(F.col("_metadata.file_name"))))


def compact_landing(
    spark: SparkSession,
    raw: str,
    compacted: str,
    raw_date: Dates = None,
    *,
    text: bool = False,
    multi_line: bool = True,
    files: int = FILES,
) -> CompactionReport:
    """Take the documents of new files into the archive, at most ``files`` of them a batch.

    A file is known by its path, as landed files do not change. ``text`` and ``multi_line`` are as
    in ``read_raw``; an archive is of one kind. Files are left where they are. One run at a time.
    """
    raw, compacted = raw.rstrip("/"), compacted.rstrip("/")
    taken = batches = 0
    while True:
        paths = [r.path for r in tail_files(spark, raw, compacted, raw_date).orderBy("path").limit(files).collect()]
        if not paths:
            return CompactionReport(taken, batches)
        batch = last_batch(spark, compacted) + 1
        for folder in matching_folders(spark, f"{compacted}/documents", [f"year=*/month=*/day=*/{_BATCH}{batch}"]):
            delete_path(spark, folder.replace("\\", ""))  # of a run that ended half-way
        documents = _read_files(spark, raw, paths, text, multi_line).withColumn("batch", F.lit(batch))
        (
            # a hot landing date is split by adaptive execution
            documents.hint("rebalance", F.col("year"), F.col("month"), F.col("day"))
            .sortWithinPartitions("year", "month", "day", "symbol", "ingest_ts")
            .write.mode("append").option("compression", "snappy")
            .partitionBy("year", "month", "day", "batch").parquet(f"{compacted}/documents")
        )
        ledger = spark.createDataFrame([(p,) for p in paths], "path string")
        ledger.write.mode("overwrite").parquet(f"{compacted}/ledger/{_BATCH}{batch}")
        taken, batches = taken + len(paths), batches + 1


def read_landed(
    spark: SparkSession,
    raw: str,
    compacted: str,
    raw_date: Dates = None,
    *,
    text: bool = False,
    multi_line: bool = True,
) -> DataFrame:
    """Documents as ``read_raw`` has them: those in the archive, and the tail from its files.

    ``raw_date`` picks landing days by folder in both. The tail's names come to the driver.
    """
    raw, compacted, days = raw.rstrip("/"), compacted.rstrip("/"), _days(raw_date)
    schema = RAW_TEXT if text else RAW
    stored = None
    last = last_batch(spark, compacted)
    if last and days != []:
        patterns = [] if days is None else [f"year={d:%Y}/month={d:%m}/day={d:%d}" for d in days]
        reader = spark.read.schema(StructType([*schema.fields, StructField("batch", IntegerType())]))
        stored = load_matching(spark, reader, "parquet", f"{compacted}/documents", patterns)
    names = schema.fieldNames()
    stored = empty_frame(spark, schema) if stored is None else stored.where(F.col("batch") <= last)
    paths = [r.path for r in tail_files(spark, raw, compacted, raw_date).collect()]
    if not paths:
        return stored.select(names)
    return stored.select(names).unionByName(_read_files(spark, raw, paths, text, multi_line).select(names))
