"""Keep bar folders up to date as documents land.

The scheduled rerun as a stream: each micro-batch finds the local dates of its own candles and
rebuilds those days with one batch job. Late and revised candles therefore count as they do
there, and a repeated batch overwrites the same folders with the same bars.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.functions import ingest_version, wall_clock
from barloom.operators import base_rows
from barloom.plans.day_job import aggregate_day
from barloom.plans.incremental import merge_arrivals
from barloom.schema import DEFAULT_ZONE, RAW
from barloom.sources import read_raw


def touched_dates(documents: DataFrame, zone: str = DEFAULT_ZONE) -> tuple[list[date], list[date]]:
    """Local dates of a batch's candles, and its landing dates: a row per date, not per document.

    Folders that are no date are passed over.
    """
    landed = F.try_to_date(F.concat_ws("-", "year", "month", "day"), "yyyy-MM-dd")
    rows = base_rows(documents.withColumn("exchange", F.struct("exchange", landed.alias("landed"))))
    dates = rows.select(
        wall_clock(F.col("ts"), zone).cast("date").alias("local"), "exchange.landed"
    ).distinct().collect()
    local = sorted({r.local for r in dates if r.local})
    return local, sorted({r.landed for r in dates if r.landed})


def landings(documents: DataFrame, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Pairs of a candle's local date and the date it landed on: ``local``, ``landed``."""
    landed = F.try_to_date(F.concat_ws("-", "year", "month", "day"), "yyyy-MM-dd")
    rows = base_rows(documents.withColumn("exchange", F.struct("exchange", landed.alias("landed"))))
    pairs = rows.select(wall_clock(F.col("ts"), zone).cast("date").alias("local"), "exchange.landed")
    return pairs.where("local is not null and landed is not null").distinct()


def rebuild_on_arrival(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint_path: str,
    *,
    zone: str = DEFAULT_ZONE,
    multi_line: bool = True,
    interval: str | None = None,
    landing_reach: int = 1,
) -> StreamingQuery:
    """Start the stream. Without ``interval`` it handles what has landed and then ends.

    Each batch is one job over all local dates that its candles touch. It reads every landing date on
    record for them, however late, and those up to ``landing_reach`` days around. The record is a
    table in ``checkpoint_path``, to which each batch adds its own pairs first; a stream begun without
    one goes through the whole archive once. ``checkpoint_path`` must be a folder the whole cluster
    can reach.
    """
    record = f"{str(checkpoint_path).rstrip('/')}/landings"

    def on_record() -> bool:
        path = spark._jvm.org.apache.hadoop.fs.Path(record)
        return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)

    def rebuild(documents: DataFrame, batch_id: int) -> None:
        local, landed = touched_dates(documents, zone)
        new = documents if batch_id == 0 or on_record() else read_raw(spark, input_path, multi_line=multi_line)
        landings(new, zone).write.mode("overwrite").parquet(f"{record}/batch={batch_id}")
        if not local:
            return
        known = spark.read.schema("local date, landed date").parquet(record)
        landed += [r.landed for r in known.where(F.col("local").isin(local)).select("landed").distinct().collect()]
        around = {d + timedelta(days=i) for d in local for i in range(-landing_reach, landing_reach + 1)}
        aggregate_day(
            spark, input_path, output_path, local, sorted({*around, *landed}), zone=zone, multi_line=multi_line
        )

    arrivals = (
        spark.readStream.schema(RAW).option("multiLine", multi_line).json(input_path)
    )
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        arrivals.writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**trigger)
        .start()
    )


def merge_on_arrival(
    spark: SparkSession,
    input_path: str,
    store_path: str,
    output_path: str,
    checkpoint_path: str,
    *,
    zone: str = DEFAULT_ZONE,
    multi_line: bool = True,
    interval: str | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start a stream that merges each batch into stored candles and bars; see ``merge_arrivals``.

    A document is parsed once, in the batch it lands in; late and revised candles meet the stored
    ones, however old. Bars lie by width and date. A batch that is repeated after a failure changes
    nothing further. Without ``interval`` the stream handles what has landed and then ends.
    """
    reader = spark.readStream.schema(RAW).option("multiLine", multi_line)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    version = F.coalesce("ingest_ts", ingest_version(F.col("_metadata.file_name")))

    def merge(documents: DataFrame, batch_id: int) -> None:
        merge_arrivals(spark, documents, store_path, output_path, batch_id, zone=zone)

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return (
        reader.json(input_path).withColumn("ingest_ts", version)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_path)
        .trigger(**trigger)
        .start()
    )
