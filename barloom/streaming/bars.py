"""Bars as a stream, from the newest copy of every candle.

Two stateful aggregations in a row under one watermark: the copies of a (symbol, ts) become the
newest one, which is let go when the watermark passes it, and the newest copies become bars, which
are let go when it passes their end. So a revision counts as long as it comes within the delay,
unlike with a deduplication, which keeps the first copy; and state holds the candles of the delay and
the open bars, however long the stream runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.functions import clock_epoch, ingest_version, interval_epoch, wall_clock
from barloom.operators import as_bars, base_rows, ohlcv
from barloom.operators.bars import VALUES
from barloom.schema import CANDLE_VERSION, DATED_COLUMNS, DEFAULT_ZONE, RAW, Timeframe
from barloom.sinks.dated import with_date


def newest_candles(rows: DataFrame, delay: str, timeframe: Timeframe, zone: str = DEFAULT_ZONE) -> DataFrame:
    """The newest copy of each (symbol, ts) of a stream, once no further one can come.

    As in ``dedup_latest``: the latest version, then the other columns. ``event_time`` is the
    instant of ``ts`` or, for daily bars, its local wall clock, whose days are the bars'.
    """
    ts = F.col("ts")
    seconds = clock_epoch(wall_clock(ts, zone)) if timeframe.is_day else ts
    versions = [c for c in CANDLE_VERSION if c in rows.columns]
    if not versions:
        raise ValueError(f"no version column: the rows have none of {', '.join(CANDLE_VERSION)}")
    timed = rows.withColumn("event_time", F.timestamp_seconds(seconds)).withWatermark("event_time", delay)
    newest = F.max(F.struct(*versions, "exchange", *VALUES)).alias("newest")
    return timed.groupBy("event_time", "symbol", "ts").agg(newest).select("event_time", "symbol", "ts", "newest.*").drop(*versions)


def stream_bars(rows: DataFrame, timeframe: Timeframe, delay: str, zone: str = DEFAULT_ZONE) -> DataFrame:
    """Bars of one width from a stream of candle rows with copies, for append mode.

    A bar is given out once, when the watermark (the latest candle less ``delay``) has passed its end.
    Rows that come later than that are dropped, and counted in the query's progress; the jobs over
    stored candles or raw documents take those in. Works on a batch as well, without the delay.
    """
    newest = newest_candles(rows, delay, timeframe, zone)
    window = F.window("event_time", f"{timeframe.seconds} seconds")
    bars = newest.groupBy(window, "symbol", "exchange").agg(
        *ohlcv(), interval_epoch(F.min("ts"), timeframe, zone).alias("interval_start_epoch")
    )
    return as_bars(bars.withColumn("timeframe", F.lit(timeframe.label)), zone)


def start_bar_stream(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    checkpoint_path: str,
    timeframe: Timeframe,
    *,
    delay: str = "1 day",
    zone: str = DEFAULT_ZONE,
    multi_line: bool = True,
    interval: str | None = None,
    files_per_batch: int | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Stream landed documents to bars of one width, by width and date; one stream a width.

    Each batch writes the bars it closes to folders of its own below their date
    (``timeframe=/date=/batch=``), so a repeated batch replaces what it wrote and
    ``read_dated_bars`` finds every bar once. Without ``interval`` the stream handles what has landed
    and then ends; bars that are still open stay in its state. ``state_partitions`` fixes, for the
    life of the checkpoint, over how many tasks the state is spread (default
    ``spark.sql.shuffle.partitions``).
    """
    reader = spark.readStream.schema(RAW).option("multiLine", multi_line)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    version = F.coalesce("ingest_ts", ingest_version(F.col("_metadata.file_name")))
    rows = base_rows(reader.json(input_path).withColumn("ingest_ts", version))

    def put(bars: DataFrame, batch_id: int) -> None:
        (
            with_date(bars).select(*DATED_COLUMNS, F.lit(f"{batch_id:012d}").alias("batch"))
            .repartition("date").sortWithinPartitions("date", "symbol", "interval_start_epoch")
            .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("timeframe", "date", "batch").parquet(output_path)
        )

    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    writer = (
        stream_bars(rows, timeframe, delay, zone).writeStream.outputMode("append")
        .foreachBatch(put).option("checkpointLocation", checkpoint_path).trigger(**trigger)
    )
    if state_partitions is None:
        return writer.start()
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(state_partitions))  # a stream keeps the settings it was started with
    try:
        return writer.start()
    finally:
        spark.conf.set(name, before)
