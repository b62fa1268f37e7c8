"""Candles, documents, outcomes and tickers read off the given tables.

Every feed is a narrow projection of a whole table, so its size follows the table's. Shapes
(copies, empty or broken documents, failures) follow from the row's own ``value``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.functions import clock_epoch, iso_instant
from barloom.operators.bars import VALUES
from barloom.schema import DEFAULT_EXCHANGE, ENVELOPE, MISSING_CREDENTIALS

TICK_VERSION = ("ingest_seq", "row_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prices(price: Column, volume: Column) -> list[Column]:
    """Distinct open, high, low and close around one price, so that a mix-up shows."""
    return [
        price.alias("open"), (price + 1).alias("high"), (price - 1).alias("low"),
        (price + 0.25).alias("close"), volume.alias("volume"),
    ]


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tick per event; low values are delivered again with a corrected volume."""
    events = table(spark, sf_dir, "events")
    deliveries = F.when(F.col("value") < 8, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    volume = (F.col("event_id") % 1000).cast("double") + F.col("ingest_seq") - 1
    return events.withColumn("ingest_seq", F.explode(deliveries)).select(
        F.col("event_type").alias("symbol"),
        F.lit(DEFAULT_EXCHANGE).alias("exchange"),
        clock_epoch(F.col("ts")).alias("ts"),
        *prices(F.col("value"), volume),
        "ingest_seq",
        F.col("event_id").alias("row_id"),
    )


def order_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tick per order: few series, and many orders in the same second of each."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("symbol"),
        F.lit("ORD").alias("exchange"),
        clock_epoch(F.col("o_orderdate")).alias("ts"),
        *prices(F.col("o_totalprice"), F.col("o_custkey").cast("double")),
        F.lit(1).alias("ingest_seq"),
        F.col("o_orderkey").alias("row_id"),
    )


def lineitem_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tick per order line: many series on two exchanges, a minute per line number."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_linestatus").alias("exchange"),
        (clock_epoch(F.col("l_shipdate")) + F.col("l_linenumber") * 60).alias("ts"),
        *prices(F.col("l_extendedprice"), F.col("l_quantity")),
        F.lit(1).alias("ingest_seq"),
        F.col("l_orderkey").alias("row_id"),
    )


def _event_symbol() -> Column:
    return F.concat(F.lit("NSE:"), F.upper("event_type"), F.lit("-EQ"))


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per event: no candles, none inside, a short one, or two whole ones."""
    ticks = table(spark, sf_dir, "events").select(
        _event_symbol().alias("symbol"),
        F.lit(DEFAULT_EXCHANGE).alias("exchange"),
        iso_instant(F.col("ts")).alias("ingest_ts"),
        clock_epoch(F.col("ts")).cast("double").alias("t"),
        *prices(F.col("value"), (F.col("event_id") % 1000).cast("double")),
    )
    value = F.col("open")
    whole = F.array("t", *VALUES)
    short = F.array("t", "open", "high")
    longer = F.array(F.col("t") + 60, *VALUES, F.lit(9.0))
    candles = (
        F.when(value < 1, None)
        .when(value < 2, F.array().cast("array<array<double>>"))
        .when(value < 3, F.array(short, whole))
        .otherwise(F.array(whole, longer))
    )
    status = F.when(value < 0.5, "error").when(value < 2, "no_data").otherwise("ok")
    return ticks.select(
        "symbol", "exchange", "ingest_ts",
        F.struct(candles.alias("candles"), status.alias("s")).alias(ENVELOPE),
    )


def day_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per symbol and UTC day with all its candles, one for each second at most.

    A document is bounded by the 86,400 seconds of its day, and so is what meets in one group.
    """
    ticks = event_ticks(spark, sf_dir).where("ingest_seq = 1").select(
        F.concat(F.lit("NSE:"), F.upper("symbol"), F.lit("-EQ")).alias("symbol"), "exchange", "ts", *VALUES, "row_id"
    )
    key = ("symbol", "exchange", "ts")
    single = ticks.groupBy(*key).agg(F.max_by(F.struct(*VALUES), "row_id").alias("v"))
    day = single.groupBy("symbol", "exchange", F.floor(F.col("ts") / 86_400).alias("d")).agg(
        F.sort_array(F.collect_list(F.struct("ts", "v"))).alias("rows")
    )
    candles = F.transform("rows", lambda r: F.array(
        r["ts"].cast("double"), *[r["v"][name].cast("double") for name in VALUES]
    ))
    return day.select(
        "symbol", "exchange", iso_instant(F.timestamp_seconds(F.col("d") * 86_400).cast("timestamp_ntz")).alias("ingest_ts"),
        F.struct(candles.alias("candles"), F.lit("ok").alias("s")).alias(ENVELOPE),
    )


def delivery_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload a delivered tick, with ``ingest_seq``; the version rises as deliveries do."""
    ticks = event_ticks(spark, sf_dir)
    instant = iso_instant(F.timestamp_seconds(F.col("ts")).cast("timestamp_ntz"))
    version = F.concat(instant, F.format_string("#%d-%012d", "ingest_seq", "row_id"))
    candle = F.array(*[F.col(c).cast("double") for c in ("ts", *VALUES)])
    return ticks.select(
        "symbol", "exchange", version.alias("ingest_ts"), "ts", "ingest_seq",
        F.struct(F.array(candle).alias("candles"), F.lit("ok").alias("s")).alias(ENVELOPE),
    )


def tick_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks as candle rows with a version: a second delivery came ten days after the first."""
    ticks = event_ticks(spark, sf_dir)
    landed = F.timestamp_seconds(F.col("ts") + (F.col("ingest_seq") - 1) * 864_000).cast("timestamp_ntz")
    return ticks.select(
        "symbol", "exchange", "ts", *VALUES, iso_instant(landed).alias("ingest_ts"), F.col("row_id").alias("pos")
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of the dates of events: 09:15 to 15:30 local, to 12:30 where the day divides by 7, none on Sundays."""
    days = table(spark, sf_dir, "events").agg(F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("session")
    ).where(F.dayofweek("session") != 1)
    midnight = F.unix_date("session").cast("bigint") * 86_400 - 19_800
    length = F.when(F.dayofmonth("session") % 7 == 0, 11_700).otherwise(22_500)
    return days.select(
        F.lit(DEFAULT_EXCHANGE).alias("exchange"), "session", (midnight + 33_300).alias("opens"), (midnight + 33_300 + length).alias("closes")
    )


def event_document_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of one document per event, some of them broken in one of the known ways."""
    price = F.col("value").cast("string")
    ts = clock_epoch(F.col("ts")).cast("string")

    def candle(*elements: str | Column) -> Column:
        return F.concat(F.lit("["), F.concat_ws(", ", *[
            F.lit(e) if isinstance(e, str) else e for e in elements
        ]), F.lit("]"))

    def body(name: str, text: Column) -> Column:
        return F.concat(F.lit(f'{{"{ENVELOPE}": {{"{name}": '), text, F.lit("}}"))

    def listed(*candles: Column) -> Column:
        return F.concat(F.lit("["), F.concat_ws(", ", *candles), F.lit("]"))

    good = candle(ts, price, price, price, price, "7")
    value = F.col("value")
    text = (
        F.when(value < 1, body("s", F.lit('"no_data"')))
        .when(value < 2, body("candles", F.lit("[]")))
        .when(value < 3, body("raw_text", F.lit('"<html>busy</html>"')))
        .when(value < 4, F.concat(F.lit(f'{{"{ENVELOPE}": {{"candles": [['), ts))
        .when(value < 5, body("candles", listed(
            candle(ts, '"x"', price, price, price, "7"), good, candle(ts, price, price)
        )))
        .when(value < 6, body("candles", listed(
            candle(ts, '"7d"', price, price, price, "7"), good,
            candle(ts, price, price, '"0x1p3"', price, "7"),
        )))
        .when(value < 8, body("candles", listed(
            F.lit("null"), candle("null", price, price, price, price, "7"),
            candle(ts, "null", price, price, price, "7", "8"),
        )))
        .otherwise(body("candles", listed(good)))
    )
    return table(spark, sf_dir, "events").select(
        _event_symbol().alias("symbol"),
        F.lit(DEFAULT_EXCHANGE).alias("exchange"),
        iso_instant(F.col("ts")).alias("ingest_ts"),
        text.alias("value"),
    )


def event_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fetch outcome per event, with its instant: successes and three kinds of failure."""
    value = F.col("value")
    attempts = (
        F.when(value < 2, 1).when(value < 9, 5).when(value < 10, 0)
        .otherwise(1 + F.floor(value / 100)).cast("int")
    )
    return table(spark, sf_dir, "events").select(
        F.when((value < 9) | (value >= 10), _event_symbol()).alias("symbol"),
        (value >= 10).alias("ok"),
        attempts.alias("attempts"),
        F.when(value >= 10, 200).cast("int").alias("http_status"),
        F.when(value < 2, MISSING_CREDENTIALS).when(value < 6, "Exhausted 5 attempts")
        .when(value < 9, "no answer, 5 times").when(value < 10, "read timed out").alias("error"),
        ((value >= 2) & (value < 9)).alias("gave_up"),
        iso_instant(F.col("ts")).alias("run_ts"),
    )


def ticker_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per customer: a padded symbol, or blanks for an overdrawn account."""
    symbol = F.concat(F.lit("  NSE:"), F.col("c_name"), F.lit("/X-EQ\t"))
    return table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, F.lit("   ")).otherwise(symbol).alias("value")
    )
