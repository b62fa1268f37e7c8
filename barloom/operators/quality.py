"""What the clean path drops silently, made visible."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from barloom.operators.candles import candle_fields, explode_candles, nested_candles
from barloom.schema import CANDLE_FIELDS, ENVELOPE


def triage_raw(raw_text: DataFrame) -> DataFrame:
    """Class of each landed document: corrupt, raw_text, no_candles, empty or ok."""
    body = F.col(ENVELOPE)
    verdict = (
        F.when(F.col("_corrupt_record").isNotNull(), "corrupt")
        .when(body["raw_text"].isNotNull(), "raw_text")
        .when(body["candles"].isNull(), "no_candles")
        .when(F.size(body["candles"]) == 0, "empty")
        .otherwise("ok")
    )
    return raw_text.select("symbol", "exchange", "ingest_ts", verdict.alias("class"))


def triage_counts(triaged: DataFrame) -> DataFrame:
    return triaged.groupBy("class").agg(F.count(F.lit(1)).alias("documents"))


def judged_candles(raw_text: DataFrame) -> DataFrame:
    """Every candle read as text, typed, with the first ``reason`` to reject it or null.

    An element counts as bad if it is there but does not have the number form of JSON, or is no
    possible ``ts``; a null price passes, a null ``ts`` does not.
    """
    return judged(explode_candles(nested_candles(raw_text)))


def judged(exploded: DataFrame) -> DataFrame:
    """``judged_candles`` of candles that are rows already."""
    typed = candle_fields(exploded.withColumn("source", F.col("candle")))
    reason = F.when(F.col("source").isNull(), "null_candle").when(
        F.size("source") < len(CANDLE_FIELDS), "short_candle"
    )
    for i, name in enumerate(CANDLE_FIELDS):
        given = F.get("source", F.lit(i)).isNotNull()
        reason = reason.when(given & F.col(name).isNull(), f"bad_{name}")
    reason = reason.when(F.col("ts").isNull(), "null_ts")
    return typed.withColumn("reason", reason)


def rejected_candles(raw_text: DataFrame) -> DataFrame:
    """Candles that cannot be used, with their text and the reason."""
    return judged_candles(raw_text).where("reason IS NOT NULL").select(
        "symbol", "exchange", "ingest_ts", "pos", "reason", F.col("source").alias("candle")
    )


def salvaged_rows(raw_text: DataFrame) -> DataFrame:
    """Usable candles, also from documents with bad ones; copies included."""
    return judged_candles(raw_text).where("reason IS NULL").drop("reason", "source")
