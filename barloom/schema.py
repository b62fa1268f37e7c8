"""Schemas, fixed format values and timeframes shared by the whole package."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Timeframe:
    """A bar width. Widths of one day follow the local calendar day of the zone in use."""

    label: str
    seconds: int

    @property
    def is_day(self) -> bool:
        return self.seconds == DAY_SECONDS


# Fixed values of the data format -------------------------------------------
ENVELOPE = "fyers_response"  # field that wraps each landed payload
CANDLE_FIELDS = ("ts", "open", "high", "low", "close", "volume")  # by array position
RAW_PARTITIONS = ("symbol", "exchange", "year", "month", "day")
DEAD_LETTER_PARTITIONS = ("symbol", "year", "month", "day")
BAR_PARTITIONS = ("timeframe", "exchange", "symbol", "year", "month", "day")
BAR_COLUMNS = (
    "symbol", "exchange", "timeframe", "interval_start", "interval_start_epoch",
    "year", "month", "day", "open", "high", "low", "close", "volume",
)
DEFAULT_EXCHANGE = "NSE"
DEFAULT_ZONE = "Asia/Kolkata"
DAY_SECONDS = 86_400
METRICS = (
    "IngestSuccess", "IngestFailed",  # per symbol
    "IngestRunSuccessCount", "IngestRunFailedCount", "IngestRunSymbolsTotal",  # per run
)
TIMEFRAMES = (
    Timeframe("1m", 60),
    Timeframe("5m", 300),
    Timeframe("15m", 900),
    Timeframe("1d", DAY_SECONDS),
)
REQUEST = {"resolution": "1", "date_format": "1", "cont_flag": "1"}  # sent with each fetch
MISSING_CREDENTIALS = "missing_credentials"  # error text of a fetch without a token
# ---------------------------------------------------------------------------

SERIES = ("symbol", "exchange")  # one price series
# Epoch seconds a wall clock can show in any zone: years 1 to 9999, less a day at either end.
TS_RANGE = (-62_135_510_400, 253_402_214_400)

# The layout by width and date: the columns of bars with one date in place of three strings.
DATED_PARTITIONS = ("timeframe", "date")
DATED_COLUMNS = ("symbol", "exchange", "interval_start", "interval_start_epoch", *CANDLE_FIELDS[1:], *DATED_PARTITIONS)

# Identity of a base candle; exchange is not part of it. The number goes first because Spark
# sorts by it faster than by text.
CANDLE_KEY = ("ts", "symbol")
CANDLE_VERSION = ("ingest_ts", "pos")  # which copy of a candle is the newest


def _strings(names) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


def _raw_schema(payload: T.StructType, *extra: T.StructField) -> T.StructType:
    return T.StructType([
        *_strings((*RAW_PARTITIONS, "ingest_ts")),
        T.StructField(ENVELOPE, payload),
        *extra,
    ])


RAW = _raw_schema(
    T.StructType([T.StructField("candles", T.ArrayType(T.ArrayType(T.DoubleType())))])
)

# The same documents read as text, so that one bad element costs one candle, not the file.
RAW_TEXT = _raw_schema(
    T.StructType([
        T.StructField("candles", T.ArrayType(T.ArrayType(T.StringType()))),
        *_strings(("s", "message", "raw_text")),
    ]),
    T.StructField("_corrupt_record", T.StringType()),
)

DEAD_LETTER = T.StructType([
    *_strings((*DEAD_LETTER_PARTITIONS, "failed_at")),
    T.StructField("attempts", T.LongType()),
    T.StructField("note", T.StringType()),
    T.StructField("params_sent", T.StructType(_strings(
        ("symbol", "resolution", "date_format", "range_from", "range_to", "cont_flag")
    ))),
])

OUTCOME = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("http_status", T.IntegerType()),
    T.StructField("error", T.StringType()),
    T.StructField("gave_up", T.BooleanType()),  # all attempts were used up
])

BAR = T.StructType([
    *_strings(("symbol", "exchange", "timeframe")),
    T.StructField("interval_start", T.TimestampNTZType()),
    T.StructField("interval_start_epoch", T.LongType()),
    *_strings(("year", "month", "day")),
    *[T.StructField(name, T.DoubleType()) for name in CANDLE_FIELDS[1:]],
])

DATED_BAR = T.StructType([BAR[name] for name in DATED_COLUMNS[:-1]] + [T.StructField("date", T.StringType())])

# A candle as the store of incremental bars keeps it, with its version and the batch it came in.
STORED_CANDLE = T.StructType([
    *_strings((*SERIES, "ingest_ts")),
    T.StructField("pos", T.IntegerType()),
    T.StructField("ts", T.LongType()),
    *[T.StructField(name, T.DoubleType()) for name in CANDLE_FIELDS[1:]],
    *_strings(("date", "batch")),
])
