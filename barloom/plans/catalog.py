"""Registered queries: every operator run over whole given tables, with SQL to check it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom import operators as op, sinks, sources
from barloom.functions import (
    date_parts, ingest_version, interval_epoch, iso_date_parts, symbol_key, utc_clock, wall_clock,
)
from barloom.operators import branches
from barloom.plans import feeds, oracle as o
from barloom.plans.day_job import ALL_DATES, aggregate_day
from barloom.plans.landing import compact_landing, read_landed
from barloom.plans.incremental import merge_arrivals, squash_candles, stored_candles
from barloom.schema import (
    BAR_COLUMNS, CANDLE_FIELDS, CANDLE_KEY, ENVELOPE, TIMEFRAMES, Timeframe,
)
from barloom.session import joined_in_place, scratch_folder, written_in_buckets
from barloom.streaming.bars import start_bar_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

M1, M5, M15, D1 = TIMEFRAMES
SAMPLE_DAY, DAY_BEFORE, TWO_BEFORE = "2024-01-15", "2024-01-14", "2024-01-13"


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        ORACLES[name] = sql
        return build

    return register


# Shared inputs --------------------------------------------------------------------------

def candles_of(ticks: DataFrame) -> DataFrame:
    newest = op.dedup_latest(ticks, CANDLE_KEY, feeds.TICK_VERSION)
    return newest.select("symbol", "exchange", *CANDLE_FIELDS)


def event_candles(spark: SparkSession, sf: str) -> DataFrame:
    return candles_of(feeds.event_ticks(spark, sf))


def exploded_documents(spark: SparkSession, sf: str) -> DataFrame:
    return op.explode_candles(op.nested_candles(feeds.event_documents(spark, sf)))


def parsed_documents(spark: SparkSession, sf: str) -> DataFrame:
    return sources.parse_raw(feeds.event_document_text(spark, sf))


def landed_documents(spark: SparkSession, sf: str) -> str:
    folder = scratch_folder(spark, "raw")
    sinks.land_raw(feeds.event_documents(spark, sf), folder, one_per_file=False)
    return folder


EVENTS = (o.EVENT_TICKS, o.CANDLES)
DOCS = (o.DOCUMENTS, o.EXPLODED)
ROWS = (*DOCS, o.DOCUMENT_ROWS)


# Scans and sinks ------------------------------------------------------------------------

@query("src_raw_documents", o.with_(
    o.DOCUMENTS,
    body=f"""select symbol, exchange, ingest_ts, substr(ingest_ts, 1, 4) as year,
        substr(ingest_ts, 6, 2) as month, substr(ingest_ts, 9, 2) as day,
        cast(coalesce(len(candles), -1) as bigint) as n_candles
    from docs where status <> 'error'""",
))
def src_raw_documents(spark, sf):
    """SRC-1, SRC-2, SNK-4: land payloads, scan them back with their folder columns."""
    raw = sources.read_raw(spark, landed_documents(spark, sf), multi_line=False)
    size = F.coalesce(F.size(F.col(f"{ENVELOPE}.candles")), F.lit(-1)).cast("bigint")
    return raw.select(
        "symbol", "exchange", "ingest_ts", "year", "month", "day", size.alias("n_candles")
    )


def half_compacted(spark: SparkSession, sf: str) -> tuple[str, str]:
    """Documents that land in two parts, of which the first is taken into an archive."""
    raw, compacted = scratch_folder(spark, "raw"), scratch_folder(spark, "compacted")
    documents = feeds.event_documents(spark, sf)
    for early in (True, False):
        sinks.land_raw(documents.where((F.col("ingest_ts") < "2024-01-20") == early), raw, one_per_file=False)
        if early:
            compact_landing(spark, raw, compacted, multi_line=False)
    return raw, compacted


@query("src_compacted_documents", o.with_(
    o.DOCUMENTS,
    body=f"""select symbol, exchange, ingest_ts, substr(ingest_ts, 1, 4) as year,
        substr(ingest_ts, 6, 2) as month, substr(ingest_ts, 9, 2) as day,
        cast(coalesce(len(candles), -1) as bigint) as n_candles
    from docs where status <> 'error'""",
))
def src_compacted_documents(spark, sf):
    """SRC-1, SRC-2: documents from compacted landings and from files that came later."""
    raw, compacted = half_compacted(spark, sf)
    size = F.coalesce(F.size(F.col(f"{ENVELOPE}.candles")), F.lit(-1)).cast("bigint")
    return read_landed(spark, raw, compacted, multi_line=False).select(
        "symbol", "exchange", "ingest_ts", "year", "month", "day", size.alias("n_candles")
    )


@query("day_job_compacted", o.with_(
    *ROWS,
    f"""day_rows as (
    select * from document_rows where status <> 'error'
        and strftime({o.clock('ts')}, '%Y-%m-%d') in ('2024-01-19', '2024-01-20'))""",
    o.DOCUMENT_CANDLES.replace("from document_rows", "from day_rows"),
    body=o.all_bars(),
))
def day_job_compacted(spark, sf):
    """OP-5 of two dates, one of them compacted, the other not yet."""
    raw, compacted = half_compacted(spark, sf)
    output = scratch_folder(spark, "bars")
    dates = ["2024-01-19", "2024-01-20"]
    aggregate_day(spark, raw, output, dates, ["2024-01-18", *dates], multi_line=False, compacted=compacted, layout="dated")
    return sources.read_dated_bars(spark, output)


@query("src_raw_on_date", o.with_(
    *ROWS,
    body=f"""select symbol, exchange, ingest_ts, cast(pos as bigint) as pos, ts, {o.FIELDS}
    from document_rows where status <> 'error' and substr(ingest_ts, 1, 10) = '{SAMPLE_DAY}'""",
))
def src_raw_on_date(spark, sf):
    """SRC-1, FLT-1: scan the folders of one landing date only."""
    raw = sources.read_raw(
        spark, landed_documents(spark, sf), SAMPLE_DAY, exchange="NSE", multi_line=False
    )
    return op.base_rows(raw).withColumn("pos", F.col("pos").cast("bigint"))


@query("src_ingest_version", o.with_(
    o.DOCUMENTS,
    body="""select ticker as symbol, ingest_ts,
        case when status = 'ok' then 'ingest-' || ingest_ts || '.json'
            else 'part-' || ingest_ts || '.json' end as file_name,
        case when status = 'ok' then ingest_ts end as version from docs""",
))
def src_ingest_version(spark, sf):
    """SRC-6: the version of a document from its file name, none in other names."""
    documents = feeds.event_documents(spark, sf)
    kind = F.when(F.col(f"{ENVELOPE}.s") == "ok", "ingest-").otherwise("part-")
    named = documents.withColumn("file_name", F.concat(kind, F.col("ingest_ts"), F.lit(".json")))
    return named.select(
        "symbol", "ingest_ts", "file_name", ingest_version(F.col("file_name")).alias("version")
    )


@query("src_ticker_list", o.with_(
    o.TICKERS, body="""select symbol, translate(symbol, ':/', '__') as symbol_key from tickers""",
))
def src_ticker_list(spark, sf):
    """SRC-3: write the lines as text, read them as tickers."""
    folder = scratch_folder(spark, "tickers")
    feeds.ticker_lines(spark, sf).write.text(folder)
    tickers = sources.read_tickers(spark, folder)
    return tickers.withColumn("symbol_key", symbol_key(F.col("symbol")))


@query("src_dead_letters", o.with_(
    o.OUTCOMES,
    body="""select translate(symbol, ':/', '__') as symbol, substr(run_ts, 1, 4) as year,
        substr(run_ts, 6, 2) as month, substr(run_ts, 9, 2) as day, run_ts as failed_at,
        cast(attempts as bigint) as attempts, error as note, symbol as ticker, '1' as resolution,
        substr(run_ts, 1, 10) as range_from, substr(run_ts, 1, 10) as range_to
    from outcomes where not ok and symbol is not null and gave_up""",
))
def src_dead_letters(spark, sf):
    """SRC-4, SNK-5: write the dead letters of failed fetches, scan them back."""
    folder = scratch_folder(spark, "dead-letters")
    letters = op.dead_letters(
        feeds.event_outcomes(spark, sf), F.col("run_ts"), F.left("run_ts", F.lit(10))
    )
    sinks.write_dead_letters(letters, folder, one_per_file=False)
    sent = F.col("params_sent")
    return sources.read_dead_letters(spark, folder, multi_line=False).select(
        "symbol", "year", "month", "day", "failed_at", "attempts", "note",
        sent["symbol"].alias("ticker"), sent["resolution"].alias("resolution"),
        sent["range_from"].alias("range_from"), sent["range_to"].alias("range_to"),
    )


@query("src_bars_pruned", o.with_(
    *EVENTS,
    body=f"select * from ({o.bars('5m')}) "
    "where year || month || day between '20240110' and '20240120'",
))
def src_bars_pruned(spark, sf):
    """SRC-5, SNK-2, SNK-3: write bars of all widths, scan one width and a range of dates."""
    folder = scratch_folder(spark, "bars")
    bars = op.all_timeframes(
        event_candles(spark, sf), unique_ts=True, partitions=sinks.folder_writers(spark)
    )
    sinks.write_bars(bars, folder, clustered=True)
    return sources.read_bars(
        spark, folder, timeframe="5m", exchange="NSE", start="2024-01-10", end="2024-01-20"
    )


@query("src_bars_month_end", o.with_(
    *EVENTS,
    body=f"""select * from ({o.bars('1d')})
    where year || month || day between '20240130' and '20240202'""",
))
def src_bars_month_end(spark, sf):
    """SRC-5: a range of dates across the end of a month, of one width."""
    folder = scratch_folder(spark, "bars")
    sinks.write_bars(op.resample(event_candles(spark, sf), D1), folder)
    return sources.read_bars(spark, folder, timeframe="1d", start="2024-01-30", end="2024-02-02")


@query("src_dated_bars", o.with_(
    *EVENTS,
    body=f"""select * from ({o.bars('5m')}) where symbol in ('click', 'view', 'S7')
    and year || month || day between '20240110' and '20240202'""",
))
def src_dated_bars(spark, sf):
    """SNK-2, SRC-5 in the layout by width and date: some symbols of one width, across months."""
    folder = scratch_folder(spark, "dated")
    sinks.write_dated_bars(op.all_timeframes(event_candles(spark, sf), unique_ts=True), folder)
    return sources.read_dated_bars(
        spark, folder, timeframe="5m", symbols=["click", "view", "S7"], start="2024-01-10", end="2024-02-02"
    )


@query("sql_bars_between", o.with_(
    *EVENTS,
    body=f"""select symbol, month, cast(count(*) as bigint) as bars, max(high) as high, sum(volume) as volume
    from ({o.bars('15m')}) where year || month || day between '20240110' and '20240202' group by symbol, month""",
))
def sql_bars_between(spark, sf):
    """SRC-5 by SQL: a table function over a catalog table of bars."""
    folder = scratch_folder(spark, "dated")
    sinks.write_dated_bars(op.all_timeframes(event_candles(spark, sf), unique_ts=True), folder)
    name = folder.rsplit("/", 1)[-1].replace("-", "_")  # unlike any other table's
    sources.create_bar_table(spark, name, folder)
    between, _ = sources.create_bar_functions(spark, name, name)
    return spark.sql(f"""select symbol, month, count(*) as bars, max(high) as high, sum(volume) as volume
        from {between}('15m', date'2024-01-10', date'2024-02-02') group by symbol, month""")


@query("snk_dated_overwrite", o.with_(
    *EVENTS,
    body=f"""select * replace (case when year || '-' || month || '-' || day = '{SAMPLE_DAY}'
        then volume + 1000 else volume end as volume) from ({o.bars('15m')})""",
))
def snk_dated_overwrite(spark, sf):
    """SNK-2 in the layout by width and date: a corrected day replaces its folder only."""
    folder = scratch_folder(spark, "dated")
    bars = op.resample(event_candles(spark, sf), M15)
    sinks.write_dated_bars(bars, folder)
    corrected = op.on_session_date(bars, SAMPLE_DAY).withColumn("volume", F.col("volume") + 1000)
    sinks.write_dated_bars(corrected, folder)
    return sources.read_dated_bars(spark, folder)


@query("src_raw_multi_line", o.with_(
    f"""days as (
    select 'NSE_' || upper(event_type) || '-EQ' as symbol, 'NSE' as exchange,
        {o.epoch("ts")} as ts, {o.prices("value", "cast(event_id % 1000 as double)")}, event_id
    from events
    qualify row_number() over (partition by event_type, {o.epoch("ts")} order by event_id desc) = 1)""",
    body=f"""select symbol, exchange, ts, {o.FIELDS},
        cast(row_number() over (partition by symbol, ts // 86400 order by ts) - 1 as bigint) as pos
    from days""",
))
def src_raw_multi_line(spark, sf):
    """SRC-1 in the format of a fetch: a file is one document, with all candles of its run."""
    folder = scratch_folder(spark, "raw")
    sinks.land_raw(feeds.day_documents(spark, sf), folder, one_per_file=True)
    rows = op.base_rows(sources.read_raw(spark, folder, multi_line=True))
    return rows.drop("ingest_ts").withColumn("pos", F.col("pos").cast("bigint"))


@query("snk_dynamic_overwrite", o.with_(
    *EVENTS,
    body=f"""select * replace (case when year || '-' || month || '-' || day = '{SAMPLE_DAY}'
        then volume + 1000 else volume end as volume) from ({o.bars('15m')})""",
))
def snk_dynamic_overwrite(spark, sf):
    """SNK-2: a corrected day replaces its own folders and leaves the others."""
    folder = scratch_folder(spark, "bars")
    bars = op.resample(event_candles(spark, sf), M15)
    sinks.write_bars(bars, folder)
    corrected = op.on_session_date(bars, SAMPLE_DAY).withColumn("volume", F.col("volume") + 1000)
    sinks.write_bars(corrected, folder)
    return sources.read_bars(spark, folder)


@query("snk_static_overwrite", o.with_(*EVENTS, body=o.bars("1d")))
def snk_static_overwrite(spark, sf):
    """SNK-1: a static write replaces everything that was there."""
    folder = scratch_folder(spark, "bars")
    candles = event_candles(spark, sf)
    sinks.write_bars(op.resample(candles, M15), folder)
    sinks.write_bars(op.resample(candles, D1), folder, mode="static")
    return sources.read_bars(spark, folder)


# Projections ----------------------------------------------------------------------------

@query("prj_nested_candles", o.with_(
    o.DOCUMENTS,
    body="""select ticker as symbol, exchange, ingest_ts,
        cast(coalesce(len(candles), -1) as bigint) as n_candles from docs""",
))
def prj_nested_candles(spark, sf):
    """PRJ-1: the candle array out of its envelope."""
    size = F.coalesce(F.size("candles"), F.lit(-1)).cast("bigint")
    documents = op.nested_candles(feeds.event_documents(spark, sf))
    return documents.select("symbol", "exchange", "ingest_ts", size.alias("n_candles"))


@query("prj_candle_fields", o.with_(
    *ROWS,
    body=f"""select ticker as symbol, exchange, ingest_ts, cast(pos as bigint) as pos, ts,
        {o.FIELDS} from document_rows""",
))
def prj_candle_fields(spark, sf):
    """PRJ-2: elements by position to named, typed columns."""
    rows = op.candle_fields(op.complete_candles(exploded_documents(spark, sf)))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


@query("prj_wall_clock", o.with_(
    o.EVENT_TICKS,
    body=f"""select symbol, ts, ingest_seq, row_id, {o.clock('ts')} as ts_ts,
        {o.clock('ts', 0)} as ts_utc from ticks""",
))
def prj_wall_clock(spark, sf):
    """PRJ-3: epoch to local and UTC wall clock."""
    ticks = op.with_wall_clock(feeds.event_ticks(spark, sf))
    return ticks.select(
        "symbol", "ts", "ingest_seq", "row_id", "ts_ts", utc_clock(F.col("ts")).alias("ts_utc")
    )


@query("prj_date_parts", o.with_(
    o.EVENT_TICKS,
    body=f"""select symbol, ts, ingest_seq, row_id, '1m' as timeframe,
        {o.date_parts(o.clock('ts'))} from ticks""",
))
def prj_date_parts(spark, sf):
    """PRJ-4, PRJ-5, PRJ-6: width label and padded partition strings."""
    return feeds.event_ticks(spark, sf).select(
        "symbol", "ts", "ingest_seq", "row_id", F.lit(M1.label).alias("timeframe"),
        *[c.alias(n) for n, c in date_parts(wall_clock(F.col("ts"))).items()],
    )


@query("prj_bar_columns", o.with_(
    o.EVENT_TICKS,
    body=o.finish(f"""select symbol, exchange, '15m' as timeframe,
        {o.bucket(900, 0)} as interval_start_epoch, {o.FIELDS} from ticks"""),
))
def prj_bar_columns(spark, sf):
    """PRJ-7: ticks, each put in its bucket, with the fixed column order of bars."""
    ticks = op.with_interval(feeds.event_ticks(spark, sf), M15)
    return op.as_bars(ticks.withColumn("timeframe", F.lit(M15.label))).select(*BAR_COLUMNS)


@query("prj_symbol_key", o.with_(
    o.DOCUMENTS, body="select ticker as symbol, symbol as symbol_key, ingest_ts from docs",
))
def prj_symbol_key(spark, sf):
    """PRJ-8: folder-safe symbols."""
    documents = feeds.event_documents(spark, sf)
    return documents.select("symbol", symbol_key(F.col("symbol")).alias("symbol_key"), "ingest_ts")


@query("prj_raw_partitions", o.with_(
    o.DOCUMENTS,
    body="""select ticker as symbol, ingest_ts, substr(ingest_ts, 1, 4) as year,
        substr(ingest_ts, 6, 2) as month, substr(ingest_ts, 9, 2) as day from docs""",
))
def prj_raw_partitions(spark, sf):
    """PRJ-9: partition strings of a landing instant."""
    parts = iso_date_parts(F.col("ingest_ts"))
    return feeds.event_documents(spark, sf).select(
        "symbol", "ingest_ts", *[c.alias(n) for n, c in parts.items()]
    )


@query("fn_bucket_epochs", o.with_(
    o.EVENT_TICKS,
    body="select symbol, ts, ingest_seq, row_id, " + ", ".join(
        f"{o.bucket(*o.WIDTHS[t.label])} as bucket_{t.label}" for t in TIMEFRAMES
    ) + f", {o.bucket(86_400, 0)} as bucket_utc_day from ticks",
))
def fn_bucket_epochs(spark, sf):
    """Bucket arithmetic of every width, and of UTC days."""
    ts = F.col("ts")
    return feeds.event_ticks(spark, sf).select(
        "symbol", "ts", "ingest_seq", "row_id",
        *[interval_epoch(ts, t).alias(f"bucket_{t.label}") for t in TIMEFRAMES],
        interval_epoch(ts, D1, "UTC").alias("bucket_utc_day"),
    )


# Filters --------------------------------------------------------------------------------

@query("flt_raw_date", o.with_(
    o.DOCUMENTS,
    body=f"""select ticker as symbol, ingest_ts, status from docs
    where substr(ingest_ts, 1, 10) = '{SAMPLE_DAY}'""",
))
def flt_raw_date(spark, sf):
    """FLT-1: documents of a landing date, by partition strings.

    Here they are computed columns; ``src_raw_on_date`` shows the folders pruned.
    """
    documents = feeds.event_documents(spark, sf)
    landed = documents.withColumns(iso_date_parts(F.col("ingest_ts")))
    return sources.on_raw_date(landed, SAMPLE_DAY).select(
        "symbol", "ingest_ts", F.col(f"{ENVELOPE}.s").alias("status")
    )


@query("flt_candles_present", o.with_(
    o.DOCUMENTS,
    body="""select ticker as symbol, ingest_ts, status, cast(len(candles) as bigint) as n_candles
    from docs where len(candles) > 0""",
))
def flt_candles_present(spark, sf):
    """FLT-2: documents that hold candles."""
    documents = feeds.event_documents(spark, sf)
    lifted = documents.withColumns({
        "candles": F.col(f"{ENVELOPE}.candles"), "status": F.col(f"{ENVELOPE}.s"),
    })
    return op.with_candles(lifted).select(
        "symbol", "ingest_ts", "status", F.size("candles").cast("bigint").alias("n_candles")
    )


@query("flt_candle_arity", o.with_(
    *DOCS,
    body="""select ticker as symbol, ingest_ts, cast(pos as bigint) as pos,
        cast(len(candle) as bigint) as elements from exploded where len(candle) >= 6""",
))
def flt_candle_arity(spark, sf):
    """FLT-3: candles with at least six elements."""
    whole = op.complete_candles(exploded_documents(spark, sf))
    return whole.select(
        "symbol", "ingest_ts", F.col("pos").cast("bigint").alias("pos"),
        F.size("candle").cast("bigint").alias("elements"),
    )


@query("flt_session_date", o.with_(
    *EVENTS,
    body=f"""select * from ({o.all_bars()})
    where year || '-' || month || '-' || day = '{SAMPLE_DAY}'""",
))
def flt_session_date(spark, sf):
    """FLT-4: bars of all widths that start on one local date."""
    candles = candles_of(op.on_session(feeds.event_ticks(spark, sf), SAMPLE_DAY, TIMEFRAMES))
    return op.on_session_date(op.all_timeframes(candles, unique_ts=True), SAMPLE_DAY)


@query("flt_first_of_group", o.with_(
    *EVENTS, o.RANKED.format(b=o.bucket(300, 0), order="asc"),
    body="select symbol, exchange, interval_start_epoch, ts, open from ranked where rn = 1",
))
def flt_first_of_group(spark, sf):
    """FLT-5: the first candle of each 5-minute bucket."""
    firsts = branches.first_of_group(op.with_interval(event_candles(spark, sf), M5))
    return firsts.select(*branches.BUCKET, "ts", "open")


@query("flt_successes", o.with_(
    o.OUTCOMES, body="select symbol, attempts, http_status, run_ts from outcomes where ok",
))
def flt_successes(spark, sf):
    """FLT-6: fetches that succeeded."""
    good = op.successes(feeds.event_outcomes(spark, sf))
    return good.select("symbol", "attempts", "http_status", "run_ts")


@query("flt_failures", o.with_(
    o.OUTCOMES, body="select symbol, attempts, error, run_ts from outcomes where not ok",
))
def flt_failures(spark, sf):
    """FLT-6: fetches that failed."""
    bad = op.failures(feeds.event_outcomes(spark, sf))
    return bad.select("symbol", "attempts", "error", "run_ts")


# Joins, windows, aggregates ---------------------------------------------------------------

def _bucketed(spark: SparkSession, sf: str, timeframe: Timeframe = M15) -> DataFrame:
    return op.with_interval(event_candles(spark, sf), timeframe)


_AGGREGATES_15M = f"agg as ({o.aggregates('15m')})"


@query("join_opens", o.with_(
    *EVENTS, _AGGREGATES_15M,
    body="""select symbol, exchange, interval_start_epoch, high, low, volume, open from agg""",
))
def join_opens(spark, sf):
    """JN-1: bucket aggregates with their opens joined on."""
    bucketed = _bucketed(spark, sf)
    return branches.attach(
        branches.bucket_aggregates(bucketed), branches.bucket_opens(bucketed)
    )


@query("join_closes", o.with_(
    *EVENTS, _AGGREGATES_15M,
    body="""select symbol, exchange, interval_start_epoch, high, low, volume, "close" from agg""",
))
def join_closes(spark, sf):
    """JN-2: bucket aggregates with their closes joined on."""
    bucketed = _bucketed(spark, sf)
    return branches.attach(
        branches.bucket_aggregates(bucketed), branches.bucket_closes(bucketed)
    )


@query("bars_by_joins", o.with_(*EVENTS, body=o.bars("15m")))
def bars_by_joins(spark, sf):
    """JN-1, JN-2, WIN-1, WIN-2, FLT-5: whole bars from the separate steps."""
    return op.resample_by_joins(event_candles(spark, sf), M15)


@query("agg_buckets", o.with_(
    *EVENTS, _AGGREGATES_15M,
    body="select symbol, exchange, interval_start_epoch, high, low, volume from agg",
))
def agg_buckets(spark, sf):
    """AGG-1: high, low and volume of each bucket."""
    return branches.bucket_aggregates(_bucketed(spark, sf))


@query("agg_open_close", o.with_(
    *EVENTS, _AGGREGATES_15M,
    body='select symbol, exchange, interval_start_epoch, open, "close" from agg',
))
def agg_open_close(spark, sf):
    """AGG-2, AGG-3: first open and last close of each bucket as plain aggregates."""
    whole = _bucketed(spark, sf).groupBy(*branches.BUCKET).agg(*op.ohlcv())
    return whole.select(*branches.BUCKET, "open", "close")


@query("agg_candle_count", o.with_(
    *EVENTS, body="select cast(count(*) as bigint) as candles from candles",
))
def agg_candle_count(spark, sf):
    """AGG-4: the number of base candles."""
    return event_candles(spark, sf).agg(F.count(F.lit(1)).alias("candles"))


@query("agg_dedup_latest", o.with_(*EVENTS, body="select * from candles"))
def agg_dedup_latest(spark, sf):
    """AGG-5: the newest copy of each candle."""
    return event_candles(spark, sf)


@query("agg_dedup_hot_keys", o.with_(o.ORDER_TICKS, o.CANDLES, body="select * from candles"))
def agg_dedup_hot_keys(spark, sf):
    """AGG-5 where every key has many copies."""
    return candles_of(feeds.order_ticks(spark, sf))


@query("agg_run_summary", o.with_(
    o.OUTCOMES, o.TICKERS,
    body="""select cast(count(*) filter (where ok) as bigint) as success,
        cast(count(*) - count(*) filter (where ok) as bigint) as failed,
        cast((select count(*) from tickers) as bigint) as total from outcomes""",
))
def agg_run_summary(spark, sf):
    """AGG-6: successes, failures and universe size."""
    tickers = sources.parse_tickers(feeds.ticker_lines(spark, sf))
    return op.run_summary(feeds.event_outcomes(spark, sf), tickers)


_SYMBOL_COUNTS = """counts as (
    select symbol, cast(count(*) filter (where ok) as bigint) as success,
        cast(count(*) filter (where not ok) as bigint) as failed,
        cast(count(*) filter (where not ok and symbol is not null
            and gave_up) as bigint) as dead_letters
    from outcomes group by symbol)"""


@query("agg_symbol_counts", o.with_(o.OUTCOMES, _SYMBOL_COUNTS, body="select * from counts"))
def agg_symbol_counts(spark, sf):
    """AGG-7: outcomes per symbol."""
    return op.symbol_counts(feeds.event_outcomes(spark, sf))


@query("agg_failure_reasons", o.with_(
    o.OUTCOMES,
    body="""select error, cast(count(*) as bigint) as failures, max(attempts) as max_attempts
    from outcomes where not ok group by error""",
))
def agg_failure_reasons(spark, sf):
    """AGG-8: failures by reason."""
    return op.failure_reasons(feeds.event_outcomes(spark, sf))


@query("agg_run_metrics", o.with_(
    o.OUTCOMES, o.TICKERS, _SYMBOL_COUNTS,
    body="""select 'IngestSuccess' as metric, symbol, success as value from counts
        where success > 0
    union all select 'IngestFailed', symbol, dead_letters from counts where dead_letters > 0
    union all select 'IngestRunSuccessCount', null, cast(count(*) filter (where ok) as bigint)
        from outcomes
    union all select 'IngestRunFailedCount', null, cast(count(*) filter (where not ok) as bigint)
        from outcomes
    union all select 'IngestRunSymbolsTotal', null, cast(count(*) as bigint) from tickers""",
))
def agg_run_metrics(spark, sf):
    """The counts a monitor gets, per symbol and per run."""
    tickers = sources.parse_tickers(feeds.ticker_lines(spark, sf))
    return op.run_metrics(feeds.event_outcomes(spark, sf), tickers)


def _ranked_sql(order: str) -> str:
    return o.with_(
        *EVENTS, o.RANKED.format(b=o.bucket(86_400, o.IST), order=order),
        body="""select symbol, exchange, interval_start_epoch, ts, cast(rn as bigint) as rn
        from ranked""",
    )


@query("win_row_number_first", _ranked_sql("asc"))
def win_row_number_first(spark, sf):
    """WIN-1: candles numbered forward within each local day."""
    numbered = branches.row_numbers(_bucketed(spark, sf, D1))
    return numbered.select(*branches.BUCKET, "ts", F.col("rn").cast("bigint").alias("rn"))


@query("win_row_number_last", _ranked_sql("desc"))
def win_row_number_last(spark, sf):
    """WIN-2: candles numbered backward within each local day."""
    numbered = branches.row_numbers(_bucketed(spark, sf, D1), order=[F.desc("ts")])
    return numbered.select(*branches.BUCKET, "ts", F.col("rn").cast("bigint").alias("rn"))


@query("srt_top_per_group", o.with_(
    *EVENTS, o.RANKED.format(b=o.bucket(86_400, o.IST), order="desc"),
    body="select symbol, exchange, interval_start_epoch, ts, open from ranked where rn = 1",
))
def srt_top_per_group(spark, sf):
    """SRT-1: the last candle of each local day."""
    lasts = branches.first_of_group(_bucketed(spark, sf, D1), order=[F.desc("ts")])
    return lasts.select(*branches.BUCKET, "ts", "open")


@query("set_union_timeframes", o.with_(*EVENTS, body=o.all_bars()))
def set_union_timeframes(spark, sf):
    """SET-1: bars of each width resampled alone, then stacked by name."""
    candles = event_candles(spark, sf)
    return op.union_timeframes([op.resample(candles, t) for t in TIMEFRAMES])


@query("gen_explode_candles", o.with_(
    *DOCS,
    body="""select ticker as symbol, exchange, ingest_ts, cast(pos as bigint) as pos,
        candle[1] as first_element, cast(len(candle) as bigint) as elements from exploded""",
))
def gen_explode_candles(spark, sf):
    """GEN-1: one row per candle; no row for an absent or empty array."""
    return exploded_documents(spark, sf).select(
        "symbol", "exchange", "ingest_ts", F.col("pos").cast("bigint").alias("pos"),
        F.get("candle", F.lit(0)).alias("first_element"),
        F.size("candle").cast("bigint").alias("elements"),
    )


# Composites -----------------------------------------------------------------------------

@query("clean_candles", o.with_(
    *ROWS, o.DOCUMENT_CANDLES,
    body=f"""select replace(symbol, 'NSE_', 'NSE:') as symbol, exchange, ts, {o.FIELDS},
        {o.clock('ts')} as ts_ts from candles""",
))
def clean_candles(spark, sf):
    """OP-1: documents to base candles."""
    return op.clean_candles(feeds.event_documents(spark, sf))


@query("resample_utc_day", o.with_(
    *EVENTS,
    body=o.finish(o.aggregates("1d").replace(o.bucket(86_400, o.IST), o.bucket(86_400, 0)), 0),
))
def resample_utc_day(spark, sf):
    """OP-2: daily bars aligned to UTC."""
    return op.resample(event_candles(spark, sf), D1, "UTC")


def _register_resample(timeframe: Timeframe) -> None:
    @query(f"resample_{timeframe.label}", o.with_(*EVENTS, body=o.bars(timeframe.label)))
    def resample(spark, sf):
        """OP-3: bars of one width, days aligned to local midnight."""
        return op.resample(event_candles(spark, sf), timeframe)


for _timeframe in TIMEFRAMES:
    _register_resample(_timeframe)


@query("resample_ticks_with_ties", o.with_(
    o.ORDER_TICKS, body=o.bars("1d", source="ticks", order="(ts, row_id)"),
))
def resample_ticks_with_ties(spark, sf):
    """OP-3 on raw ticks, many in the same second; the row id settles open and close."""
    return op.resample(feeds.order_ticks(spark, sf), D1, tie_break=["row_id"])


@query("all_timeframes", o.with_(*EVENTS, body=o.all_bars()))
def all_timeframes(spark, sf):
    """OP-4: bars of every width from one placement of the candles."""
    return op.all_timeframes(event_candles(spark, sf), unique_ts=True)


@query("all_timeframes_ticks", o.with_(
    o.ORDER_TICKS, body=o.all_bars(source="ticks", order="(ts, row_id)"),
))
def all_timeframes_ticks(spark, sf):
    """OP-4 on raw ticks that share seconds: combined to minutes first."""
    return op.all_timeframes(feeds.order_ticks(spark, sf), tie_break=["row_id"])


@query("all_timeframes_many_series", o.with_(o.LINEITEM_TICKS, o.CANDLES, body=o.all_bars()))
def all_timeframes_many_series(spark, sf):
    """OP-4 over the largest table: many series on two exchanges."""
    ticks = feeds.lineitem_ticks(spark, sf)
    return op.all_timeframes(candles_of(ticks), unique_ts=True, partitions=op.placement_tasks(spark, ticks.count()))


@query("all_timeframes_by_joins", o.with_(o.LINEITEM_TICKS, o.CANDLES, body=o.all_bars()))
def all_timeframes_by_joins(spark, sf):
    """OP-4 from windows and joins, width by width: what one placement saves."""
    ticks = feeds.lineitem_ticks(spark, sf)
    tasks = op.placement_tasks(spark, ticks.count())
    candles = written_in_buckets(spark, candles_of(ticks), "candles", tasks, op.home_keys(D1))
    bars = op.union_timeframes([op.resample_by_joins(candles, t, unique_ts=True, home=D1) for t in TIMEFRAMES])
    return joined_in_place(spark, bars)


@query("day_job_whole_archive", o.with_(
    *ROWS,
    o.DOCUMENT_CANDLES.replace("from document_rows", "from document_rows where status <> 'error'"),
    body=o.all_bars(),
))
def day_job_whole_archive(spark, sf):
    """OP-5: land documents, build and write the bars of every date, scan them back."""
    output = scratch_folder(spark, "bars")
    aggregate_day(
        spark, landed_documents(spark, sf), output, ALL_DATES, ALL_DATES, multi_line=False
    )
    return sources.read_bars(spark, output)


@query("day_job_dated", o.with_(
    *ROWS,
    o.DOCUMENT_CANDLES.replace("from document_rows", "from document_rows where status <> 'error'"),
    body=o.all_bars(),
))
def day_job_dated(spark, sf):
    """OP-5 for every date, written by width and date."""
    output = scratch_folder(spark, "bars")
    landed = landed_documents(spark, sf)
    aggregate_day(spark, landed, output, ALL_DATES, ALL_DATES, multi_line=False, layout="dated")
    return sources.read_dated_bars(spark, output)


@query("day_job_one_date", o.with_(
    *ROWS,
    f"""day_rows as (
    select * from document_rows where status <> 'error'
        and substr(ingest_ts, 1, 10) = '{SAMPLE_DAY}'
        and strftime({o.clock('ts')}, '%Y-%m-%d') = '{SAMPLE_DAY}')""",
    o.DOCUMENT_CANDLES.replace("from document_rows", "from day_rows"),
    body=o.all_bars(),
))
def day_job_one_date(spark, sf):
    """OP-5, FLT-1, FLT-4: the scheduled run of one date, landing date and local date alike."""
    output = scratch_folder(spark, "bars")
    aggregate_day(spark, landed_documents(spark, sf), output, SAMPLE_DAY, multi_line=False)
    return sources.read_bars(spark, output)


@query("day_job_static_guard", o.with_(
    *ROWS,
    f"""day_rows as (
    select * from document_rows where status <> 'error'
        and substr(ingest_ts, 1, 10) = '{SAMPLE_DAY}'
        and strftime({o.clock('ts')}, '%Y-%m-%d') = '{SAMPLE_DAY}')""",
    o.DOCUMENT_CANDLES.replace("from document_rows", "from day_rows"),
    body=o.all_bars(),
))
def day_job_static_guard(spark, sf):
    """AGG-4: a static run whose candles yield no bar of its date leaves the bars alone.

    The second run reads the same landing folder for the date before: its candles begin at
    local 05:30, so none of them falls in a bar of that date.
    """
    output, landed = scratch_folder(spark, "bars"), landed_documents(spark, sf)
    aggregate_day(spark, landed, output, SAMPLE_DAY, multi_line=False)
    aggregate_day(spark, landed, output, DAY_BEFORE, SAMPLE_DAY, mode="static", multi_line=False)
    return sources.read_bars(spark, output)


@query("day_job_dates", o.with_(
    *ROWS,
    f"""day_rows as (
    select * from document_rows where status <> 'error'
        and strftime({o.clock('ts')}, '%Y-%m-%d') in ('{DAY_BEFORE}', '{SAMPLE_DAY}'))""",
    o.DOCUMENT_CANDLES.replace("from document_rows", "from day_rows"),
    body=o.all_bars(),
))
def day_job_dates(spark, sf):
    """OP-5 for a set of local dates in one job, with the landing dates that can hold them."""
    output = scratch_folder(spark, "bars")
    aggregate_day(
        spark, landed_documents(spark, sf), output, [DAY_BEFORE, SAMPLE_DAY],
        [TWO_BEFORE, DAY_BEFORE, SAMPLE_DAY], multi_line=False,
    )
    return sources.read_bars(spark, output)


@query("all_timeframes_with_1h", o.with_(
    *EVENTS, body=o.all_bars(widths=("15m", "1h", "1d")),
))
def all_timeframes_with_1h(spark, sf):
    """OP-4 with widths that do not nest: clock hours cross the local midnight."""
    widths = [M15, Timeframe("1h", 3600), D1]
    return op.all_timeframes(event_candles(spark, sf), widths, unique_ts=True)


@query("cached_resamples", o.with_(
    *EVENTS, body=f"({o.bars('5m')}) union all ({o.bars('1d')})",
))
def cached_resamples(spark, sf):
    """OP-6: base candles kept for two separate writes, then freed."""
    folder = scratch_folder(spark, "bars")
    with op.cached(event_candles(spark, sf)) as candles:
        for timeframe in (M5, D1):
            sinks.write_bars(op.resample(candles, timeframe), folder)
    return sources.read_bars(spark, folder)


_VERDICT = """case when value < 1 then 'no_candles' when value < 2 then 'empty'
    when value < 3 then 'raw_text' when value < 4 then 'corrupt' else 'ok' end"""


@query("dq_triage_documents", o.with_(
    o.DOCUMENT_TEXT, body=f'select symbol, exchange, ingest_ts, {_VERDICT} as "class" from texts',
))
def dq_triage_documents(spark, sf):
    """DQ-1: the class of each document."""
    return op.triage_raw(parsed_documents(spark, sf))


@query("dq_triage_counts", o.with_(
    o.DOCUMENT_TEXT,
    body=f"""select {_VERDICT} as "class", cast(count(*) as bigint) as documents
    from texts group by 1""",
))
def dq_triage_counts(spark, sf):
    """DQ-1: documents per class."""
    return op.triage_counts(op.triage_raw(parsed_documents(spark, sf)))


@query("dq_rejected_candles", o.with_(
    o.DOCUMENT_TEXT,
    body="""select symbol, exchange, ingest_ts, cast(0 as bigint) as pos, 'bad_open' as reason,
        t || case when value < 5 then ',x,' else ',7d,' end || p || ',' || p || ',' || p || ',7'
            as candle
        from texts where value >= 4 and value < 6
    union all select symbol, exchange, ingest_ts, 2, 'short_candle', t || ',' || p || ',' || p
        from texts where value >= 4 and value < 5
    union all select symbol, exchange, ingest_ts, 2, 'bad_low',
        t || ',' || p || ',' || p || ',0x1p3,' || p || ',7'
        from texts where value >= 5 and value < 6
    union all select symbol, exchange, ingest_ts, 0, 'null_candle', null
        from texts where value >= 6 and value < 8
    union all select symbol, exchange, ingest_ts, 1, 'null_ts',
        p || ',' || p || ',' || p || ',' || p || ',7'
        from texts where value >= 6 and value < 8""",
))
def dq_rejected_candles(spark, sf):
    """DQ-2: candles the clean path drops, with the reason."""
    text = F.when(F.col("candle").isNotNull(), F.concat_ws(",", "candle"))
    rejected = op.rejected_candles(parsed_documents(spark, sf))
    return rejected.withColumns({"pos": F.col("pos").cast("bigint"), "candle": text})


@query("dq_salvaged_candles", o.with_(
    o.DOCUMENT_TEXT,
    body="""select symbol, exchange, ingest_ts,
        cast(case when value < 6 then 1 when value < 8 then 2 else 0 end as bigint) as pos,
        cast(t as bigint) as ts,
        case when value < 6 or value >= 8 then value end as open, value as high, value as low,
        value as "close", cast(7 as double) as volume from texts where value >= 4""",
))
def dq_salvaged_candles(spark, sf):
    """DQ-2: the usable candles, also from documents with bad ones."""
    rows = op.salvaged_rows(parsed_documents(spark, sf))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


# Bars kept up to date ---------------------------------------------------------------------

def merged_documents(spark: SparkSession, sf: str) -> tuple[str, str]:
    """The documents in three batches, the newest first: a store of candles and its bars.

    Candles overlap between batches, as a document also holds the minute after its own.
    """
    store, output = scratch_folder(spark, "store"), scratch_folder(spark, "bars")
    documents = feeds.event_documents(spark, sf).where(f"{ENVELOPE}.s <> 'error'").withColumn("symbol", symbol_key(F.col("symbol")))
    at = F.col("ingest_ts")
    for n, part in enumerate([at >= "2024-01-21", (at >= "2024-01-11") & (at < "2024-01-21"), at < "2024-01-11"]):
        merge_arrivals(spark, documents.where(part), store, output, n)
    return store, output


LANDED_CANDLES = (*ROWS, o.DOCUMENT_CANDLES.replace("from document_rows", "from document_rows where status <> 'error'"))


@query("incremental_bars", o.with_(*LANDED_CANDLES, body=o.all_bars()))
def incremental_bars(spark, sf):
    """AGG-1 to AGG-3, OP-4: batches merged into stored candles and the bars that they touch."""
    return sources.read_dated_bars(spark, merged_documents(spark, sf)[1])


@query("incremental_candles", o.with_(
    *LANDED_CANDLES,
    body="select * from candles where strftime(" + o.clock("ts") + f", '%Y-%m-%d') in ('{DAY_BEFORE}', '{SAMPLE_DAY}')",
))
def incremental_candles(spark, sf):
    """AGG-5: the newest copies that the store holds of some dates, after their batches became one."""
    store, _ = merged_documents(spark, sf)
    squash_candles(spark, store, [SAMPLE_DAY])
    return stored_candles(spark, store, [DAY_BEFORE, SAMPLE_DAY]).drop("ingest_ts", "pos")


@query("stream_bars_15m", o.with_(*EVENTS, body=o.bars("15m")))
def stream_bars_15m(spark, sf):
    """AGG-5 and 2.11: bars from a stream of deliveries, of which the newest counts.

    Three parts of the month land one after the other; what is delivered again lands with the part
    after its own, within the delay. A candle of two months later closes the last bars.
    """
    raw, output, check = (scratch_folder(spark, n) for n in ("raw", "bars", "check"))
    documents = feeds.delivery_documents(spark, sf)
    first, middle, last = ("2024-01-01", "2024-01-11"), ("2024-01-11", "2024-01-21"), ("2024-01-21", "2024-02-01")
    closing = documents.agg((F.max("ts") + 60 * 86_400).cast("double").alias("t")).select(
        F.lit("closing").alias("symbol"), F.lit("NSE").alias("exchange"), F.lit("2024-04-01T00:00:00Z").alias("ingest_ts"),
        F.struct(F.array(F.array(F.col("t"), *[F.lit(0.0)] * 5)).alias("candles"), F.lit("ok").alias("s")).alias(ENVELOPE),
    )

    def landing(fresh, again):
        parts = [
            documents.where((F.col("ingest_ts") >= a) & (F.col("ingest_ts") < b) & (F.col("ingest_seq") == seq)).drop("ts", "ingest_seq")
            for seq, span in ((1, fresh), (2, again)) if span for a, b in [span]
        ]
        return op.union_timeframes(parts if fresh else [*parts, closing])

    for fresh, again in ((first, None), (middle, first), (last, middle), (None, last)):
        sinks.land_raw(landing(fresh, again), raw, one_per_file=False)
        stream = start_bar_stream(
            spark, raw, output, check, M15, delay="21 days", multi_line=False,
            state_partitions=spark.sparkContext.defaultParallelism,
        )
        stream.awaitTermination()
    return sources.read_dated_bars(spark, output)


# Versions, sessions, coverage ---------------------------------------------------------------

INSTANTS = ("2024-01-12T00:00:00Z", "2024-01-20T12:00:00Z", "2024-02-05T00:00:00Z")


def _known_at(instant: str) -> str:
    newest = f"""select symbol, exchange, ts, open, high, low, "close", volume from versions
        where ingest_ts <= '{instant}' qualify row_number() over (partition by symbol, ts order by ingest_ts desc,
            row_id desc, exchange desc, open desc, high desc, low desc, "close" desc, volume desc) = 1"""
    return f"select *, '{instant}' as as_of from ({o.bars('15m', source=f'({newest})')})"


@query("bars_as_of", o.with_(
    o.EVENT_TICKS, o.TICK_VERSIONS, body=" union all ".join(f"({_known_at(i)})" for i in INSTANTS),
))
def bars_as_of(spark, sf):
    """AGG-5, SRC-6: bars as they were known at three instants, from one table of versions."""
    known = op.as_of_each(op.candle_versions(feeds.tick_versions(spark, sf)), INSTANTS)
    return op.union_timeframes([
        op.resample(known.where(F.col("as_of") == i), M15).withColumn("as_of", F.lit(i)) for i in INSTANTS
    ])


@query("candle_versions", o.with_(
    o.EVENT_TICKS, o.TICK_VERSIONS,
    body=f"""select symbol, exchange, ts, {o.FIELDS}, ingest_ts, row_id as pos, ingest_ts as valid_from,
        lead(ingest_ts) over (partition by symbol, ts order by ingest_ts) as valid_to
    from (select * from versions qualify row_number() over (partition by symbol, ts, ingest_ts order by row_id desc,
        exchange desc, open desc, high desc, low desc, "close" desc, volume desc) = 1)""",
))
def candle_versions(spark, sf):
    """SRC-6: every version of a candle with the interval in which it was the newest."""
    return op.candle_versions(feeds.tick_versions(spark, sf))


_PLACED = """placed as (
    select c.*, s.session, s.opens, s.closes from candles c
    join calendar s on c.exchange = s.exchange and c.ts >= s.opens and c.ts < s.closes)"""


def _session_bars(start: str, end: str) -> str:
    return f"""select symbol, exchange, session, {o.clock('interval_start_epoch')} as interval_start, interval_start_epoch,
        interval_end_epoch, {o.FIELDS} from (
        select symbol, exchange, session, {start} as interval_start_epoch, {end} as interval_end_epoch,
            arg_min(open, ts) as open, max(high) as high, min(low) as low, arg_max("close", ts) as "close", sum(volume) as volume
        from placed group by all)"""


@query("session_bars_50m", o.with_(
    *EVENTS, o.CALENDAR, _PLACED,
    body=_session_bars("opens + (ts - opens) // 3000 * 3000", "least(opens + (ts - opens) // 3000 * 3000 + 3000, closes)"),
))
def session_bars_50m(spark, sf):
    """FLT-4, OP-2: buckets from the open of each session, the last one cut at its close."""
    return op.session_bars(event_candles(spark, sf), feeds.calendar(spark, sf), 3_000)


@query("session_bars_whole", o.with_(*EVENTS, o.CALENDAR, _PLACED, body=_session_bars("opens", "closes")))
def session_bars_whole(spark, sf):
    """OP-2: one bar a session, half days included."""
    return op.session_bars(event_candles(spark, sf), feeds.calendar(spark, sf))


@query("session_outside", o.with_(
    *EVENTS, o.CALENDAR,
    body="""select * from candles c where not exists (
        select 1 from calendar s where c.exchange = s.exchange and c.ts >= s.opens and c.ts < s.closes)""",
))
def session_outside(spark, sf):
    """FLT-4: candles that no session holds."""
    return op.outside_sessions(event_candles(spark, sf), feeds.calendar(spark, sf))


@query("session_counts", o.with_(
    *EVENTS, o.CALENDAR,
    body="""select c.exchange, cast(count(s.session) as bigint) as inside, cast(count(*) - count(s.session) as bigint) as outside
        from candles c left join calendar s on c.exchange = s.exchange and c.ts >= s.opens and c.ts < s.closes group by 1""",
))
def session_counts(spark, sf):
    """FLT-4: how many candles the calendar takes and leaves."""
    return op.session_counts(event_candles(spark, sf), feeds.calendar(spark, sf))


FIRST_RUN, LAST_RUN, EVERY = 1_704_067_200, 1_706_745_600, 1_800  # January 2024, every half hour


def covered_runs(spark: SparkSession, sf: str, tickers: DataFrame) -> DataFrame:
    """Runs of the event types' symbols and of tickers that never ran."""
    outcomes = feeds.event_outcomes(spark, sf)
    run = op.run_of(F.unix_timestamp(F.to_timestamp("run_ts", "yyyy-MM-dd'T'HH:mm:ssX")), FIRST_RUN, EVERY)
    fetched = outcomes.withColumn("run", run)
    universe = tickers.unionByName(outcomes.select("symbol").where("symbol is not null"))
    schedule = (FIRST_RUN, LAST_RUN - EVERY, EVERY)
    tasks = op.coverage_tasks(universe, *schedule, fetches=outcomes.count())
    return op.run_coverage(
        op.expected_runs(universe, *schedule, tasks),
        op.successes(fetched).select("symbol", "run"), op.failures(fetched).select("symbol", "run"), tasks,
    )


def every_ticker(spark: SparkSession, sf: str) -> DataFrame:
    return sources.parse_tickers(feeds.ticker_lines(spark, sf))


def some_tickers(spark: SparkSession, sf: str) -> DataFrame:
    """Tickers of the customers whose number ends in 0."""
    return every_ticker(spark, sf).where(F.col("symbol").endswith("0/X-EQ"))


_FETCHES = f"""fetches as (
    select symbol, {FIRST_RUN} + (cast(epoch(strptime(run_ts, '%Y-%m-%dT%H:%M:%SZ')) as bigint) - {FIRST_RUN}) // {EVERY} * {EVERY} as run,
        cast(count(*) filter (where ok) as bigint) as landed, cast(count(*) filter (where not ok) as bigint) as failed
    from outcomes where symbol is not null group by all)"""

_COVERED = f"""coverage as (
    select symbol, run, case when landed > 0 then 'landed' when failed > 0 then 'failed' else 'absent' end as status,
        coalesce(landed + failed, 0) as fetches
    from (select symbol, unnest(range({FIRST_RUN}, {LAST_RUN}, {EVERY})) as run from universe) left join fetches using (symbol, run))"""

_COVERAGE = (
    o.OUTCOMES, o.TICKERS,
    """universe as (
    select symbol from tickers union select symbol from outcomes where symbol is not null)""",
    _FETCHES, _COVERED,
)

_SOME_COVERAGE = (
    o.OUTCOMES, o.TICKERS,
    """universe as (
    select symbol from tickers where symbol like '%0/X-EQ' union select symbol from outcomes where symbol is not null)""",
    _FETCHES, _COVERED,
)


@query("run_coverage", o.with_(*_COVERAGE, body="select * from coverage"))
def run_coverage(spark, sf):
    """SRC-3, AGG-6: the state of every scheduled run of every ticker."""
    return covered_runs(spark, sf, every_ticker(spark, sf))


@query("run_coverage_counts", o.with_(*_SOME_COVERAGE, body="""select symbol,
    cast(count(*) filter (where status = 'landed') as bigint) as landed, cast(count(*) filter (where status = 'failed') as bigint) as failed,
    cast(count(*) filter (where status = 'absent') as bigint) as absent, cast(0 as bigint) as unexpected,
    count(*) filter (where status = 'landed') / count(*) as share from coverage group by symbol"""))
def run_coverage_counts(spark, sf):
    """AGG-7, AGG-8: runs by symbol and state."""
    return op.coverage_counts(covered_runs(spark, sf, some_tickers(spark, sf)))


@query("run_absences", o.with_(*_COVERAGE, body=f"""select symbol, min(run) as first_run, max(run) as last_run,
    cast(count(*) as bigint) as runs, cast(count(*) filter (where status = 'failed') as bigint) as failed
    from (select *, run - row_number() over (partition by symbol order by run) * {EVERY} as span from coverage where status <> 'landed')
    group by symbol, span"""))
def run_absences(spark, sf):
    """SRC-3, AGG-6 to AGG-8: unbroken spans of runs that did not land."""
    return op.absences(covered_runs(spark, sf, every_ticker(spark, sf)), EVERY)
