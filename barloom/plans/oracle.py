"""SQL building blocks for checking the registered queries against another engine."""

from __future__ import annotations

IST = 19_800
WIDTHS = {"1m": (60, 0), "5m": (300, 0), "15m": (900, 0), "1h": (3_600, 0), "1d": (86_400, IST)}
FIELDS = 'open, high, low, "close", volume'


def epoch(column: str) -> str:
    return f"cast(floor(epoch({column})) as bigint)"


def iso(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%SZ')"


def bucket(seconds: int, offset: int, ts: str = "ts") -> str:
    return f"({ts} - ((({ts} + {offset}) % {seconds}) + {seconds}) % {seconds})"


def clock(ts: str, offset: int = IST) -> str:
    return f"make_timestamp(cast(({ts} + {offset}) * 1000000 as bigint))"


def date_parts(clock_sql: str) -> str:
    return ", ".join(
        f"strftime({clock_sql}, '{f}') as {name}"
        for name, f in (("year", "%Y"), ("month", "%m"), ("day", "%d"))
    )


def prices(price: str, volume: str) -> str:
    return (
        f"{price} as open, {price} + 1 as high, {price} - 1 as low, "
        f'{price} + 0.25 as "close", {volume} as volume'
    )


def with_(*ctes: str, body: str) -> str:
    return f"with {', '.join(ctes)} {body}"


EVENT_TICKS = f"""ticks as (
    select event_type as symbol, 'NSE' as exchange, {epoch("ts")} as ts,
        {prices("value", "cast(event_id % 1000 as double) + seq - 1")},
        seq as ingest_seq, event_id as row_id
    from events, (values (1), (2)) v(seq) where seq = 1 or value < 8)"""

ORDER_TICKS = f"""ticks as (
    select o_orderpriority as symbol, 'ORD' as exchange, {epoch("o_orderdate")} as ts,
        {prices("o_totalprice", "cast(o_custkey as double)")},
        1 as ingest_seq, o_orderkey as row_id
    from orders)"""

LINEITEM_TICKS = f"""ticks as (
    select 'S' || l_suppkey as symbol, l_linestatus as exchange,
        {epoch("l_shipdate")} + l_linenumber * 60 as ts,
        {prices("l_extendedprice", "l_quantity")},
        1 as ingest_seq, l_orderkey as row_id
    from lineitem)"""

# One row per (symbol, ts): the newest, remaining ties by the other columns.
CANDLES = """candles as (
    select symbol, exchange, ts, open, high, low, "close", volume from ticks
    qualify row_number() over (partition by symbol, ts order by ingest_seq desc, row_id desc,
        exchange desc, open desc, high desc, low desc, "close" desc, volume desc) = 1)"""

DOCUMENTS = f"""docs as (
    select 'NSE_' || upper(event_type) || '-EQ' as symbol,
        'NSE:' || upper(event_type) || '-EQ' as ticker, 'NSE' as exchange,
        {iso("ts")} as ingest_ts,
        case when value < 0.5 then 'error' when value < 2 then 'no_data' else 'ok' end as status,
        case when value < 1 then null
            when value < 2 then cast([] as double[][])
            when value < 3 then cast([[t, o, o + 1],
                [t, o, o + 1, o - 1, o + 0.25, v]] as double[][])
            else cast([[t, o, o + 1, o - 1, o + 0.25, v],
                [t + 60, o, o + 1, o - 1, o + 0.25, v, 9]] as double[][]) end as candles
    from (select *, cast({epoch("ts")} as double) as t, value as o,
        cast(event_id % 1000 as double) as v from events))"""

EXPLODED = """exploded as (
    select symbol, ticker, exchange, ingest_ts, status, unnest(candles) as candle,
        generate_subscripts(candles, 1) - 1 as pos
    from docs)"""

DOCUMENT_ROWS = """document_rows as (
    select symbol, ticker, exchange, ingest_ts, status, pos, cast(candle[1] as bigint) as ts,
        candle[2] as open, candle[3] as high, candle[4] as low, candle[5] as "close",
        candle[6] as volume
    from exploded where len(candle) >= 6)"""

DOCUMENT_CANDLES = """candles as (
    select symbol, exchange, ts, open, high, low, "close", volume from document_rows
    qualify row_number() over (partition by symbol, ts order by ingest_ts desc, pos desc,
        exchange desc, open desc, high desc, low desc, "close" desc, volume desc) = 1)"""

OUTCOMES = f"""outcomes as (
    select case when value < 9 or value >= 10 then 'NSE:' || upper(event_type) || '-EQ' end
            as symbol,
        value >= 10 as ok,
        case when value < 2 then 1 when value < 9 then 5 when value < 10 then 0
            else 1 + cast(floor(value / 100) as integer) end as attempts,
        case when value >= 10 then 200 end as http_status,
        case when value < 2 then 'missing_credentials' when value < 6 then 'Exhausted 5 attempts'
            when value < 9 then 'no answer, 5 times' when value < 10 then 'read timed out' end
            as error,
        value >= 2 and value < 9 as gave_up,
        {iso("ts")} as run_ts
    from events)"""

TICKERS = """tickers as (
    select 'NSE:' || c_name || '/X-EQ' as symbol from customer where c_acctbal >= 0)"""

DOCUMENT_TEXT = f"""texts as (
    select 'NSE:' || upper(event_type) || '-EQ' as symbol, 'NSE' as exchange,
        {iso("ts")} as ingest_ts, value, cast(value as varchar) as p,
        cast({epoch("ts")} as varchar) as t
    from events)"""

# Ticks with a version: a second delivery came ten days after the first.
TICK_VERSIONS = f"""versions as (
    select symbol, exchange, ts, {FIELDS}, row_id,
        strftime(make_timestamp((ts + (ingest_seq - 1) * 864000) * 1000000), '%Y-%m-%dT%H:%M:%SZ') as ingest_ts
    from ticks)"""

CALENDAR = """calendar as (
    select 'NSE' as exchange, cast(d as date) as session, cast(epoch(d) as bigint) - 19800 + 33300 as opens,
        cast(epoch(d) as bigint) - 19800 + 33300 + case when day(d) % 7 = 0 then 11700 else 22500 end as closes
    from (select unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), interval 1 day)) as d from events)
    where dayofweek(d) <> 0)"""

RANKED = """ranked as (
    select symbol, exchange, ts, open, {b} as interval_start_epoch,
        row_number() over (partition by symbol, exchange, {b} order by ts {order}) as rn
    from candles)"""


def aggregates(timeframe: str, source: str = "candles", order: str = "ts") -> str:
    """Bars of one width, before wall clocks and date parts."""
    return f"""select symbol, exchange, '{timeframe}' as timeframe,
        {bucket(*WIDTHS[timeframe])} as interval_start_epoch,
        arg_min(open, {order}) as open, max(high) as high, min(low) as low,
        arg_max("close", {order}) as "close", sum(volume) as volume
    from {source} group by all"""


def finish(aggregate_sql: str, offset: int = IST, where: str = "") -> str:
    at = clock("interval_start_epoch", offset)
    return f"""select symbol, exchange, timeframe, {at} as interval_start, interval_start_epoch,
        {date_parts(at)}, {FIELDS} from ({aggregate_sql}) {where}"""


def bars(timeframe: str, **kwargs) -> str:
    return finish(aggregates(timeframe, **kwargs))


def all_bars(widths=("1m", "5m", "15m", "1d"), **kwargs) -> str:
    return finish(" union all ".join(f"({aggregates(t, **kwargs)})" for t in widths))
