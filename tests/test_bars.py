"""Bars against brute force, and the different ways to build them against each other."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from barloom import TIMEFRAMES, Timeframe
from barloom import operators as op
from barloom.operators import bars as bar_operators, branches
from barloom.plans.catalog import QUERIES
from barloom.session import joined_in_place, written_in_buckets

SCHEMA = (
    "symbol string, exchange string, ts bigint, open double, high double, low double, "
    "close double, volume double"
)
M1, M5, M15, D1 = TIMEFRAMES
IST = 19_800
START = 1736101800  # local midnight of 2025-01-06


def make_rows(n, seed=1, unique=True):
    rnd = random.Random(seed)
    seen, rows = set(), []
    while len(rows) < n:
        symbol, ts = rnd.choice("ABC"), START + rnd.randrange(3 * 86_400) // 20 * 20
        if unique and (symbol, ts) in seen:
            continue
        seen.add((symbol, ts))
        values = [float(rnd.randrange(1, 1000)) if rnd.random() > 0.1 else None for _ in range(5)]
        rows.append((symbol, rnd.choice(["NSE", "BSE"]), ts, *values))
    return rows


def brute_force(rows, timeframes=TIMEFRAMES, day_offset=IST):
    groups = {}
    for symbol, exchange, ts, *values in rows:
        for t in timeframes:
            offset = day_offset if t.is_day else 0
            start = (ts + offset) // t.seconds * t.seconds - offset
            groups.setdefault((symbol, exchange, t.label, start), []).append((ts, *values))
    bars = set()
    for (symbol, exchange, label, start), group in groups.items():
        group.sort(key=lambda r: r[0])
        highs, lows, volumes = ([r[i] for r in group if r[i] is not None] for i in (2, 3, 5))
        clock = datetime.fromtimestamp(start, timezone.utc) + timedelta(seconds=day_offset)
        bars.add((
            symbol, exchange, label, clock.replace(tzinfo=None), start,
            *f"{clock:%Y-%m-%d}".split("-"),
            group[0][1], max(highs, default=None), min(lows, default=None), group[-1][4],
            sum(volumes) if volumes else None,
        ))
    return bars


def collected(bars):
    rows = [tuple(r) for r in bars.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_every_way_gives_the_brute_force_bars(spark):
    rows = make_rows(3000)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    expected = brute_force(rows)
    assert collected(op.all_timeframes(frame, unique_ts=True)) == expected
    assert collected(op.all_timeframes(frame)) == expected
    singles = [op.resample(frame, t) for t in TIMEFRAMES]
    assert collected(op.union_timeframes(singles)) == expected
    joined = [branches.resample_by_joins(frame, t) for t in TIMEFRAMES]
    assert collected(op.union_timeframes(joined)) == expected


def test_utc_days(spark):
    rows = make_rows(500)
    frame = spark.createDataFrame(rows, SCHEMA)
    assert collected(op.all_timeframes(frame, zone="UTC", unique_ts=True)) == brute_force(
        rows, day_offset=0
    )


@pytest.mark.parametrize("unique_ts", [True, False])
def test_widths_that_do_not_nest(spark, unique_ts):
    widths = (Timeframe("7m", 420), Timeframe("1h", 3600), D1)
    rows = make_rows(800)
    frame = spark.createDataFrame(rows, SCHEMA)
    bars = op.all_timeframes(frame, widths, unique_ts=unique_ts)
    assert collected(bars) == brute_force(rows, widths)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("AB"), st.integers(-10**6, 10**6)), unique=True,
                min_size=1, max_size=60))
def test_any_epochs(spark, keys):
    rows = [(s, "X", ts, float(i), i + 1.0, i - 1.0, i + 0.5, 1.0)
            for i, (s, ts) in enumerate(keys)]
    bars = op.all_timeframes(spark.createDataFrame(rows, SCHEMA), unique_ts=True)
    assert collected(bars) == brute_force(rows)


def test_invariants(spark):
    rows = [r for r in make_rows(2000) if None not in r]
    rows = [(*r[:3], r[3], max(r[3:7]), min(r[3:7]), r[6], r[7]) for r in rows]
    bars = op.all_timeframes(spark.createDataFrame(rows, SCHEMA), unique_ts=True).cache()
    assert bars.where("NOT (low <= open AND low <= close AND open <= high AND close <= high)") \
        .isEmpty()
    volumes = bars.groupBy("timeframe").agg(F.sum("volume").alias("v")).collect()
    assert {r.v for r in volumes} == {sum(r[7] for r in rows)}
    bars.unpersist()


def test_tie_break_settles_open_and_close(spark):
    rows = [
        ("A", "X", START, 1.0, 9.0, 1.0, 2.0, 1.0, 2),
        ("A", "X", START, 3.0, 9.0, 1.0, 4.0, 1.0, 1),
        ("A", "X", START, 5.0, 9.0, 1.0, 6.0, 1.0, 3),
    ]
    frame = spark.createDataFrame(rows, SCHEMA + ", seq int").repartition(3)
    for bars in (
        op.resample(frame, M5, tie_break=["seq"]),
        op.all_timeframes(frame, tie_break=["seq"]).where("timeframe = '5m'"),
        branches.resample_by_joins(frame, M5, tie_break=["seq"]),
    ):
        (bar,) = bars.collect()
        assert (bar.open, bar.close, bar.volume) == (3.0, 6.0, 3.0)


def test_a_null_symbol_makes_whole_bars_except_by_joins(spark):
    rows = [(None, "X", START + i, float(i), 9.0, 0.0, float(i), 1.0) for i in range(3)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for bars in (op.resample(frame, M1), op.all_timeframes(frame, [M1], unique_ts=True)):
        (bar,) = bars.collect()
        assert (bar.symbol, bar.open, bar.close, bar.volume) == (None, 0.0, 2.0, 3.0)
    (bar,) = branches.resample_by_joins(frame, M1).collect()
    assert (bar.open, bar.close, bar.volume) == (None, None, 3.0)


def test_same_bars_under_every_session_zone(spark, session_zone):
    frame = spark.createDataFrame(make_rows(200), SCHEMA)
    seen = []
    for zone in ("UTC", "Asia/Kolkata", "America/New_York"):
        session_zone(zone)
        seen.append(collected(op.all_timeframes(frame, unique_ts=True)))
    assert seen[0] == seen[1] == seen[2] == brute_force(make_rows(200))


def test_two_shuffles_from_copies_to_all_widths(spark):
    frame = spark.createDataFrame([(*r, "v1", 0) for r in make_rows(100)],
                                  SCHEMA + ", ingest_ts string, pos int")
    candles = op.dedup_latest(frame)
    bars = op.all_timeframes(candles, unique_ts=True)
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2
    assert "Join" not in plan


def test_widths_that_do_not_nest_take_one_shuffle_more_than_copies(spark):
    frame = spark.createDataFrame([(*r, "v1", 0) for r in make_rows(100)],
                                  SCHEMA + ", ingest_ts string, pos int")
    widths = (M5, Timeframe("1h", 3600), D1)
    bars = op.all_timeframes(op.dedup_latest(frame), widths, unique_ts=True)
    plan = bars._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_dedup_refuses_rows_without_a_version(spark):
    with pytest.raises(ValueError, match="version"):
        op.dedup_latest(spark.createDataFrame(make_rows(3), SCHEMA))


def test_dedup_keeps_the_newest_whatever_the_layout(spark):
    rnd = random.Random(3)
    rows = []
    for ts in range(START, START + 600, 60):
        for _ in range(40):
            values = [float(rnd.randrange(9)) for _ in range(5)]
            rows.append(("A", rnd.choice(["NSE", "BSE"]), ts, *values,
                         f"2025-01-06T{rnd.randrange(3):02d}:00:00Z", rnd.randrange(2)))
    schema = SCHEMA + ", ingest_ts string, pos int"
    best = {}
    for r in rows:
        rank = (r[8], r[9], r[1], *r[3:8])
        if r[2] not in best or rank > best[r[2]][0]:
            best[r[2]] = (rank, r)
    expected = {r for _, r in best.values()}
    frame = spark.createDataFrame(rows, schema)
    columns = ["symbol", "exchange", "ts", "open", "high", "low", "close", "volume",
               "ingest_ts", "pos"]
    for n in (1, 3, 8):
        kept = op.dedup_latest(frame.repartition(n)).select(columns).collect()
        assert {tuple(r) for r in kept} == expected


def test_copies_of_a_hot_key_shrink_before_the_shuffle(spark):
    """A third of all rows are copies of one candle: one row per task crosses the shuffle."""
    n = 60_000
    rows = spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(
            F.concat(F.lit("S"), (F.col("id") % 97).cast("string"))).alias("symbol"),
        F.lit("X").alias("exchange"),
        F.when(F.col("id") % 3 == 0, F.lit(START)).otherwise(START + F.col("id")).alias("ts"),
        *[F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
        F.col("id").cast("string").alias("ingest_ts"), F.lit(0).alias("pos"),
    )
    kept = op.dedup_latest(rows)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning")  # printed top down
    assert kept.count() == 2 * n // 3 + 1
    hot = kept.where("symbol = 'HOT'").collect()
    assert len(hot) == 1 and hot[0].ingest_ts == "9999"


def lineitem(spark, folder):
    spark.range(3000).selectExpr(
        "id as l_orderkey", "id % 7 as l_suppkey", "cast(id % 3 as int) as l_linenumber", "'O' as l_linestatus",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 90 as int)) as l_shipdate",
        "cast(id as double) as l_extendedprice", "1.0D as l_quantity",
    ).write.parquet(f"{folder}/lineitem.parquet")


def test_placement_takes_tasks_by_rows(spark, tmp_path, monkeypatch):
    lineitem(spark, tmp_path)
    whole = collected(QUERIES["all_timeframes_many_series"](spark, str(tmp_path)))
    monkeypatch.setattr(bar_operators, "ROWS_OF_TASK", 100)
    bars = QUERIES["all_timeframes_many_series"](spark, str(tmp_path))
    assert bars.rdd.getNumPartitions() == 30
    assert collected(bars) == whole == collected(QUERIES["all_timeframes_by_joins"](spark, str(tmp_path)))


def test_joins_of_several_widths_read_their_candles_once(spark, tmp_path):
    lineitem(spark, tmp_path)
    plan = QUERIES["all_timeframes_by_joins"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "l_suppkey" not in plan


def test_joins_after_a_placement_give_the_bars_of_the_plain_ones(spark):
    rows = make_rows(2000) + [(None, "NSE", START, *[1.0] * 5), ("A", None, START, *[2.0] * 5), ("B", "NSE", None, *[3.0] * 5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for t in TIMEFRAMES:
        assert collected(branches.resample_by_joins(frame, t, unique_ts=True)) == collected(branches.resample_by_joins(frame, t))


def test_joins_find_their_sides_where_candles_lie(spark, tmp_path):
    lineitem(spark, tmp_path)
    before, tables = dict(spark.sql("set").collect()), spark.catalog.listTables()
    bars = QUERIES["all_timeframes_by_joins"](spark, str(tmp_path))
    lineage = bars._jdf.queryExecution().toRdd().toDebugString()
    assert "SortMerge" not in lineage and "ShuffledRowRDD" not in lineage and "FileScanRDD" in lineage
    assert dict(spark.sql("set").collect()) == before and spark.catalog.listTables() == tables
    assert collected(bars) == collected(QUERIES["all_timeframes_many_series"](spark, str(tmp_path)))


def test_joins_of_placed_rows_give_the_bars_of_the_plain_ones(spark):
    rows = make_rows(2000) + [(None, "NSE", START, *[1.0] * 5), ("A", None, START, *[2.0] * 5), ("B", "NSE", None, *[3.0] * 5)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for some in (frame, frame.limit(0)):
        placed = written_in_buckets(spark, some, "candles", 5, branches.home_keys(D1))
        for t in TIMEFRAMES:
            bars = joined_in_place(spark, branches.resample_by_joins(placed, t, unique_ts=True, home=D1))
            assert collected(bars) == collected(branches.resample_by_joins(some, t))
    with pytest.raises(ValueError, match="nest"):
        branches.resample_by_joins(placed, D1, home=M15)
