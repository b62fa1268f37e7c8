"""Versions, sessions and run coverage against plain computations."""

import random

import pytest
from pyspark.sql import functions as F

from barloom import operators as op
from barloom.operators.coverage import RUNS_OF_TASK
from barloom.plans.catalog import QUERIES
from test_files import triples

FIELDS = "symbol string, exchange string, ts long, open double, high double, low double, close double, volume double"


def version_rows(seed):
    draw = random.Random(seed)
    return [
        (draw.choice("AB"), draw.choice(["NSE", "BSE"]), 60 * draw.randint(0, 5), *[float(draw.randint(0, 9)) for _ in range(5)],
         draw.choice([None, *[f"2024-01-0{d}T00:00:00Z" for d in range(1, 8)]]), draw.randint(0, 2)) for _ in range(150)
    ]


@pytest.mark.parametrize("instant", ["2023-01-01T00:00:00Z", "2024-01-03T00:00:00Z", "2024-01-04T12:00:00Z", "2030-01-01T00:00:00Z"])
def test_as_of_equals_a_rebuild_from_what_had_landed(spark, instant):
    rows = spark.createDataFrame(version_rows(7), f"{FIELDS}, ingest_ts string, pos int")
    versions = op.candle_versions(rows)
    landed = rows.where(F.col("ingest_ts").isNull() | (F.col("ingest_ts") <= instant))
    expected = op.dedup_latest(landed)
    assert triples(op.as_of(versions, instant).na.fill("-"), *rows.columns) == triples(expected.na.fill("-"), *rows.columns)
    each = op.as_of_each(versions, [instant, "2024-01-02T00:00:00Z"]).where(F.col("as_of") == instant)
    assert triples(each.na.fill("-"), *rows.columns) == triples(expected.na.fill("-"), *rows.columns)


def test_changes_lead_from_one_instant_to_the_other(spark):
    rows = spark.createDataFrame(version_rows(8), f"{FIELDS}, ingest_ts string, pos int")
    versions = op.candle_versions(rows)
    a, b = "2024-01-02T00:00:00Z", "2024-01-06T00:00:00Z"
    changed = op.changes_between(versions, a, b)
    assert not changed.isEmpty()
    merged = op.dedup_latest(op.as_of(versions, a).unionByName(changed))
    assert triples(merged.na.fill("-"), *rows.columns) == triples(op.as_of(versions, b).na.fill("-"), *rows.columns)
    assert op.candle_versions(rows.limit(0)).count() == op.as_of_each(versions, []).count() == 0


SESSIONS = [("NSE", "d1", 1000, 1600), ("NSE", "d2", 2000, 2250), ("NSE", "night", 86_000, 90_000), ("BSE", "d1", 900, 1700), ("NSE", "shut", 5000, 5000)]


@pytest.mark.parametrize("width", [100, 86_400])
def test_sessions_by_brute_force(spark, width):
    draw = random.Random(width)
    rows = [(draw.choice("AB"), draw.choice(["NSE", "BSE", "LSE", None]), t, float(t % 97), float(t % 89), float(t % 83), float(t % 79), 1.0)
            for t in draw.sample([*range(800, 2600, 7), *range(85_500, 91_000, 50), 5000], 330)] + [("A", "NSE", None, *[1.0] * 5)]
    frame = spark.createDataFrame(rows, FIELDS)
    sessions = spark.createDataFrame(SESSIONS, "exchange string, session string, opens long, closes long")

    def of(r):
        return next((s for s in SESSIONS if r[2] is not None and s[0] == r[1] and s[2] <= r[2] < s[3]), None)

    inside = op.in_sessions(frame, sessions, width)
    assert sorted(map(str, triples(inside, *frame.columns, "session"))) == sorted(str((*r, of(r)[1])) for r in rows if of(r))
    outside = op.outside_sessions(frame, sessions, width)
    assert sorted(str(tuple(r)) for r in outside.collect()) == sorted(str(r) for r in rows if not of(r))
    counts = {r.exchange: (r.inside, r.outside) for r in op.session_counts(frame, sessions, width).collect()}
    assert counts == {e: tuple(sum((of(r) is not None) == i for r in rows if r[1] == e) for i in (True, False)) for e in ("NSE", "BSE", "LSE", None)}
    buckets = {}
    for r in rows:
        if of(r):
            start = of(r)[2] + (r[2] - of(r)[2]) // 250 * 250
            buckets.setdefault((r[0], r[1], of(r)[1], start, min(start + 250, of(r)[3])), []).append(r)
    expected = []
    for key, some in buckets.items():
        some.sort(key=lambda r: r[2])
        expected.append((*key, some[0][3], max(r[4] for r in some), min(r[5] for r in some), some[-1][6], float(len(some))))
    bars = op.session_bars(frame, sessions, 250, bin_seconds=width)
    names = ("symbol", "exchange", "session", "interval_start_epoch", "interval_end_epoch", "open", "high", "low", "close", "volume")
    assert triples(bars, *names) == sorted(expected)
    assert op.session_bars(frame, sessions.limit(0)).count() == 0 and op.outside_sessions(frame, sessions.limit(0)).count() == len(rows)


def test_sessions_join_is_no_cross_product(spark):
    frame = spark.createDataFrame([("A", "NSE", 1000, *[1.0] * 5)], FIELDS)
    sessions = spark.createDataFrame(SESSIONS, "exchange string, session string, opens long, closes long")
    for joined in (op.in_sessions(frame, sessions), op.outside_sessions(frame, sessions)):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_run_coverage(spark):
    schema = "symbol string, run long"
    due = op.expected_runs(spark.createDataFrame([("A",), ("A",), ("B",)], "symbol string"), 0, 50, 10)
    assert due.count() == 12
    landed = spark.createDataFrame([("A", 0), ("A", 0), ("A", 30), ("C", 0), (None, 0), ("B", 60)], schema)
    failed = spark.createDataFrame([("A", 0), ("A", 20), ("A", 20)], schema)
    coverage = op.run_coverage(due, landed, failed)
    assert triples(coverage.where("symbol <> 'B' or run > 40"), *coverage.columns) == [
        ("A", 0, "landed", 3), ("A", 10, "absent", 0), ("A", 20, "failed", 2), ("A", 30, "landed", 1), ("A", 40, "absent", 0),
        ("A", 50, "absent", 0), ("B", 50, "absent", 0), ("B", 60, "unexpected", 1), ("C", 0, "unexpected", 1),
    ]
    spans = op.absences(coverage, 10)
    assert triples(spans, "symbol", "first_run", "last_run", "runs", "failed") == [
        ("A", 10, 20, 2, 1), ("A", 40, 50, 2, 0), ("B", 0, 50, 6, 0),
    ]
    counts = op.coverage_counts(coverage)
    assert sorted(map(str, triples(counts, *counts.columns))) == sorted(map(str, [
        ("A", 2, 1, 3, 0, 2 / 6), ("B", 0, 0, 6, 1, 0.0), ("C", 0, 0, 0, 1, None),
    ]))
    instants = spark.createDataFrame([(i,) for i in (5, 14, 15, 24)], "at long")
    assert sorted(r.run for r in instants.select(op.run_of(F.col("at"), 5, 10).alias("run")).collect()) == [5, 5, 15, 15]


def test_expected_runs_are_spread_by_their_number(spark):
    tickers = spark.range(3_000).select(F.concat(F.lit("S"), "id").alias("symbol"))
    runs = op.expected_runs(tickers, 0, 999 * 60, 60)
    by_task = runs.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert sum(r["count"] for r in by_task) == 3_000_000
    assert max(r["count"] for r in by_task) < 2_000_000


def test_run_coverage_meets_in_tasks_of_bounded_size(spark):
    tickers = spark.range(3_000).select(F.concat(F.lit("S"), "id").alias("symbol"))
    runs = op.expected_runs(tickers, 0, 999 * 60, 60)
    landed = runs.where("run < 600")
    coverage = op.run_coverage(runs, landed, landed.limit(0))
    by_task = coverage.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("rows"), F.count_if(F.col("status") == "landed").alias("landed")
    ).collect()
    assert sum(r["rows"] for r in by_task) == 3_000_000 and sum(r.landed for r in by_task) == 30_000
    assert max(r["rows"] for r in by_task) < 2_000_000
    assert op.absences(coverage, 60).agg(F.count("*"), F.sum("runs")).first()[:] == (3_000, 2_970_000)


def test_run_coverage_leaves_expected_runs_where_they_lie(spark):
    tickers = spark.range(50).select(F.concat(F.lit("S"), "id").alias("symbol"))
    landed = spark.createDataFrame([("S1", 0), ("S1", 60), ("S3", 60), ("T", 60), (None, 0), ("S4", 7)], "symbol string, run long")
    failed = spark.createDataFrame([("S1", 0), ("S2", 120)], "symbol string, run long")
    tasks = op.coverage_tasks(tickers, 0, 600, 60, fetches=2 * RUNS_OF_TASK)
    assert tasks == 3
    placed = op.run_coverage(op.expected_runs(tickers, 0, 600, 60, tasks), landed, failed, tasks)
    spans = op.absences(placed, 60)
    for frame in (placed, spans, op.coverage_counts(placed)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan[:plan.index("Generate explode")]  # printed top down
    moved = op.run_coverage(op.expected_runs(tickers, 0, 600, 60), landed, failed)
    assert triples(placed, *placed.columns) == triples(moved, *moved.columns)
    assert triples(spans, *spans.columns) == triples(op.absences(moved, 60), *spans.columns)


def tickers_and_events(spark, folder):
    spark.range(25).selectExpr("concat('Customer#', id) as c_name", "cast(id as double) - 1 as c_acctbal").write.parquet(f"{folder}/customer.parquet")
    spark.range(4).selectExpr(
        "id as event_id", "'buy' as event_type", "cast(20 * (id - 1) as double) as value",
        "timestamp_ntz'2024-01-01 00:10:00' + make_dt_interval(0, cast(id as int)) as ts",
    ).write.parquet(f"{folder}/events.parquet")
    return ["NSE:BUY-EQ", *sorted(f"NSE:Customer#{i}/X-EQ" for i in range(1, 25))]


def test_absences_of_every_ticker(spark, tmp_path):
    symbols = tickers_and_events(spark, tmp_path)
    spans = QUERIES["run_absences"](spark, str(tmp_path))
    assert sorted({r.symbol for r in spans.collect()}) == symbols
    assert spans.where("symbol like '%Customer%'").agg(F.count("*"), F.sum("runs")).first()[:] == (24, 24 * 31 * 48)


def test_coverage_of_every_ticker(spark, tmp_path):
    symbols = tickers_and_events(spark, tmp_path)
    coverage = QUERIES["run_coverage"](spark, str(tmp_path))
    counts = {r.symbol: r["count"] for r in coverage.groupBy("symbol").count().collect()}
    assert counts == dict.fromkeys(symbols, 31 * 48)
