"""Which scheduled runs and tickers came, failed or never came.

A run is known by the epoch second at which it was due; an instant belongs to the last run due until
then. A fetch that neither landed nor failed (a run that never started, a task that crashed) leaves
no trace of its own, so it only shows against the schedule.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

LANDED, FAILED, ABSENT, UNEXPECTED = "landed", "failed", "absent", "unexpected"
RUNS_OF_TASK = 250_000


def coverage_tasks(tickers: DataFrame, first: int, last: int, every: int, fetches: int = 0) -> int:
    """Tasks that take about ``RUNS_OF_TASK`` rows each of runs to come and of fetches.

    Tickers are counted for that, which takes a job.
    """
    runs = max(1, (last - first) // every + 1)
    symbols = tickers.agg(F.approx_count_distinct("symbol")).first()[0]
    return max(1, math.ceil((symbols * runs + fetches) / RUNS_OF_TASK))


def expected_runs(tickers: DataFrame, first: int, last: int, every: int, tasks: int | None = None) -> DataFrame:
    """A row for every ticker (each once) and every run due from ``first`` to ``last``, inclusive.

    A few bytes of tickers become very many runs, so tickers are dealt out by the number of runs to
    come, into ``tasks`` or as ``coverage_tasks`` has it: adaptive execution would put them by their bytes
    into one or two.
    """
    due = F.sequence(F.lit(first).cast("bigint"), F.lit(last).cast("bigint"), F.lit(every).cast("bigint"))
    if tasks is None:
        tasks = coverage_tasks(tickers, first, last, every)
    dealt = tickers.select("symbol").distinct().repartition(tasks, "symbol")
    return dealt.select("symbol", F.explode(due).alias("run"))


def run_of(instant: Column, first: int, every: int) -> Column:
    """The run that an epoch second belongs to."""
    return F.lit(first) + F.floor((instant - first) / every) * every


def run_coverage(expected: DataFrame, landed: DataFrame, failed: DataFrame, tasks: int | None = None) -> DataFrame:
    """``symbol``, ``run``, ``status`` and ``fetches``, from tables of (symbol, run).

    What landed counts as landed even if another attempt failed; what is not on the schedule is
    ``unexpected``. Fetches are combined before they move, then all meet by symbol, about ``RUNS_OF_TASK``
    rows a task, for which expected runs and fetches are counted first; spans and counts by symbol
    move nothing again. Rows without symbol are left out.

    Where expected runs lie by symbol in ``tasks`` already, as ``expected_runs`` with the same number deals
    them, fetches go there: nothing is counted and runs, which are far more than their tickers, never move.
    """
    def flagged(rows: DataFrame, part: str) -> DataFrame:
        flags = [F.lit(int(name == part)).cast("bigint").alias(name) for name in ("due", LANDED, FAILED)]
        return rows.where(F.col("symbol").isNotNull()).select("symbol", "run", *flags)

    def sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy("symbol", "run").agg(*[F.sum(c).alias(c) for c in ("due", LANDED, FAILED)])

    due, fetches = flagged(expected, "due"), flagged(landed, LANDED).unionByName(flagged(failed, FAILED))
    if tasks is None:
        tasks = max(1, math.ceil((due.count() + fetches.count()) / RUNS_OF_TASK))
        due = due.repartition(tasks, "symbol")
    # parts that lie alike are stacked task by task
    together = sums(due.unionByName(sums(fetches).repartition(tasks, "symbol")))
    status = F.when(F.col("due") == 0, UNEXPECTED).when(F.col(LANDED) > 0, LANDED).when(F.col(FAILED) > 0, FAILED).otherwise(ABSENT)
    return together.select("symbol", "run", status.alias("status"), (F.col(LANDED) + F.col(FAILED)).alias("fetches"))


def coverage_counts(coverage: DataFrame) -> DataFrame:
    """Runs by symbol and status, and the share of those due that landed."""
    due = F.count_if(F.col("status") != UNEXPECTED)
    return coverage.groupBy("symbol").agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in (LANDED, FAILED, ABSENT, UNEXPECTED)],
        F.when(due > 0, F.count_if(F.col("status") == LANDED) / due).alias("share"),
    )


def absences(coverage: DataFrame, every: int) -> DataFrame:
    """Unbroken spans of runs that were due and did not land: gaps and islands by symbol.

    ``first_run``, ``last_run``, ``runs``, and how many of them ``failed`` with a trace.
    """
    missing = coverage.where(F.col("status").isin(FAILED, ABSENT))
    in_time = Window.partitionBy("symbol").orderBy("run")
    # within a span, the run and its rank rise alike
    span = F.col("run") - F.row_number().over(in_time) * every
    return missing.withColumn("span", span).groupBy("symbol", "span").agg(
        F.min("run").alias("first_run"), F.max("run").alias("last_run"), F.count("*").alias("runs"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
    ).drop("span")
