"""Tables about fetch runs: summaries, metrics and dead letters.

An outcome row is ``(symbol, ok, attempts, http_status, error, gave_up)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barloom.schema import METRICS, REQUEST


def is_success() -> Column:
    """Only a true ``ok`` is a success; null is not."""
    return F.coalesce(F.col("ok"), F.lit(False))


def is_dead_letter() -> Column:
    """Failures that gave up on a symbol, as the outcome itself says, however they are worded.

    No credentials or a crashed task leaves no letter.
    """
    gave_up = F.coalesce(F.col("gave_up"), F.lit(False))
    return ~is_success() & F.col("symbol").isNotNull() & gave_up


def successes(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(is_success())


def failures(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(~is_success())


def run_summary(outcomes: DataFrame, tickers: DataFrame) -> DataFrame:
    """One row: successes, failures and the size of the ticker universe."""
    no, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    results = outcomes.select(
        F.when(is_success(), 1).otherwise(0).cast("bigint").alias("success"),
        F.when(is_success(), 0).otherwise(1).cast("bigint").alias("failed"),
        no.alias("total"),
    )
    universe = tickers.select(no.alias("success"), no.alias("failed"), one.alias("total"))
    sums = [F.coalesce(F.sum(c), no).alias(c) for c in ("success", "failed", "total")]
    return results.unionByName(universe).agg(*sums)


def symbol_counts(outcomes: DataFrame) -> DataFrame:
    """Successes, failures and dead letters per symbol."""
    return outcomes.groupBy("symbol").agg(
        F.count_if(is_success()).alias("success"),
        F.count_if(~is_success()).alias("failed"),
        F.count_if(is_dead_letter()).alias("dead_letters"),
    )


def failure_reasons(outcomes: DataFrame) -> DataFrame:
    """Failures by error text, with the highest number of attempts."""
    return failures(outcomes).groupBy("error").agg(
        F.count(F.lit(1)).alias("failures"), F.max("attempts").alias("max_attempts")
    )


def _metric_rows(values: dict[str, Column]) -> Column:
    return F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric"), value.alias("value"))
        for name, value in values.items()
    ]))


def run_metrics(outcomes: DataFrame, tickers: DataFrame) -> DataFrame:
    """Counts as (metric, symbol, value) rows: per symbol, and per run with a null symbol.

    As a monitor would get them: a symbol's failure counts where it left a dead letter.
    """
    symbol_success, symbol_failed, *run = METRICS
    # the totals come with the counts per symbol, from one scan
    counts = outcomes.rollup("symbol").agg(
        F.grouping("symbol").alias("is_total"),
        F.count_if(is_success()).alias("success"),
        F.count_if(~is_success()).alias("failed"),
        F.count_if(is_dead_letter()).alias("dead_letters"),
    )
    symbol = {symbol_success: F.col("success"), symbol_failed: F.col("dead_letters")}
    total = dict(zip(run, map(F.col, ("success", "failed"))))
    found = counts.select(
        F.when(F.col("is_total") == 0, F.col("symbol")).alias("symbol"), "is_total",
        _metric_rows(symbol | total),
    )
    of_run = F.col("metric").isin(*run)
    found = found.where(
        ((F.col("is_total") == 0) & ~of_run & (F.col("value") > 0)) | ((F.col("is_total") == 1) & of_run)
    ).select("metric", "symbol", "value")
    # with zeros, so that a run without outcomes has its totals too
    universe = tickers.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(None).cast("string").alias("symbol"),
        _metric_rows(dict(zip(run, (F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.col("n"))))),
    ).select("metric", "symbol", "value")
    return found.unionByName(universe).groupBy("metric", "symbol").agg(F.sum("value").alias("value"))


def dead_letters(outcomes: DataFrame, failed_at: Column, range_date: Column) -> DataFrame:
    """Letters for the failures that gave up, with the request that was sent."""
    return outcomes.where(is_dead_letter()).select(
        "symbol",
        failed_at.alias("failed_at"),
        F.col("attempts").cast("bigint").alias("attempts"),
        F.col("error").alias("note"),
        F.struct(
            F.col("symbol"),
            F.lit(REQUEST["resolution"]).alias("resolution"),
            F.lit(REQUEST["date_format"]).alias("date_format"),
            range_date.alias("range_from"),
            range_date.alias("range_to"),
            F.lit(REQUEST["cont_flag"]).alias("cont_flag"),
        ).alias("params_sent"),
    )
