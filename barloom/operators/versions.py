"""Versions of candles over time, and bars as they were known at an instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from barloom.operators.candles import dedup_latest
from barloom.schema import CANDLE_KEY, CANDLE_VERSION


def candle_versions(
    rows: DataFrame, keys: Sequence[str] = CANDLE_KEY, versions: Sequence[str] = CANDLE_VERSION
) -> DataFrame:
    """Every version of a candle with the interval in which it was the newest.

    ``valid_from`` (inclusive) is the first of ``versions`` and ``valid_to`` (exclusive) the next one
    of the same candle, null for the newest. Of copies of one version the one that ``dedup_latest``
    would keep stays. A version without an instant counts as known from the beginning.
    """
    at, *rest = versions
    single = dedup_latest(rows, (*keys, at), rest or [at])
    in_time = Window.partitionBy(*keys).orderBy(F.asc_nulls_first(at))
    return single.withColumns({"valid_from": F.col(at), "valid_to": F.lead(at).over(in_time)})


def _known(instant: Column) -> Column:
    begun = F.col("valid_from").isNull() | (F.col("valid_from") <= instant)
    return begun & (F.col("valid_to").isNull() | (F.col("valid_to") > instant))


def as_of(versions: DataFrame, instant: str) -> DataFrame:
    """The candles as they were known at an instant, in the form of the versions' own: a filter."""
    return versions.where(_known(F.lit(instant))).drop("valid_from", "valid_to")


def as_of_each(versions: DataFrame, instants: Sequence[str]) -> DataFrame:
    """The candles at several instants, named by ``as_of``, from one pass over the versions."""
    each = versions.withColumn("as_of", F.explode(F.array(*[F.lit(i) for i in instants]).cast("array<string>")))
    return each.where(_known(F.col("as_of"))).drop("valid_from", "valid_to")


def changes_between(versions: DataFrame, after: str, until: str) -> DataFrame:
    """Versions that became the newest after one instant and are so at a later one."""
    return as_of(versions.where(F.col("valid_from") > after), until)
