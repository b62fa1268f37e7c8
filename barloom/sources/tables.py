"""Bars as catalog tables and SQL table functions, for those who query them by SQL."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from barloom.schema import BAR, BAR_COLUMNS, DATED_BAR, DATED_PARTITIONS

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def _quoted(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not the name of a table or function: {name!r}")
    return ".".join(f"`{part}`" for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_bar_table(spark: SparkSession, name: str, path: str, replace: bool = False) -> int:
    """An external table over bars by width and date; the number of partitions it found.

    The catalog knows the partitions, so a query that names a width or dates lists nothing else.
    After later writes call ``sync_bar_table``. ``replace`` drops a table of the same name, never its files.
    """
    table = _quoted(name)
    if replace:
        spark.sql(f"drop table if exists {table}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in DATED_BAR.fields)
    spark.sql(
        f"create table {table} ({columns}) using parquet partitioned by ({', '.join(DATED_PARTITIONS)}) location {_text(path)}"
    )
    return sync_bar_table(spark, name)


def sync_bar_table(spark: SparkSession, name: str) -> int:
    """Register partitions that were written since, and forget those whose folders are gone."""
    spark.sql(f"msck repair table {_quoted(name)} sync partitions")
    spark.sql(f"refresh table {_quoted(name)}")
    return spark.sql(f"show partitions {_quoted(name)}").count()


_DATE_STRINGS = "substring(date, 1, 4) as year, substring(date, 6, 2) as month, substring(date, 9, 2) as day"
_COLUMNS = ", ".join(_DATE_STRINGS if c == "year" else c for c in BAR_COLUMNS if c not in ("month", "day"))


def create_bar_functions(spark: SparkSession, table: str, prefix: str = "bars") -> list[str]:
    """Temporary SQL table functions over a table of ``create_bar_table``; their names.

    ``<prefix>_between(width, first, last)`` gives the bars of a width on local dates, inclusive, and
    ``<prefix>_of(symbol, width, first, last)`` those of one symbol. They are plain SQL, so their
    arguments prune partitions and reach the scan.
    """
    returns = ", ".join(f"`{c}` {BAR[c].dataType.simpleString()}" for c in BAR_COLUMNS)
    span = "timeframe = width and date between cast(first as string) and cast(last as string)"
    made = {
        f"{prefix}_between": ("width string, first date, last date", span),
        f"{prefix}_of": ("of_symbol string, width string, first date, last date", f"symbol = of_symbol and {span}"),
    }
    for name, (arguments, condition) in made.items():
        spark.sql(
            f"create or replace temporary function {_quoted(name)}({arguments}) returns table ({returns}) "
            f"return select {_COLUMNS} from {_quoted(table)} where {condition}"
        )
    return list(made)
