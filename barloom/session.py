"""Session and scratch folder helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

#: Shuffle files go with the job that made them, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows that lie by some of the keys of a join are not moved to lie by all of them, nor sent to every task.
IN_PLACE = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}

_local_scratch: list[tempfile.TemporaryDirectory] = []
_made: list[str] = []


def get_session(app_name: str = "barloom", **conf: str) -> SparkSession:
    """The running session, or a new one. Shuffle sizing is left to adaptive execution."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _scratch_base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        if not _local_scratch:
            _local_scratch.append(tempfile.TemporaryDirectory(prefix="barloom-"))
        base = _local_scratch[0].name
    return base.rstrip("/")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder all executors can reach, under ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it then gets a temporary folder
    that goes away with the process.
    """
    folder = f"{_scratch_base(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders made so far for this session, once nothing reads them."""
    mine = [f for f in _made if f.startswith(f"{_scratch_base(spark)}/")]
    for folder in mine:
        _delete(spark, folder)
    return len(mine)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    _made.remove(folder)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def written(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """Rows written once to a scratch folder and scanned from there, for several uses."""
    return _scan_of(spark, rows, scratch_folder(spark, name))


def _scan_of(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    with _settings(spark, {CLEANUP: "true"}):
        rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def written_in_buckets(spark: SparkSession, rows: DataFrame, name: str, buckets: int, by: dict[str, Column]) -> DataFrame:
    """The same in buckets of some columns, added where they are new: what groups by them, and by more, moves no rows.

    Rows move once to get there, after they are written as they come: the files of their own shuffles are gone by then.
    """
    passing, folder = scratch_folder(spark, name), scratch_folder(spark, name)
    table = folder.rpartition("/")[2].replace("-", "_")
    placed = _scan_of(spark, rows, passing).repartition(buckets, *by.values()).withColumns(by)
    with _settings(spark, {CLEANUP: "true"}):
        placed.write.format("parquet").bucketBy(buckets, *by).option("path", folder).saveAsTable(table)
    _delete(spark, passing)
    found = spark.table(table)
    spark.sql(f"drop table {table}")  # the name goes, the files stay
    return found


def joined_in_place(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows by a plan whose joins take their sides where they lie, as in buckets of some of their keys.

    By default Spark moves both sides to lie by all keys. It plans when rows are asked for, so the
    plan is made here, not to leave the setting with the session.
    """
    with _settings(spark, IN_PLACE):
        planned = rows._jdf.queryExecution().toRdd()
    return DataFrame(spark._jsparkSession.internalCreateDataFrame(planned, rows._jdf.schema(), False), spark)
