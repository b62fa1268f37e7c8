"""Loading folders that may not hold the asked-for partitions yet."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql.types import StructType


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def matching_folders(spark: SparkSession, base: str, patterns: Sequence[str]) -> list[str]:
    """Folders under ``base`` that one of the patterns names, each once."""
    found: dict[str, None] = {}
    for pattern in patterns:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{pattern}")
        statuses = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        for status in statuses or ():
            # a path made of its text reads back as the same folder, whatever its name holds
            found[literal_path(status.getPath().toString())] = None
    return list(found)


def literal_path(path: str) -> str:
    """A path as a pattern that matches nothing else."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def load_matching(
    spark: SparkSession, reader: DataFrameReader, fmt: str, base: str, patterns: Sequence[str] = ()
) -> DataFrame | None:
    """Load the folders of ``base`` that match a pattern, all of it without patterns.

    None if nothing matches. A missing ``base`` is an error. Only the matching folders are
    listed, so the cost follows what is asked for and not the size of the archive.
    """
    base = base.rstrip("/")
    reader = reader.format(fmt).option("basePath", base)
    if patterns:
        folders = matching_folders(spark, base, patterns)
        if folders:
            return reader.load(folders)
        if path_exists(spark, base):
            return None
    return reader.load(base)


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, sorted; none if there is no such folder."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in system.listStatus(hadoop_path)) if system.exists(hadoop_path) else []


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, made in one step."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop_path, True).close()
