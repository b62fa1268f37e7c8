"""Intermediate tables in the folder that the cluster shares, and their removal."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from barloom.session import scratch_folder


#: Shuffle files go with the step that made them, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written once under ``spark.checkpoint.dir`` and read from there."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folders: dict[str, list[str]] = {}
        self.tables: dict[str, list[str]] = {}

    @contextmanager
    def _freed(self) -> Iterator[None]:
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            yield
        finally:
            self.spark.conf.set(CLEANUP, before)

    def keep(self, rows: DataFrame, name: str) -> DataFrame:
        """Write rows and scan what was written; this cuts their lineage."""
        folder = scratch_folder(self.spark, name)
        with self._freed():
            rows.write.parquet(folder)
        self.folders.setdefault(name, []).append(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    def keep_in_buckets(self, rows: DataFrame, name: str, by: str) -> DataFrame:
        """The same, in as many buckets of a column as a shuffle has partitions: joins by it do not move the table again."""
        folder = scratch_folder(self.spark, name)
        own = folder.rpartition("/")[2].replace("-", "_")
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        with self._freed():
            rows.write.format("parquet").bucketBy(buckets, by).sortBy(by).option("path", folder).saveAsTable(own)
        self.folders.setdefault(name, []).append(folder)
        self.tables.setdefault(name, []).append(own)
        return self.spark.table(own)

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more, all that were kept under a name."""
        for name in names:
            for own in self.tables.pop(name, []):
                self.spark.sql(f"drop table if exists {own}")
            for folder in self.folders.pop(name, []):
                path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
