from pathlib import Path
from types import SimpleNamespace

import pytest

from pyspark.sql import functions as F

from barloom.session import CLEANUP, drop_scratch, joined_in_place, scratch_folder, written, written_in_buckets


def fake(master, folder):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: folder or default),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_is_the_shared_folder_of_the_cluster():
    first = scratch_folder(fake("yarn", "s3a://bucket/scratch/"), "bars")
    assert first.startswith("s3a://bucket/scratch/bars-")
    assert first != scratch_folder(fake("yarn", "s3a://bucket/scratch/"), "bars")


def test_only_a_local_session_may_do_without():
    assert scratch_folder(fake("local[2]", None), "bars")
    with pytest.raises(RuntimeError):
        scratch_folder(fake("spark://host:7077", None), "bars")


def test_written_rows_come_back(spark):
    rows = spark.range(10)
    back = written(spark, rows, "ids")
    assert sorted(r.id for r in back.collect()) == list(range(10))
    (folder,) = {f.rpartition("/")[0] for f in back.inputFiles()}
    assert Path(folder.removeprefix("file:")).is_dir()
    assert drop_scratch(spark) >= 1
    assert not Path(folder.removeprefix("file:")).exists()


def test_buckets_are_read_without_a_shuffle(spark):
    rows = spark.range(1000).selectExpr("id", "id % 10 as k")
    part = F.expr("if(id % 7 = 0, null, id % 3)")
    before, tables = spark.conf.get(CLEANUP), spark.catalog.listTables()
    back = written_in_buckets(spark, rows, "ids", 6, {"k": F.col("k"), "part": part})
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.withColumn("part", part).collect()))
    assert len(back.inputFiles()) <= 6 and spark.catalog.listTables() == tables and spark.conf.get(CLEANUP) == before
    counts = back.groupBy("k", "part", "id").count()
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()


def test_joins_in_place_leave_the_setting_as_it_was(spark):
    rows = spark.range(1000).selectExpr("id", "id % 10 as k")
    back = written_in_buckets(spark, rows, "ids", 6, {"k": F.col("k")})
    joined = back.groupBy("k", "id").count().join(back.groupBy("k", "id").agg({"id": "max"}), ["k", "id"])
    assert "Exchange" in joined._jdf.queryExecution().executedPlan().toString()
    before = dict(spark.sql("set").collect())
    again = joined_in_place(spark, back.groupBy("k", "id").count().join(back.groupBy("k", "id").agg({"id": "max"}), ["k", "id"]))
    assert dict(spark.sql("set").collect()) == before
    assert "ShuffledRowRDD" not in again._jdf.queryExecution().toRdd().toDebugString()
    assert again.schema == joined.schema and sorted(again.collect()) == sorted(joined.collect())
