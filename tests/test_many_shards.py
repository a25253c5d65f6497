"""Named shards, many and small, are written by tasks of a number of their own, and the driver lists names only."""

import pytest
from pyspark.sql import functions as F

from chordgrid.operators import dataset as D
from chordgrid.sources import datasets as DS
from chordgrid.sources.folders import Folder


@pytest.fixture()
def rows(spark):
    names = F.concat(F.lit("train-"), F.lpad(F.col("shard").cast("string"), 5, "0"), F.lit(".parquet"))
    return spark.range(600).select("id", (F.col("id") % 60).cast("int").alias("shard"), F.array(F.lit("é"), F.lit(None)).alias("list")).withColumn("shard_name", names)


def test_shards_are_the_work_of_many_tasks(spark, rows, tmp_path):
    """By their bytes all rows would meet in one task."""
    D.write_shards(rows, f"{tmp_path}/x", partition=None)
    files = list(tmp_path.glob("x/shard_name=train-*.parquet/part-*.parquet"))
    assert len(files) == 60 and len({f.name for f in files}) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/x").select(*rows.columns).collect())) == sorted(map(tuple, rows.collect()))
    assert not [p.name for p in tmp_path.glob("x/*") if p.name.startswith("_staged")]


def test_next_number_is_found_without_a_job(spark, rows, tmp_path):
    D.write_shards(rows, f"{tmp_path}/x", partition=None)
    (tmp_path / "x" / "_staged-y" / "shard_name=train-00900.parquet").mkdir(parents=True)
    (tmp_path / "x" / "deep" / "er").mkdir(parents=True)
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert D.next_shard(spark, f"{tmp_path}/x") == 60
    (tmp_path / "x" / "deep" / "er" / "train-00070.parquet").write_text("")
    assert D.next_shard(spark, f"{tmp_path}/x") == 71 and D.next_shard(spark, f"{tmp_path}/x", "test") == 0
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


@pytest.mark.parametrize("mode", ["append", "overwrite", "ignore", "errorifexists"])
def test_modes(spark, rows, tmp_path, mode):
    D.write_shards(rows.where("shard < 2"), f"{tmp_path}/x", partition=None)
    more = rows.where("shard = 1 or shard = 5")
    if mode == "errorifexists":
        with pytest.raises(Exception):
            D.write_shards(more, f"{tmp_path}/x", mode=mode, partition=None)
    else:
        D.write_shards(more, f"{tmp_path}/x", mode=mode, partition=None)
    got = {r["shard"]: r["count"] for r in spark.read.parquet(f"{tmp_path}/x").groupBy("shard").count().collect()}
    assert got == {"append": {0: 10, 1: 20, 5: 10}, "overwrite": {1: 10, 5: 10}}.get(mode, {0: 10, 1: 10})


def test_folders_are_named_as_by_spark(spark, rows, tmp_path):
    odd = F.element_at(F.array(F.lit("a/b: c=%{}[^]"), F.lit("é'\"?"), F.lit(None), F.lit("x")), (F.col("id") % 4 + 1).cast("int"))
    rows = rows.where("shard < 8").withColumn("split", odd)
    D.write_shards(rows, f"{tmp_path}/x")
    rows.write.partitionBy("split", "shard_name").parquet(f"{tmp_path}/y")
    found = lambda r: sorted({str(p.parent.relative_to(tmp_path / r)) for p in (tmp_path / r).rglob("part-*.parquet")})
    assert found("x") == found("y")
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/x").select(*rows.columns).collect())) == sorted(map(str, rows.collect()))


def test_a_write_that_fails_leaves_nothing(spark, rows, tmp_path):
    D.write_shards(rows.where("shard < 2"), f"{tmp_path}/x", partition=None)
    bad = rows.where("shard >= 2").withColumn("id", F.when(F.col("id") == 599, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="broken"):
        D.write_shards(bad, f"{tmp_path}/x", mode="append", partition=None)
    assert D.next_shard(spark, f"{tmp_path}/x") == 2 and spark.read.parquet(f"{tmp_path}/x").count() == 20


def test_no_rows(spark, rows, tmp_path):
    D.write_shards(rows.limit(0), f"{tmp_path}/x", partition=None)
    assert D.next_shard(spark, f"{tmp_path}/x") == 0 and (tmp_path / "x").is_dir()


def test_shards_are_read_without_partitions(spark, rows, tmp_path, monkeypatch):
    """Spark resolves partitions in time that grows with their square; and no name comes to the driver one by one."""
    def refused(*_):
        raise AssertionError("the driver asks for each name")

    monkeypatch.setattr(Folder, "names", refused)
    more = rows.withColumn("shard", F.col("shard") + 60).withColumn("shard_name", F.concat(F.lit("train-000"), F.col("shard"), F.lit(".parquet")))
    for turn in (rows, more.where("shard < 100")):
        D.write_shards(turn, f"{tmp_path}/x", mode="append", partition=None)
    back = DS.read_named_shards(spark, f"{tmp_path}/x", rows.drop("shard_name").schema)
    want = rows.union(more.where("shard < 100"))
    assert sorted(map(tuple, back.select(*rows.columns).collect())) == sorted(map(tuple, want.collect()))
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == "10000"
