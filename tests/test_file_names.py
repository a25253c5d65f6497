"""Names of files on every row: found without a pattern that tries each letter of the path."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chordgrid.plans import catalog, io_queries as IO
from chordgrid.streaming import streams as ST

DIR = "/root/testdata/sf0.001"


def test_names_of_odd_paths(spark):
    rows = spark.createDataFrame([("file:/a/b c/x=1.parquet",), ("a/",), ("a",), ("",), (None,)], "p string")
    assert [r[0] for r in rows.select(IO.name_of("p")).collect()] == ["x=1.parquet", "", "a", "", None]


@pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")
def test_shuffle_buffer_reads_names_without_patterns(spark, monkeypatch):
    plans, run = [], ST.shuffled_batches

    def seen(stream, *args, **options):
        plans.append(stream._jdf.queryExecution().toString())
        return run(stream, *args, **options)

    monkeypatch.setattr(ST, "shuffled_batches", seen)
    rows = catalog.QUERIES["r3_shuffle_buffer"](spark, DIR)
    assert len(plans) == 1 and "regexp" not in plans[0]
    assert rows.where(F.col("mixed")).count() == rows.count() == spark.read.parquet(f"{DIR}/orders.parquet").count()
