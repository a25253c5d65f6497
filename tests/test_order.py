"""Epoch order by position, and the shuffle buffer of a stream."""

import random

import pytest
from pyspark.sql import functions as F

from chordgrid.operators import batching as B
from chordgrid.streaming import streams as ST


def test_every_n_has_a_permutation(spark):
    for n in (1, 2, 3, 7, 64, 1000):
        rows = spark.range(n).select("id", *[B.permuted(F.col("id"), F.lit(n), F.lit(s)).alias(f"s{s}") for s in (1, 2)]).collect()
        for s in ("s1", "s2"):
            assert sorted(r[s] for r in rows) == list(range(n))
        if n == 1000:
            assert sum(r["s1"] == r["s2"] for r in rows) < 20 and sum(r["s1"] == r["id"] for r in rows) < 20
            # neighbours do not stay together
            at = [r["s1"] for r in sorted(rows, key=lambda r: r["id"])]
            assert sum(abs(a - b) < 10 for a, b in zip(at, at[1:])) < 60


def test_epoch_keeps_shards_together_and_workers_even(spark):
    rng = random.Random(4)
    rows = [(f"f{k}", i) for k in range(9) for i in range(rng.choice([1, 5, 40]))]
    manifest = spark.createDataFrame(rows, "file string, row_index long").repartition(4)
    orders = []
    for epoch in (0, 1):
        found = sorted((r["place"], r["file"], r["row_index"], r["worker"]) for r in B.epoch_places(manifest, 3, epoch, workers=4).collect())
        assert [x[0] for x in found] == list(range(len(rows))) and sorted(x[1:3] for x in found) == sorted(rows)
        files = [x[1] for x in found]
        assert sum(a != b for a, b in zip(files, files[1:])) == 8  # whole shards, one after the other
        per = [sum(x[3] == w for x in found) for w in range(4)]
        assert max(per) - min(per) <= 1 and [x[3] for x in found] == sorted(x[3] for x in found)
        orders.append([x[1:3] for x in found])
    assert orders[0] != orders[1]


@pytest.mark.parametrize("stop", [None, 2])
def test_a_shuffle_buffer_loses_nothing(spark, tmp_path, monkeypatch, stop):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    for k in range(5):
        spark.range(100 * k, 100 * k + 100, 1, 1).write.mode("append").parquet(src)
    run = lambda: ST.shuffled_batches(ST.shard_stream(spark, src, spark.range(1).schema, files_per_batch=1), ["id"], out, check, seed=1, buffer_rows=120)
    if stop:
        real, calls = ST.run_available, []

        def failing(stream, write, checkpoint):
            def once(rows, batch):
                write(rows, batch)
                if batch == stop and not calls:
                    calls.append(batch)
                    raise RuntimeError("killed after its tables were written")

            return real(stream, once, checkpoint)

        monkeypatch.setattr(ST, "run_available", failing)
        with pytest.raises(Exception):
            run().awaitTermination()
        monkeypatch.setattr(ST, "run_available", real)
    run().awaitTermination()
    gone = spark.read.parquet(out)
    held = ST.drained(spark, out, ["id"], 1)
    assert sorted(r["id"] for r in gone.select("id").union(held).collect()) == list(range(500))
    assert 60 < held.count() < 200
    # rows of one file leave in several batches
    assert gone.groupBy(F.floor(F.col("id") / 100)).agg(F.countDistinct("batch").alias("n")).where("n > 1").count() >= 3
