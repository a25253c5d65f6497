"""Places of an epoch need no shuffle of rows."""

from pyspark.sql import functions as F

from chordgrid.operators import batching as B
from chordgrid.plans import catalog


def test_rows_of_one_shard_find_their_places_in_all_tasks(spark):
    manifest = spark.range(800).select(F.lit("f").alias("file"), F.col("id").alias("row_index")).repartition(8)
    rows = B.epoch_places(manifest, 3, 1, workers=3).select("place", F.spark_partition_id().alias("task")).collect()
    assert sorted(r["place"] for r in rows) == list(range(800)) and len({r["task"] for r in rows}) == 8


def test_permutation_as_its_rounds_say(spark):
    prime = 2_147_483_647
    scrambled = lambda x: (x * 48_271 + 11) % prime

    def plain(x: int, n: int, *seed: int) -> int:
        start = 0
        for s in seed:
            start = (start * 1_000_003 + s % prime + 12_345) % prime
        for r in range(1, B.SHUFFLE_ROUNDS + 1):
            k = scrambled(scrambled(start + r * 7_919))
            partner = (k - x) % n
            high = max(x, partner)
            x = partner if scrambled((scrambled(high + k) * 69_621 + high) % prime) // 65_536 % 2 else x
        return x

    cases = [(x, n, s, t) for n in (1, 5, 1000, prime) for x in (0, n // 2, n - 1) for s, t in ((0, 1), (-7, 10**14))]
    got = spark.createDataFrame([*cases, (None, 5, 1, 1), (3, None, 1, 1)], "x long, n long, s long, t long").coalesce(1).select(B.permuted(F.col("x"), F.col("n"), F.col("s"), F.col("t")).alias("p")).collect()
    assert [r["p"] for r in got] == [plain(*c) for c in cases] + [None, None]


def test_an_epoch_ranks_its_rows_once(spark):
    plan = catalog.QUERIES["l3_epoch_places"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "orders.parquet" not in plan and "SortMergeJoin" not in plan
