"""Do two groups of embeddings come from one model? Norms, centroids and a verdict."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chordgrid.functions.scalars import cosine, l2_norm
from chordgrid.operators.batching import RANGES, cut_points, first_by_hash, hashed, ranked, value_range
from chordgrid.operators.frames import mean_vectors
from chordgrid.sources.folders import scratch_folder


def sample_by_group(rows: DataFrame, group: str, key: str, n: int, seed: int = 0) -> DataFrame:
    """Up to n rows of each group, the first by a hash of their key."""
    return first_by_hash(rows, [group], [key], F.lit(n), seed).where("_first").drop("_first")


def running_counts(values: DataFrame, group: str, x: str) -> DataFrame:
    """group, x, c, upto, n: each distinct value with its count, the running count and the group's size.

    Equal values are one row before anything is sorted, so a group of one value costs one row; distinct values
    are cut into ranges, and running sums go over ranges first and over the values of one range then.
    """
    counts = values.where(F.col(x).isNotNull()).groupBy(group, x).agg(F.count("*").alias("c"))
    own = counts.withColumn("_range", value_range(F.struct(x), cut_points(counts, [x], RANGES)))
    every = Window.partitionBy("_g")  # over ranges, not values
    sums = own.groupBy(F.col(group).alias("_g"), F.col("_range").alias("_r")).agg(F.sum("c").alias("_c"))
    sums = sums.withColumn("n", F.sum("_c").over(every)).withColumn("_before", F.coalesce(F.sum("_c").over(every.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    both = own.join(sums.hint("merge"), F.col(group).eqNullSafe(F.col("_g")) & (F.col("_range") == F.col("_r")))
    inner = F.sum("c").over(Window.partitionBy(group, "_range").orderBy(x).rowsBetween(Window.unboundedPreceding, 0))
    return both.select(group, x, "c", (F.col("_before") + inner).alias("upto"), "n")


def percentile_of(share: float, x: str, names: dict[str, str] | None = None) -> Column:
    """Aggregate over rows of distinct values with counts, running counts and size (c, upto, n, or as ``names`` has
    them): the exact percentile, interpolated between two order statistics; null without a value."""
    c, upto, n = (F.col((names or {}).get(k, k)) for k in ("c", "upto", "n"))
    at = F.lit(share) * (n - 1) + 1
    low = F.floor(at)
    holds = lambda r: ((upto - c < r) & (r <= upto)).cast("double")
    return F.sum(F.when(c > 0, F.col(x) * (holds(low) * (1 - (at - low)) + holds(low + 1) * (at - low))))


def percentiles(values: DataFrame, group: str, x: str, shares: dict[str, float]) -> DataFrame:
    """group and a column for each share: exact percentiles of the values that are there."""
    return running_counts(values, group, x).groupBy(group).agg(*[percentile_of(share, x).alias(name) for name, share in shares.items()])


def norm_stats(rows: DataFrame, group: str, vec: str = "vec") -> DataFrame:
    """group, n, mean, std (of the population), p5, p95 of the vectors' norms, from counts of equal norms."""
    counts = running_counts(rows.select(group, l2_norm(F.col(vec)).alias("x")), group, "x")
    mean = F.sum(F.col("x") * F.col("c")) / F.first("n")
    one = counts.groupBy(group).agg(F.first("n").alias("n"), mean.alias("mean"), percentile_of(0.05, "x").alias("p5"), percentile_of(0.95, "x").alias("p95"))
    spread = rows.groupBy(F.col(group).alias("_g")).agg(F.stddev_pop(l2_norm(F.col(vec))).alias("std"))
    return one.join(spread.hint("merge"), F.col(group).eqNullSafe(F.col("_g"))).select(group, "n", "mean", "std", "p5", "p95")


def centroid_cosine(rows: DataFrame, group: str, a, b, vec: str = "vec") -> DataFrame:
    """One row: the cosine of two groups' mean vectors, null where one has none."""
    means = mean_vectors(rows.where(F.col(group).isin(a, b)), [group], vec)
    both = means.agg(*[F.max(F.when(F.col(group) == g, F.col(vec))).alias(name) for g, name in ((a, "va"), (b, "vb"))])
    return both.select(cosine(F.col("va"), F.col("vb")).alias("cosine"))


def ks_columns(na: Column, nb: Column, d: Column) -> Column:
    """The asymptotic p of a two-sample statistic; null where a sample is empty."""
    n = F.nullif(F.sqrt(na * nb / F.nullif(na + nb, F.lit(0))), F.lit(0.0))
    t = (n + 0.12 + 0.11 / n) * d
    series = sum((F.lit(2.0 * (-1) ** (k - 1)) * F.exp(-2.0 * k * k * t * t) for k in range(1, 20)), F.lit(0.0))
    return F.when(t.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def running_pairs(values: DataFrame, group: str, x: str, a, b) -> DataFrame:
    """x, ca, cb, ra, rb, na, nb: distinct values with both samples' counts, running counts and sizes."""
    counts = values.groupBy(x).agg(F.count_if(F.col(group) == a).alias("ca"), F.count_if(F.col(group) == b).alias("cb")).where(F.col(x).isNotNull() & (F.col("ca") + F.col("cb") > 0))
    counts = counts.withColumn("_range", value_range(F.struct(x), cut_points(counts, [x], RANGES)))
    every = Window.partitionBy(F.lit(1))  # over ranges, not values
    before = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy("_range").agg(F.sum("ca").alias("sa"), F.sum("cb").alias("sb"))
    sums = sums.select(F.col("_range").alias("_r"), *[F.sum(f"s{c}").over(every).alias(f"n{c}") for c in "ab"], *[F.coalesce(F.sum(f"s{c}").over(before), F.lit(0)).alias(f"_b{c}") for c in "ab"])
    upto = Window.partitionBy("_range").orderBy(x).rowsBetween(Window.unboundedPreceding, 0)
    both = counts.join(sums.hint("merge"), F.col("_range") == F.col("_r"))
    return both.select(x, "ca", "cb", *[(F.col(f"_b{c}") + F.sum(f"c{c}").over(upto)).alias(f"r{c}") for c in "ab"], "na", "nb")


def _gap() -> Column:
    return F.abs(F.col("ra") / F.nullif(F.col("na"), F.lit(0)) - F.col("rb") / F.nullif(F.col("nb"), F.lit(0)))


def ks_statistic(values: DataFrame, group: str, x: str, a, b) -> DataFrame:
    """One row: n_a, n_b, d (largest gap of the two samples' cumulative shares) and its asymptotic p. Ties are one
    row each; a task holds a range of values."""
    rows = running_pairs(values, group, x, a, b)
    one = rows.groupBy("na", "nb").agg(F.max(_gap()).alias("d"))
    return one.select(F.col("na").alias("n_a"), F.col("nb").alias("n_b"), "d", ks_columns(F.col("na"), F.col("nb"), F.col("d")).alias("p"))


def verdict(cos: Column, shift: Column, p: Column) -> Column:
    """compatible / probably compatible / incompatible / doubtful from the centroids' cosine, the distance of
    the mean norms, and the p of the norms' test (null where none was made): incompatible takes two signals
    of three."""
    signals = (cos < 0.85).cast("int") + (shift > 2.0).cast("int") + F.coalesce((p < 0.001) & (cos < 0.92), F.lit(False)).cast("int")
    return (
        F.when((cos >= 0.97) & (shift < 0.5), "compatible").when((cos >= 0.90) & (shift < 1.5), "probably compatible")
        .when(signals >= 2, "incompatible").otherwise("doubtful"))


def random_pairs(rows: DataFrame, group: str, key: str, a, b, n: int, vec: str = "vec", seed: int = 0) -> DataFrame:
    """rank, key_a, key_b, cosine of up to n random pairs across two groups, no row twice: rows of equal rank by a hash.
    Cuts and ranks go by ranges of hashes, so no task holds n rows."""
    def side(g, name: str, salt: int) -> DataFrame:
        own = rows.where(F.col(group) == g).select(F.col(key).alias("key"), F.col(vec).alias("vec"), hashed(seed + salt, key).alias("_h"))
        own = first_by_hash(own, [], ["key"], F.lit(n), seed + salt).where("_first").drop("_first")
        return ranked(own, [], ["_h", "key"]).select("rank", F.col("key").alias(f"key_{name}"), F.col("vec").alias(f"v{name}"))

    both = side(a, "a", 1).join(side(b, "b", 2).hint("merge"), "rank")
    return both.select("rank", "key_a", "key_b", cosine(F.col("va"), F.col("vb")).alias("cosine"))


def embedding_drift(rows: DataFrame, cutoff, n: int, day: str = "day", key: str = "key", vec: str = "vec", dim: int | None = None, instrument: str | None = None, seed: int = 0) -> DataFrame:
    """One row that compares the vectors of the days before ``cutoff`` (old) with the others (new): sizes, norms,
    the centroids' cosine, the mean cosine of random pairs, the norms' test and a verdict.

    Up to n vectors of each side count, the first by a hash of their key. Null, empty and wrong-sized ones
    are passed over; ``instrument`` keeps one instrument's rows.
    """
    own = rows.where(F.col("instrument") == instrument) if instrument else rows
    fits = F.size(vec) > 0 if dim is None else F.size(vec) == dim
    own = own.where(fits).select(F.col(key).alias("key"), F.col(vec).alias("vec"), F.when(F.col(day) < F.lit(cutoff), "old").otherwise("new").alias("side"))
    # the sample is written once; what follows are aggregates of it, one row each, that meet in a union
    folder = scratch_folder(rows.sparkSession)
    sample_by_group(own, "side", "key", n, seed).withColumn("x", l2_norm(F.col("vec"))).write.parquet(f"{folder}/sample")
    some = rows.sparkSession.read.parquet(f"{folder}/sample")
    of = {side: F.col("side") == side for side in ("old", "new")}
    sums = some.agg(*[f(F.when(is_, F.col("x"))).alias(f"{side}_{name}") for side, is_ in of.items() for name, f in (("n", F.count), ("mean", F.avg), ("std", F.stddev_pop))])
    counts = running_pairs(some, "side", "x", "old", "new")
    shares = []
    for side, c in (("old", "a"), ("new", "b")):
        own_counts = {"c": f"c{c}", "upto": f"r{c}", "n": f"n{c}"}
        for name, share in (("p5", 0.05), ("p95", 0.95)):
            shares.append(percentile_of(share, "x", own_counts).alias(f"{side}_{name}"))
    tests = counts.agg(*shares, F.max(_gap()).alias("d"), F.max("na").alias("_na"), F.max("nb").alias("_nb"))
    tests = tests.withColumn("p", ks_columns(F.col("_na"), F.col("_nb"), F.col("d"))).drop("_na", "_nb")
    pairs = random_pairs(some, "side", "key", "old", "new", n, "vec", seed).agg(F.avg("cosine").alias("pair_cosine"))
    parts = sums
    for part in (centroid_cosine(some, "side", "old", "new"), pairs, tests):
        parts = parts.unionByName(part, allowMissingColumns=True)
    out = parts.agg(*[F.max(c).alias(c) for c in parts.columns])
    shift = F.abs(F.col("old_mean") - F.col("new_mean"))
    names = [f"{side}_{name}" for side in of for name in ("n", "mean", "std", "p5", "p95")]
    out = out.select(*names, "cosine", "pair_cosine", "d", "p")
    return out.withColumn("shift", shift).withColumn("verdict", verdict(F.col("cosine"), F.col("shift"), F.col("p")))
