"""Splits, samples, shuffles and padded batches for training."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.functions.scalars import BEAT

STRATA = ["guitar", "bass", "drums"]


#: Hash buckets of a group: only the bucket that holds the cut is ranked row by row.
BUCKETS = 4096
#: Ranges of values that a group is ranked in.
RANGES = 64
#: Rows that choose where a range is cut.
CUT_SAMPLE = 100


def hashed(seed: int, *key: str) -> Column:
    """A number of 60 bits that seed and key decide, from their md5 (null keys count as empty)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def first_by_hash(rows: DataFrame, group: list[str], key: list[str], quota: Column, seed: int = 0) -> DataFrame:
    """rows with ``_first``: is the row among its group's first ``quota`` by a hash of its key? ``quota`` may
    use ``_n``, the group's size.

    Rows are counted by (group, hash bucket); running sums over the buckets tell which of them lie before
    the cut. A bucket is small however large its group is, so no group is ranked in one task.
    """
    own = rows.withColumn("_h", hashed(seed, *key)).withColumn("_b", F.shiftright("_h", 48))
    sizes = own.groupBy(*group, "_b").agg(F.count("*").alias("_c"))
    every = Window.partitionBy(*(group or [F.lit(1)]))  # over buckets, not rows
    sizes = sizes.withColumn("_n", F.sum("_c").over(every)).withColumn("_before", F.coalesce(F.sum("_c").over(every.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    plan = sizes.select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_b").alias("_pb"), (quota - F.col("_before")).alias("_need"))
    same = own["_b"] == plan["_pb"]
    for i, g in enumerate(group):
        same &= own[g].eqNullSafe(plan[f"_g{i}"])
    rank = F.row_number().over(Window.partitionBy(*group, "_b").orderBy("_h", *key))
    ranked = own.join(plan.hint("merge"), same).withColumn("_first", rank <= F.col("_need"))
    return ranked.select(*rows.columns, "_first")


def value_range(column: Column, cuts: list) -> Column:
    """How many of the sorted cuts are at most the column's value: a tree of comparisons."""
    def below(a: int, b: int) -> Column:
        if a == b:
            return F.lit(a)
        middle = (a + b) // 2
        return F.when(column < cuts[middle], below(a, middle)).otherwise(below(middle + 1, b))

    return below(0, len(cuts))


def _constant(x, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType) and x is not None:
        return F.struct(*[_constant(v, f.dataType).alias(f.name) for v, f in zip(x, kind)])
    return F.lit(x).cast(kind)


def _nulls_first(x):
    """A value as Spark orders it: nulls, also in structs, before all others."""
    return (x is not None, tuple(map(_nulls_first, x)) if isinstance(x, tuple) else x)


def cut_points(rows: DataFrame, order: list[str], ranges: int) -> list[Column]:
    """Values of the whole order key, as structs, that cut rows into about ``ranges`` even parts. Keys come from
    ``CUT_SAMPLE`` rows for each range, the first by a hash; where rows are cut decides no result."""
    key = [F.col(c) for c in order]
    some = rows.select(*order).orderBy(F.xxhash64(*key), *key).limit(ranges * CUT_SAMPLE).collect()
    kinds = {c: rows.schema[c].dataType for c in order}
    some = sorted(map(tuple, some), key=_nulls_first)
    found = [some[len(some) * i // ranges] for i in range(1, ranges)] if len(some) >= ranges else some
    return [F.struct(*[_constant(x, kinds[c]).alias(c) for c, x in zip(order, r)]) for r in dict.fromkeys(found)]


def ranked(rows: DataFrame, by: list[str], order: list[str], ranges: int = RANGES) -> DataFrame:
    """rows with ``rank`` (from 1, by ``order``) and ``n`` in their group, as row_number() and count() give them.

    Cuts on the whole order key deal all rows to ranges; ranges are counted by group, and rows are numbered
    within their range, so a group is sorted in as many tasks as it has ranges, however many rows tie in
    the first columns. Columns of the order are of types that compare in Spark as in Python (no NaN).
    """
    own = rows.withColumn("_range", value_range(F.struct(*order), cut_points(rows, order, ranges)))
    every = Window.partitionBy(*[f"_g{i}" for i in range(len(by))]) if by else Window.partitionBy(F.lit(1))  # ranges, not rows
    sizes = own.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(by)], F.col("_range").alias("_r")).agg(F.count("*").alias("_c"))
    sizes = sizes.withColumn("n", F.sum("_c").over(every)).withColumn("_before", F.coalesce(F.sum("_c").over(every.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    same = F.col("_range") == F.col("_r")
    for i, g in enumerate(by):
        same &= F.col(g).eqNullSafe(F.col(f"_g{i}"))
    place = F.row_number().over(Window.partitionBy(*by, "_range").orderBy(*order))
    return own.join(sizes.hint("merge"), same).withColumn("rank", F.col("_before") + place).select(*rows.columns, "rank", "n")


def stratified_split(rows: DataFrame, key: list[str], stratum: str = "instrument", share: float = 0.2, seed: int = 42, strata: list[str] = STRATA) -> DataFrame:
    """rows with ``split``: of each stratum the first share by hash is test, a group of one is train; rows
    of no stratum go."""
    own = rows.where(F.col(stratum).isin(*strata))
    quota = F.when(F.col("_n") > 1, F.ceil(F.col("_n") * share)).otherwise(0)
    return first_by_hash(own, [stratum], key, quota, seed).withColumn("split", F.when(F.col("_first"), "test").otherwise("train")).drop("_first")


def hold_out_shards(rows: DataFrame, shard: str, n: int, seed: int = 42) -> DataFrame:
    """rows with ``split``: n whole shards are validation."""
    shards = rows.select(shard).distinct()
    rank = F.row_number().over(Window.orderBy(hashed(seed, shard), shard))  # over shards, not rows
    return rows.join(shards.withColumn("split", F.when(rank <= n, "validation").otherwise("train")).hint("merge"), shard)


def equal_sample(rows: DataFrame, stratum: str, total: int, key: list[str], seed: int = 0) -> DataFrame:
    """total // strata rows of each stratum, or all it has."""
    strata = rows.select(stratum).distinct().count()
    return first_by_hash(rows, [stratum], key, F.lit(total // max(strata, 1)), seed).where("_first").drop("_first")


def shuffled(rows: DataFrame, key: list[str], seed: int, epoch: int = 0, shard: str | None = None) -> DataFrame:
    """Rows in an order that seed and epoch decide; with a shard column whole shards stay together."""
    turn = seed * 1_000_003 + epoch
    return rows.orderBy(*([hashed(turn, shard), shard] if shard else []), hashed(turn, *key), *key)


#: Rounds of a permutation; each swaps about half of all places with a partner.
SHUFFLE_ROUNDS = 40
_PRIME = 2_147_483_647


def permuted(place: Column, n: Column, *seed: Column) -> Column:
    """Where a place 0 .. n - 1 goes in a permutation of n places that the seeds decide, n below 2**31.

    Swap-or-not: each round pairs x with (k - x) mod n and exchanges the two or not by a bit of the larger one,
    so every n has an exact permutation and a place is computed alone, without a sort. Rounds run over batches of
    rows in numpy: as a lambda of columns they took a hundred times as long.
    """
    start = F.lit(0).cast("long")
    for x in seed:
        start = (start * 1_000_003 + F.pmod(x.cast("long"), F.lit(_PRIME)) + 12_345) % _PRIME
    return _swapped(place.cast("long"), n.cast("long"), start)


@F.pandas_udf(T.LongType())
def _swapped(place: pd.Series, n: pd.Series, start: pd.Series) -> pd.Series:
    """The rounds of :func:`permuted` for a batch of rows at once; all numbers stay below 2**53."""
    known = (place.notna() & n.notna() & start.notna()).to_numpy()
    x, n, start = (c.to_numpy()[known].astype(np.int64) for c in (place, n, start))
    for r in range(1, SHUFFLE_ROUNDS + 1):
        k = _scrambled(_scrambled(start + r * 7_919))
        partner = (k - x) % n
        high = np.maximum(x, partner)
        mixed = _scrambled((_scrambled(high + k) * 69_621 + high) % _PRIME)
        x = np.where(mixed >> 16 & 1 == 1, partner, x)
    out = pd.Series(pd.NA, index=place.index, dtype="Int64")
    out[known] = x
    return out


def _scrambled(x: np.ndarray) -> np.ndarray:
    return (x * 48_271 + 11) % _PRIME


def epoch_places(manifest: DataFrame, seed: int, epoch: int = 0, workers: int = 1) -> DataFrame:
    """manifest (file, row_index) with ``place`` in the epoch's order and ``worker``: shards in a permuted order, one after
    the other, each with its rows permuted; workers take equal runs of the order, the first ones one row more.

    Sizes of shards (one row each) are all that is gathered, in one task and then for every task; rows stay where they
    are, however few shards there are, and every row computes its place, so a worker can list its own rows of any
    epoch without sorting the others.
    """
    turn = F.lit(seed * 1_000_003 + epoch)
    sizes = manifest.groupBy("file").agg(F.count("*").alias("_n"))
    every = Window.orderBy("file")  # over shards, not rows
    numbered = sizes.select("file", "_n", (F.row_number().over(every) - 1).cast("long").alias("_no"), F.count("*").over(Window.partitionBy()).alias("_shards"), F.sum("_n").over(Window.partitionBy()).alias("_all"))
    numbered = numbered.withColumn("_turn", permuted(F.col("_no"), F.col("_shards"), turn))
    before = Window.orderBy("_turn").rowsBetween(Window.unboundedPreceding, -1)
    plan = numbered.select(F.col("file").alias("_file"), "_n", "_no", "_all", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = manifest.join(F.broadcast(plan), F.col("file") == F.col("_file"))
    place = F.col("_before") + permuted(F.col("row_index"), F.col("_n"), turn, F.col("_no") + 1)
    # the first (all mod workers) workers have one row more
    size, more = F.floor(F.col("_all") / workers), F.col("_all") % workers
    large = more * (size + 1)
    worker = F.when(F.col("place") < large, F.floor(F.col("place") / (size + 1))).otherwise(more + F.floor((F.col("place") - large) / F.nullif(size, F.lit(0))))
    return rows.withColumn("place", place).withColumn("worker", worker).select(*manifest.columns, "place", "worker")


def first_occurrence(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """One row of each key: the first by order."""
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where("_rn = 1").drop("_rn")


def sane(rows: DataFrame, max_std: float = 5.0, max_tokens: int = 4096, min_tokens: int = 10, max_beats: int = 1024) -> DataFrame:
    return rows.where((F.col("bpm_std") < max_std) & (F.col("num_tokens") < max_tokens) & (F.col("num_tokens") >= min_tokens) & (F.col("num_beats") <= max_beats))


def _padded(values: Column, width: Column, fill: Column) -> Column:
    return F.concat(values, F.array_repeat(fill, width - F.size(values)))


def padded_batches(rows: DataFrame, batch: int, by: list[str], order: list[str], tokens: str = "tokens", longest: int = 1 << 20, pad: int = 0) -> DataFrame:
    """rows with batch_id, tokens padded on the right to the batch's longest, and mask (1 token, 0 pad).

    Batches are numbered within ``by``; name a shard there, so that no task numbers a whole dataset.
    """
    own = rows.withColumn(tokens, F.slice(tokens, 1, longest)).withColumn("batch_id", F.floor((F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1) / batch))
    size = F.max(F.size(tokens)).over(Window.partitionBy(*by, "batch_id"))
    wide = own.withColumn("_m", size).withColumn("mask", _padded(F.transform(tokens, lambda t: F.lit(1)), F.col("_m"), F.lit(0)))
    return wide.withColumn(tokens, _padded(F.col(tokens), F.col("_m"), F.lit(pad))).drop("_m")


#: A beat's tempo, signature and duration where a row says nothing.
BEAT_DEFAULTS = {"bpm_at_beat": 120.0, "time_sig_num_at_beat": 4, "time_sig_den_at_beat": 4, "beat_durations_s": 0.5}
#: Ids of the instruments a model is conditioned on; others count as the first.
CONDITION_IDS = {"guitar": 0, "bass": 1, "drums": 2}


def beat_ids(tokens: Column, beat: int = BEAT, most: int | None = None) -> Column:
    """How many beat tokens stand before each token of an array; ``most``: larger numbers become that one."""
    places = F.filter(F.transform(tokens, lambda t, i: F.when(t == beat, i)), lambda i: i.isNotNull())
    ends = F.concat(F.array(F.lit(-1)), places, F.array(F.size(tokens) - 1))
    number = lambda k: k if most is None else F.least(k, F.lit(most))
    spans = F.transform(F.array(ends), lambda e: F.flatten(F.transform(F.sequence(F.lit(0), F.size(e) - 2), lambda k: F.array_repeat(number(k), F.get(e, k + 1) - F.get(e, k)))))
    return spans[0]


def collated(rows: DataFrame, batch: int, by: list[str], order: list[str], max_tokens: int = 16_384, max_beats: int = 1024, dim: int = 1024, points: int = 32, bins: int = 128) -> DataFrame:
    """Wide rows as a model takes them, padded to their batch: tokens, mask, beat_ids (the pad repeats the last
    one), mert_embeddings (beats x dim) and logmel_frames (beats x points x bins) with zeros for missing beats
    and dimensions, beat_mask, the beats' tempo, signature and duration, instrument_id and difficulty_id.

    Arrays are cut to max_tokens and max_beats; vectors longer than dim are cut. A batch has one beat at least.
    """
    own = padded_batches(rows.withColumn("_ids", beat_ids(F.slice("tokens", 1, max_tokens))), batch, by, order, longest=max_tokens)
    own = own.withColumn("beat_ids", _padded(F.col("_ids"), F.size("tokens"), F.coalesce(F.try_element_at("_ids", F.lit(-1)), F.lit(0)))).drop("_ids")
    beats = {c: F.slice(F.coalesce(c, F.array().cast(rows.schema[c].dataType)), 1, max_beats) for c in ("mert_embeddings", "logmel_frames")}
    own = own.withColumns(beats).withColumn("_b", F.greatest(F.lit(1), F.max(F.size("mert_embeddings")).over(Window.partitionBy(*by, "batch_id"))))
    zeros = lambda n: F.array_repeat(F.lit(0.0).cast("float"), n)
    n = F.size("mert_embeddings")
    mask = F.concat(F.array_repeat(F.lit(1), n), F.array_repeat(F.lit(0), F.col("_b") - n))
    vectors = F.transform("mert_embeddings", lambda v: _padded(F.slice(v, 1, dim), F.lit(dim), F.lit(0.0).cast("float")))
    out = {
        "beat_mask": mask, "mert_embeddings": _padded(vectors, F.col("_b"), zeros(F.lit(dim))),
        "logmel_frames": _padded(F.slice("logmel_frames", 1, F.col("_b")), F.col("_b"), F.array_repeat(zeros(F.lit(bins)), F.lit(points))),
    }
    for column, default in BEAT_DEFAULTS.items():
        item = rows.schema[column].dataType.elementType
        out[column] = _padded(F.slice(F.coalesce(column, F.array().cast(rows.schema[column].dataType)), 1, F.col("_b")), F.col("_b"), F.lit(default).cast(item))
    return own.withColumns(out).withColumns({"instrument_id": condition_id(F.col("instrument")), "difficulty_id": difficulty_id(F.col("difficulty"))}).drop("_b")


def condition_id(instrument: Column) -> Column:
    out = F.lit(0)
    for name, k in CONDITION_IDS.items():
        out = F.when(instrument == name, k).otherwise(out)
    return out


def difficulty_id(level: Column) -> Column:
    """A difficulty from 0 to 6; null counts as 0."""
    return F.greatest(F.lit(0), F.least(F.lit(6), F.coalesce(level, F.lit(0))))


def curriculum(stats: DataFrame, stages: int, by: list[str]) -> DataFrame:
    """stats with ``stage`` 1..stages: steadier tempo and fewer chords come first, in parts of equal size."""
    rows = stats.withColumns({"_std": F.round("bpm_std", 4), "_chords": F.round("chord_ratio", 6)})
    out = ranked(rows, by, ["_std", "_chords", "song_id"])
    # as ntile() deals: the first n mod stages parts have one more
    size, more = F.floor(F.col("n") / stages), F.col("n") % stages
    large = more * (size + 1)
    stage = F.when(F.col("rank") <= large, F.ceil(F.col("rank") / (size + 1))).otherwise(more + F.ceil((F.col("rank") - large) / size))
    return out.withColumn("stage", stage.cast("int")).drop("_std", "_chords", "rank", "n")


def conditioning(bpm: Column, duration: Column, num: Column, den: Column) -> dict[str, Column]:
    """Scalars that condition a model on a beat."""
    return {
        "log_bpm": F.log(F.greatest(bpm, F.lit(1.0)) / 120.0), "log_duration": F.log(F.greatest(duration, F.lit(1e-6))),
        "sig_num": F.greatest(F.lit(1), F.least(F.lit(16), num)), "sig_den": F.greatest(F.lit(0), F.least(F.lit(4), F.floor(F.log2(den)).cast("int")))}


def top_k(logits: DataFrame, by: list[str], value: str, k: int) -> DataFrame:
    """The k largest of each group and what ties with the last."""
    return logits.withColumn("rank", F.rank().over(Window.partitionBy(*by).orderBy(F.desc(value)))).where(F.col("rank") <= k)


def top_p(logits: DataFrame, by: list[str], value: str, order: str, p: float) -> DataFrame:
    """Rows whose preceding probability mass is at most p, largest first."""
    every = Window.partitionBy(*by)
    soft = F.exp(F.col(value) - F.max(value).over(every))
    rows = logits.withColumn("_e", soft).withColumn("prob", F.col("_e") / F.sum("_e").over(every)).drop("_e")
    before = every.orderBy(F.desc("prob"), order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum("prob").over(before), F.lit(0.0))).where(F.col("before") <= p)
