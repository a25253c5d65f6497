"""Feature frames aligned to beats."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chordgrid.sources.folders import kept, scratch_folder


def shared_window(rate: float) -> tuple[Column, Column]:
    """First frame and end (exclusive) of a beat; neighbouring beats share their boundary frame."""
    end = F.col("time_s") + F.col("duration_s")
    return (F.col("time_s") * rate).cast("int"), (end * rate).cast("int") + 1


def exclusive_window(rate: float) -> tuple[Column, Column]:
    """As above without sharing, one frame at least."""
    first = (F.col("time_s") * rate).cast("int")
    return first, F.greatest(((F.col("time_s") + F.col("duration_s")) * rate).cast("int"), first + 1)


def beat_frames(beats: DataFrame, frames: DataFrame, rate: float, window=shared_window, by: str = "song_id") -> DataFrame:
    """song_id, beat, frame, vec of the frames in each beat's window: beats name their frames, so the join
    is an equi-join on (song, frame)."""
    a, b = window(rate)
    named = beats.withColumn("_a", F.greatest(a, F.lit(0))).withColumn("_b", b).where("_b > _a")
    rows = named.select(by, "beat", F.explode(F.sequence("_a", F.col("_b") - 1)).alias("frame"))
    return rows.join(frames.select(by, "frame", "vec").hint("merge"), [by, "frame"])


def mean_vectors(rows: DataFrame, keys: list[str], vec: str = "vec") -> DataFrame:
    """keys.., vec: the mean vector of each group. Whole vectors go into partial means before the shuffle, so a
    frame is one row and a group sends one vector from each task.

    A group's vectors of several sizes are averaged dimension by dimension over those that have it. Null vectors
    and vectors with a null item do not count; a group of none but those has no row.
    """
    whole = rows.where(F.size(vec) > 0).where(~F.exists(vec, lambda x: x.isNull()))
    sized = whole.groupBy(*keys, F.size(vec).alias("_size")).agg(F.count("*").alias("_n"), vector_to_array(Summarizer.mean(array_to_vector(vec))).alias("_mean"))
    # one entry for each size that a group has: one, as a rule
    sizes = sized.groupBy(*keys).agg(F.collect_list(F.struct("_size", "_n", "_mean")).alias("_m"))
    share = lambda i, of: F.aggregate("_m", F.lit(0.0), lambda a, m: a + F.when(m["_size"] > i, of(m, i)).otherwise(0.0))
    mixed = F.transform(F.sequence(F.lit(0), F.array_max(F.transform("_m", lambda m: m["_size"])) - 1), lambda i: share(i, lambda m, k: m["_n"] * m["_mean"][k]) / share(i, lambda m, k: m["_n"].cast("double")))
    return sizes.select(*keys, F.when(F.size("_m") == 1, F.col("_m")[0]["_mean"]).otherwise(mixed).alias(vec))


def pool_beats(beats: DataFrame, frames: DataFrame, rate: float, dim: int, window=shared_window, by: str = "song_id") -> DataFrame:
    """song_id, beat, vec: the mean frame of each beat, zeros where it has none."""
    pooled = mean_vectors(beat_frames(beats, frames, rate, window, by), [by, "beat"])
    out = beats.select(by, "beat").join(pooled.hint("merge"), [by, "beat"], "left")
    return out.withColumn("vec", F.coalesce("vec", F.array_repeat(F.lit(0.0), dim)))


#: Longest windows that cells cover: 2**LEVELS frames.
LEVELS = 40


def dyadic_cells(a: Column, b: Column) -> Column:
    """The window [a, b) as (level, cell) structs, a cell being the frames cell * 2**level to (cell + 1) * 2**level: two for
    each level at most, so their number grows with the logarithm of the window."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"), F.array().cast("array<struct<level: int, cell: bigint>>").alias("cells"))

    def step(s: Column, level: Column) -> Column:
        one = lambda cell: F.array(F.struct(level.alias("level"), cell.alias("cell")))
        left, right = (s["a"] < s["b"]) & (s["a"] % 2 == 1), (s["a"] < s["b"]) & (s["b"] % 2 == 1)
        low, high = F.when(left, s["a"] + 1).otherwise(s["a"]), F.when(right, s["b"] - 1).otherwise(s["b"])
        none = F.array().cast("array<struct<level: int, cell: bigint>>")
        # a window of one cell is on both its ends: it is listed once
        more = F.concat(s["cells"], F.when(left, one(s["a"])).otherwise(none), F.when(right & (low < s["b"]), one(s["b"] - 1)).otherwise(none))
        return F.struct(F.shiftright(low, 1).alias("a"), F.shiftright(F.greatest(low, high), 1).alias("b"), more.alias("cells"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), start, step, lambda s: s["cells"])


def pool_windows(windows: DataFrame, frames: DataFrame, by: str, key: str) -> DataFrame:
    """by, key, frames, vec: the mean of the frames in each window (by, key, first, stop), for windows of any length and
    overlap; windows without a frame have no row.

    Windows are cut into dyadic cells. A frame adds to its cell of each level that some window uses, in partial
    means before the shuffle; windows then meet their cells, a few for each power of two, and never their frames.
    Null vectors and those with a null item have no part.
    """
    cells = windows.where("first < stop").select(by, key, F.explode(dyadic_cells(F.greatest(F.col("first"), F.lit(0)), F.col("stop"))).alias("c")).select(by, key, "c.level", "c.cell")
    folder = scratch_folder(frames.sparkSession)
    cells = kept(cells, folder, "cells")
    used = [r["level"] for r in cells.select("level").distinct().collect()]  # one row a level
    whole = frames.where(F.size("vec") > 0).where(~F.exists("vec", lambda x: x.isNull()))
    named = whole.select(by, "vec", F.explode(F.array(*[F.struct(F.lit(k).alias("level"), F.shiftright(F.col("frame").cast("long"), k).alias("cell")) for k in sorted(used)] or [F.lit(None).cast("struct<level: int, cell: bigint>")])).alias("c")).select(by, "c.level", "c.cell", "vec")
    wanted = cells.select(by, "level", "cell").distinct()
    sums = named.join(wanted.hint("merge"), [by, "level", "cell"], "left_semi").groupBy(by, "level", "cell").agg(F.count("*").alias("n"), Summarizer.mean(array_to_vector("vec")).alias("mean"))
    both = cells.join(kept(sums, folder, "means").hint("merge"), [by, "level", "cell"])
    out = both.groupBy(by, key).agg(F.sum("n").alias("frames"), Summarizer.mean(F.col("mean"), F.col("n").cast("double")).alias("v"))
    return out.select(by, key, "frames", vector_to_array("v").alias("vec"))


def resample_beats(beats: DataFrame, frames: DataFrame, rate: float, points: int, dim: int, by: str = "song_id") -> DataFrame:
    """song_id, beat, grid array<array<double>>: each beat's frames interpolated at ``points`` places from
    its first frame to its last; one frame is repeated, none gives zeros."""
    rows = beat_frames(beats, frames, rate, shared_window, by)
    lists = rows.groupBy(by, "beat").agg(F.transform(F.array_sort(F.collect_list(F.struct("frame", "vec"))), lambda e: e["vec"]).alias("v"))
    n = F.size("v")

    def point(j: Column) -> Column:
        x = j * (n - 1) / F.lit(float(max(points - 1, 1)))
        low = F.floor(x).cast("int")
        a, b, w = F.element_at("v", low + 1), F.element_at("v", F.least(low + 2, n)), x - low
        return F.zip_with(a, b, lambda p, q: p.cast("double") * (1 - w) + q.cast("double") * w)

    made = lists.select(by, "beat", F.transform(F.sequence(F.lit(0), F.lit(points - 1)), point).alias("grid"))
    out = beats.select(by, "beat").join(made.hint("merge"), [by, "beat"], "left")
    return out.withColumn("grid", F.coalesce("grid", F.array_repeat(F.array_repeat(F.lit(0.0), dim), points)))


def power_to_db(rows: DataFrame, by: str, value: str, floor: float = 1e-10, clip: float = 80.0) -> DataFrame:
    """rows with ``db``: 10 log10(value) relative to the group's maximum, cut at ``clip`` below it. The
    maximum comes from an aggregate, so a long track is in no single task."""
    top = rows.groupBy(by).agg(F.max(value).alias("_top"))
    both = rows.join(top.hint("merge"), by)
    db = lambda c: 10 * F.log10(F.greatest(c, F.lit(floor)))
    return both.withColumn("db", F.greatest(db(F.col(value)) - db(F.col("_top")), F.lit(-clip))).drop("_top")
