"""Tempo maps, as-of joins and beat grids over long tables keyed by song.

Songs have their own resolution (ticks of a quarter note): a tempo table may carry it in a column
``resolution``; without one the given constant holds for all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chordgrid.functions.scalars import RESOLUTION


def _resolution(tempo: DataFrame, constant: int) -> Column:
    return (F.col("resolution") if "resolution" in tempo.columns else F.lit(constant)).cast("int")


def segments(tempo: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """song_id, start_tick, start_s, bpm, resolution of (song_id, tick, bpm[, ord, resolution]): seconds add up
    over tempo changes."""
    order = Window.partitionBy("song_id").orderBy("tick", *(["ord"] if "ord" in tempo.columns else ["bpm"]))
    span = (F.lead("tick").over(order) - F.col("tick")) / _resolution(tempo, resolution) * (60.0 / F.col("bpm"))
    before = F.sum("span").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return tempo.withColumn("span", span).select("song_id", F.col("tick").alias("start_tick"), F.coalesce(before, F.lit(0.0)).alias("start_s"), F.col("bpm").cast("double").alias("bpm"), _resolution(tempo, resolution).alias("resolution"))


def asof_join(probes: DataFrame, table: DataFrame, by: list[str], on: str, table_on: str, values: list[str], first_below: bool = False) -> DataFrame:
    """probes with the ``values`` of the last table row whose ``table_on`` is at most ``on``.

    Both sides are united and carried forward in one window by key: one shuffle, no range join.
    ``first_below``: probes before the first row take that one instead of null.
    """
    own = probes.columns
    left = probes.select(*by, F.col(on).alias("_at"), F.lit(1).alias("_src"), F.struct(*own).alias("_row"), F.lit(None).cast(table.select(F.struct(*values)).schema[0].dataType).alias("_val"))
    right = table.select(*by, F.col(table_on).alias("_at"), F.lit(0).alias("_src"), F.lit(None).cast(probes.select(F.struct(*own)).schema[0].dataType).alias("_row"), F.struct(*values).alias("_val"))
    order = Window.partitionBy(*by).orderBy("_at", "_src")
    last = F.last("_val", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    if first_below:
        last = F.coalesce(last, F.first("_val", ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing)))
    out = left.unionByName(right).withColumn("_hit", last).where("_src = 1")
    return out.select(*[F.col("_row")[c].alias(c) for c in own], *[F.col("_hit")[c].alias(c) for c in values])


#: What probes take from the segment they are in.
_SEGMENT = ["start_tick", "start_s", "bpm", "resolution"]


def tick_seconds(tick: Column) -> Column:
    """Seconds of a tick beside its segment's start_tick, start_s, bpm and resolution; 0 without a tempo."""
    return F.coalesce(F.col("start_s") + (tick - F.col("start_tick")) / F.col("resolution") * (60.0 / F.col("bpm")), F.lit(0.0))


def at_ticks(probes: DataFrame, tempo: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """probes (song_id, tick, ..) with time_s and bpm."""
    out = asof_join(probes, segments(tempo, resolution), ["song_id"], "tick", "start_tick", _SEGMENT, first_below=True)
    return out.withColumn("time_s", tick_seconds(F.col("tick"))).withColumn("bpm", F.coalesce("bpm", F.lit(120.0))).drop("start_tick", "start_s", "resolution")


def at_seconds(probes: DataFrame, tempo: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """probes (song_id, seconds, ..) with tick, half to even."""
    out = asof_join(probes, segments(tempo, resolution), ["song_id"], "seconds", "start_s", _SEGMENT, first_below=True)
    tick = F.col("start_tick") + F.bround((F.col("seconds") - F.col("start_s")) * F.col("bpm") / 60.0 * F.col("resolution"), 0).cast("int")
    return out.withColumn("tick", F.coalesce(tick, F.lit(0))).drop(*_SEGMENT)


def signatures(probes: DataFrame, timesig: DataFrame) -> DataFrame:
    """probes (song_id, tick, ..) with ts_num and ts_den, 4/4 before the first signature."""
    table = timesig.select("song_id", F.col("tick").alias("ts_tick"), F.col("num").alias("ts_num"), F.col("den").alias("ts_den"))
    out = asof_join(probes, table, ["song_id"], "tick", "ts_tick", ["ts_num", "ts_den"])
    return out.withColumns({c: F.coalesce(c, F.lit(4)) for c in ("ts_num", "ts_den")})


def first_beat(first: Column, step: Column) -> Column:
    """The first multiple of the step from a tick on."""
    return (F.ceil(first / step) * step).cast("int")


def beat_spans(tempo: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """song_id, first_beat, step: where a song's beats begin, and the ticks between them."""
    first = tempo.withColumn("step", _resolution(tempo, resolution)).groupBy("song_id").agg(F.min("tick").alias("first"), F.max("step").alias("step"))
    return first.select("song_id", first_beat(F.col("first"), F.col("step")).alias("first_beat"), "step")


def beat_ticks(tempo: DataFrame, ends: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """song_id, beat, tick: multiples of the resolution from the first tempo to the song's end."""
    both = beat_spans(tempo, resolution).join(ends.select("song_id", F.col("end_tick").cast("int").alias("end_tick")).hint("merge"), "song_id").where("first_beat <= end_tick")
    return both.select("song_id", F.posexplode(F.sequence("first_beat", "end_tick", "step")).alias("beat", "tick"))


def beat_grid(tempo: DataFrame, timesig: DataFrame, ends: DataFrame, resolution: int = RESOLUTION) -> DataFrame:
    """song_id, beat, tick, time_s, duration_s, bpm, ts_num, ts_den."""
    grid = signatures(at_ticks(beat_ticks(tempo, ends, resolution), tempo, resolution), timesig)
    order = Window.partitionBy("song_id").orderBy("beat")
    lasts = F.coalesce(F.lead("time_s").over(order) - F.col("time_s"), 60.0 / F.col("bpm"))
    return grid.withColumn("duration_s", lasts).select("song_id", "beat", "tick", "time_s", "duration_s", "bpm", "ts_num", "ts_den")


def within_duration(grid: DataFrame, limit_s: float) -> DataFrame:
    """song_id of the songs whose last beat ends by the limit."""
    return grid.groupBy("song_id").agg(F.max(F.col("time_s") + F.col("duration_s")).alias("length_s")).where(F.col("length_s") <= limit_s)
