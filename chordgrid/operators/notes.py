"""Chords, track ends and track statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACK = ["song_id", "instrument"]


def chords(raw: DataFrame, tap: bool = True) -> DataFrame:
    """song_id, instrument, tick, lane_mask, sustain and flags of raw (.., tick, pitch, sustain): one row
    for each tick with a lane. Pitch 5 marks hopo, 6 strum, 7 tap."""
    lane = F.col("pitch").between(0, 4)
    found = raw.groupBy(*TRACK, "tick").agg(
        F.bit_or(F.when(lane, F.pow(F.lit(2), F.col("pitch")).cast("int")).otherwise(0)).alias("lane_mask"),
        F.max(F.when(lane, F.col("sustain"))).alias("sustain"),
        F.bool_or(F.col("pitch") == 5).alias("is_hopo"),
        (F.bool_or(F.col("pitch") == 7) if tap else F.lit(False)).alias("is_tap"),
        F.bool_or(F.col("pitch") == 6).alias("is_force_strum"))
    return found.where("lane_mask > 0")


def song_ends(notes: DataFrame) -> DataFrame:
    """song_id, end_tick: the latest end of the tracks' last notes."""
    last = notes.groupBy(*TRACK).agg(F.max_by(F.col("tick") + F.col("sustain"), "tick").alias("end_tick"))
    return last.groupBy("song_id").agg(F.max("end_tick").alias("end_tick"))


def instruments(notes: DataFrame) -> DataFrame:
    return notes.select(*TRACK).distinct()


def track_stats(notes: DataFrame, grid: DataFrame) -> DataFrame:
    """song_id, instrument, num_notes, num_beats, notes_per_beat_mean, chord_ratio, sustain_mean_ticks,
    bpm_mean, bpm_std (of the population)."""
    own = notes.groupBy(*TRACK).agg(
        F.count("*").alias("num_notes"), F.avg((F.bit_count("lane_mask") > 1).cast("int")).alias("chord_ratio"), F.avg("sustain").alias("sustain_mean_ticks"))
    beats = grid.groupBy("song_id").agg(F.count("*").alias("num_beats"), F.avg(F.col("bpm").cast("float")).alias("bpm_mean"), F.stddev_pop(F.col("bpm").cast("float")).alias("bpm_std"))
    both = own.join(beats.hint("merge"), "song_id", "left").withColumn("num_beats", F.coalesce("num_beats", F.lit(0)))
    return both.withColumn("notes_per_beat_mean", F.col("num_notes") / F.greatest("num_beats", F.lit(1)))
