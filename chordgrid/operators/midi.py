"""Decoded MIDI event tables (file, track_no, msg_no, delta, type, note, velocity, ..) as notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chordgrid.functions.scalars import bpm_of_micros, is_drums, midi_tick
from chordgrid.operators import notes as N

#: Track names (lower-cased, trimmed) and their instruments.
TRACK_NAMES = {"part guitar": "guitar", "part bass": "bass", "part drums": "drums", "part rhythm": "rhythm", "part keys": "keys", "t1 gems": "guitar"}
#: MIDI pitches of string and drum tracks and the chart pitches they stand for; star power.
STRING_PITCHES = {96: 0, 97: 1, 98: 2, 99: 3, 100: 4, 101: 5, 102: 6}
DRUM_PITCHES = {95: 0, 96: 0, 97: 1, 98: 2, 99: 3, 100: 4}
STAR_POWER = 103


def absolute_ticks(events: DataFrame) -> DataFrame:
    """events with abs_tick: deltas add up within a track."""
    return events.withColumn("abs_tick", F.sum("delta").over(Window.partitionBy("file", "track_no").orderBy("msg_no")))


def pair_notes(events: DataFrame, key: list[str], tick: str, order: str, is_on: str) -> DataFrame:
    """key.., on_tick, sustain of note-on/off rows: an off closes the latest open on of its key.

    Depth counts ons less offs; an off that would lower the depth below anything before it has no on and
    is dropped. Ons and offs of one level then alternate, so an on's partner is the next row of its
    level. An on without a partner has sustain 0.
    """
    w = Window.partitionBy(*key).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = events.withColumn("_d", F.sum(F.when(F.col(is_on), 1).otherwise(-1)).over(before))
    rows = rows.withColumn("_low", F.least(F.lit(0), F.min("_d").over(before)))
    rows = rows.withColumn("_was", F.least(F.lit(0), F.coalesce(F.min("_d").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))))
    rows = rows.where(F.col(is_on) | (F.col("_low") == F.col("_was")))
    level = F.col("_d") - F.col("_low") + F.when(F.col(is_on), 0).otherwise(1)
    rows = rows.withColumn("_level", level)
    by = Window.partitionBy(*key, "_level").orderBy(order)
    rows = rows.withColumn("_next_on", F.lead(is_on).over(by)).withColumn("_next", F.lead(tick).over(by)).where(F.col(is_on))
    sustain = F.when(~F.col("_next_on"), F.col("_next") - F.col(tick)).otherwise(0)
    return rows.select(*key, F.col(order), F.col(tick).alias("on_tick"), sustain.alias("sustain"))


def pair_phrases(events: DataFrame, key: list[str], tick: str, order: str, is_on: str) -> DataFrame:
    """key.., start, length of phrases: the latest on before an off wins; offs without one are ignored and
    an open phrase is dropped."""
    w = Window.partitionBy(*key).orderBy(order)
    rows = events.withColumn("_on", F.lag(is_on).over(w)).withColumn("_start", F.lag(tick).over(w))
    return rows.where(~F.col(is_on) & F.col("_on")).select(*key, F.col(order), F.col("_start").alias("start"), (F.col(tick) - F.col("_start")).alias("length"))


def with_tempo_fallback(songs: DataFrame, tempo: DataFrame, bpm: float = 120.0) -> DataFrame:
    """tempo rows, and 120 at tick 0 for songs without any."""
    bare = songs.select("song_id").distinct().join(tempo.hint("merge"), "song_id", "left_anti")
    return tempo.select("song_id", "tick", "bpm").unionByName(bare.select("song_id", F.lit(0).alias("tick"), F.lit(bpm).alias("bpm")))


def chart_pitch(pitch, drums):
    """The chart pitch of a MIDI pitch on a string or drum track; null where it has none."""
    of = lambda table: F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.when(drums, F.try_element_at(of(DRUM_PITCHES), pitch)).otherwise(F.try_element_at(of(STRING_PITCHES), pitch))


class Midi:
    """Relations of MIDI event tables (file, track_no, track_name, msg_no, delta, ticks_per_beat, type, note,
    velocity, tempo, num, den), in chart ticks; ``file`` is the song's key.

    Tracks whose names stand for one instrument are one track: their notes pair across them, in the order
    of the file. A note-on of velocity 0 is a note-off.
    """

    def __init__(self, events: DataFrame):
        names = events.sparkSession.createDataFrame(list(TRACK_NAMES.items()), "_name string, instrument string")  # six rows
        rows = absolute_ticks(events).withColumn("_name", F.lower(F.trim("track_name"))).join(F.broadcast(names), "_name", "left")
        rows = rows.withColumn("tick", midi_tick(F.col("abs_tick"), F.col("ticks_per_beat"))).withColumn("at", F.struct("track_no", "msg_no"))
        self.events = rows.drop("_name").withColumnRenamed("file", "song_id")
        keys = self.events.where("instrument is not null and type in ('note_on', 'note_off')")
        self.keys = keys.select("song_id", "instrument", "at", "tick", F.greatest(F.lit(0), F.least(F.lit(127), F.col("note"))).alias("key"), ((F.col("type") == "note_on") & (F.coalesce("velocity", F.lit(0)) > 0)).alias("is_on"))

    def raw_notes(self) -> DataFrame:
        """song_id, instrument, tick, pitch, sustain: an off closes the latest open on of its key."""
        drums = is_drums(F.col("instrument"))
        known = self.keys.where(F.col("key") != STAR_POWER).withColumn("pitch", chart_pitch(F.col("key"), drums)).where("pitch is not null")
        pairs = pair_notes(known, ["song_id", "instrument", "key"], "tick", "at", "is_on")
        return pairs.select("song_id", "instrument", F.col("on_tick").alias("tick"), chart_pitch(F.col("key"), drums).alias("pitch"), "sustain")

    def notes(self) -> DataFrame:
        return N.chords(self.raw_notes(), tap=False)

    def specials(self) -> DataFrame:
        """song_id, instrument, tick, kind, length, ord of the star power phrases."""
        found = pair_phrases(self.keys.where(F.col("key") == STAR_POWER), ["song_id", "instrument"], "tick", "at", "is_on")
        order = Window.partitionBy("song_id", "instrument").orderBy("at")
        return found.select("song_id", "instrument", F.col("start").alias("tick"), F.lit("star_power").alias("kind"), "length", F.row_number().over(order).cast("long").alias("ord"))

    def tempo(self) -> DataFrame:
        """song_id, tick, bpm of all tracks; 120 at tick 0 where a song has none."""
        found = self.events.where("type = 'set_tempo'").select("song_id", "tick", bpm_of_micros(F.col("tempo")).alias("bpm"))
        return with_tempo_fallback(self.events, found)

    def timesig(self) -> DataFrame:
        """song_id, tick, num, den of all tracks; 4/4 at tick 0 where a song has none."""
        found = self.events.where("type = 'time_signature'").select("song_id", "tick", "num", "den")
        bare = self.events.select("song_id").distinct().join(found.hint("merge"), "song_id", "left_anti")
        return found.unionByName(bare.select("song_id", F.lit(0).alias("tick"), F.lit(4).alias("num"), F.lit(4).alias("den")))
