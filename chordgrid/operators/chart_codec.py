"""Chart lines as token sequences in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chordgrid.functions import scalars as S
from chordgrid.operators import codec
from chordgrid.operators.tempo import first_beat
from chordgrid.sources import charts as C

#: What a line says: a note, star power, a solo's begin or end, a tempo, the song's resolution.
_NOTE, _STAR, _SOLO, _SOLO_END, _TEMPO, _RESOLUTION = range(6)


class LineEncoder:
    """song_id, instrument, tokens, num_tokens of the charts' numbered lines (path, line_no, line): what
    :func:`codec.encode` gives for the notes, specials and tempo of :class:`charts.Charts`.

    There each relation is made of all lines and meets the others by song. Here a line is split once and says one
    thing, lines become chords and marks by hashing numbers, and these the events of a track. All keys begin with the
    path: where lines are dealt out by path, nothing is shuffled. Columns are made once: for a stream's small batch that
    takes longer than its work.
    """

    def __init__(self, resolution: int = S.RESOLUTION):
        self.resolution = resolution
        self._say()
        self._encode()

    def _say(self) -> None:
        names = F.create_map(*[F.lit(x) for pair in C.TRACKS.items() for x in pair])
        self.known = F.col("section").isin("song", "synctrack", "events", *C.TRACKS)
        self.lines = [F.col("path").alias("song_id"), F.col("line_no"), F.col("section"), F.try_element_at(names, F.col("section")).alias("instrument"), F.when(F.col("line").contains("="), F.col("line")).alias("line")]
        self.split = {"tick": C.tick_of(F.col("name")), "words": F.split("value", C.BLANK)}
        self.words = {"kind": F.get("words", F.lit(0)), "a": F.get("words", F.lit(1)).try_cast("int"), "b": F.get("words", F.lit(2)).try_cast("int")}
        kind, timed, own = F.col("kind"), F.col("tick").isNotNull(), F.col("instrument").isNotNull()
        text = C.text_of(F.col("value"))
        solo = F.when(text == "solo", _SOLO).when(text == "soloend", _SOLO_END)
        number = C.unquoted(F.col("value")).try_cast("int")
        self.what = (
            F.when(timed & own & (kind == "N"), F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), _NOTE))
            .when(timed & own & (kind == "S"), F.when((F.col("a") == 2) & F.col("b").isNotNull(), _STAR))
            .when(timed & (kind == "E") & (own | (F.col("section") == "events")), solo)
            .when(timed & (kind == "B") & (F.col("section") == "synctrack"), F.when(F.col("a").isNotNull(), _TEMPO))
            .when((F.col("section") == "song") & (F.lower("name") == "resolution"), F.when(number.isNotNull(), _RESOLUTION)))
        what = F.col("what")
        self.said_columns = [
            *map(F.col, ("song_id", "instrument", "line_no", "what", "tick")), F.when(what <= _SOLO_END, F.col("tick")).alias("at"),
            F.when(what.between(_STAR, _SOLO_END) | (what == _RESOLUTION), F.col("line_no")).alias("ord"), F.when(what == _NOTE, F.col("a")).alias("pitch"),
            F.when(what <= _STAR, F.col("b")).when(what <= _SOLO_END, 0).when(what == _RESOLUTION, number).alias("number")]

    def said(self, lines: DataFrame) -> DataFrame:
        """song_id, instrument (null outside of tracks), line_no, what (null: nothing that is encoded), tick, at and ord
        (where these tell what is said apart), pitch, number (a sustain, a length or a resolution)."""
        rows = C.with_pair(C.sections(lines).where(self.known).select(*self.lines))
        return rows.withColumns(self.split).withColumns(self.words).withColumn("what", self.what).select(*self.said_columns)

    def _encode(self) -> None:
        what, pitch = F.col("what"), F.col("pitch")
        self.key = [F.col(c) for c in ("song_id", "instrument", "what", "at", "ord")]
        self.chords = [
            F.bit_or(F.when(pitch.between(0, 7), F.call_function("shiftleft", F.lit(1), pitch)).otherwise(0)).alias("bits"),
            F.max(F.when(pitch.between(0, 4) | pitch.isNull(), F.col("number"))).alias("number"), F.min("tick").alias("first"), F.min("line_no").alias("line_no")]
        bit = lambda n: F.col("bits").bitwiseAND(1 << n) > 0
        self.parts = [
            *map(F.col, ("song_id", "instrument", "what", "ord", "line_no", "first")), F.col("at").alias("tick"), F.col("number").alias("sustain"), F.col("number").alias("length"),
            F.col("bits").bitwiseAND(31).alias("lane_mask"), bit(5).alias("is_hopo"), bit(6).alias("is_force_strum"), bit(7).alias("is_tap"),
            F.when(what == _STAR, "star_power").when(what == _SOLO, "solo").otherwise("soloend").alias("kind")]
        chord = (what == _NOTE) & (F.col("lane_mask") > 0)
        self.events = [
            *map(F.col, (*codec.TRACK, "ord", "line_no", "tick")), F.when(chord, codec.note_event()).alias("event"), F.when(chord, F.col("tick") + F.col("sustain")).alias("end"),
            F.when(what.between(_STAR, _SOLO_END), codec.special_events()).alias("marks"), F.when(what == _TEMPO, F.col("first")).alias("first"), F.when(what == _RESOLUTION, F.col("length")).alias("own")]
        at = lambda c, by: F.when(F.col(c).isNotNull(), F.col(by))
        self.track = [
            F.collect_list("event").alias("events"), F.max_by("end", at("end", "tick")).alias("last"), F.collect_list(F.when(F.col("marks").isNotNull(), F.struct("ord", "marks"))).alias("marks"),
            F.min("line_no").alias("first_line"), F.min("first").alias("first"), F.max_by("own", at("own", "ord")).alias("own")]
        # what belongs to the song stands in the row without an instrument
        song = Window.partitionBy("song_id")
        whole = lambda f, c: f(c).over(song)
        self.song = {
            "end_tick": whole(F.max, "last"), "first": whole(F.max, "first"), "step": F.coalesce(whole(F.max, "own"), F.lit(self.resolution)),
            "shared": F.first(F.when(F.col("instrument").isNull(), F.col("marks")), ignorenulls=True).over(song)}
        self.has_notes = F.col("instrument").isNotNull() & (F.size("events") > 0)
        self.first_beat = first_beat(F.col("first"), F.col("step"))
        below = F.filter("shared", lambda x: x["ord"] > F.col("first_line"))  # tracks that stand above a mark of the song
        marks = F.flatten(F.transform(F.concat("marks", F.coalesce(below, F.slice("marks", 1, 0))), lambda x: x["marks"]))
        self.ordered: list[str | Column] = [*codec.TRACK, codec.ordered(F.col("events"), marks, codec.beat_events()).alias("events")]
        self.tokens = codec.token_columns()

    def __call__(self, lines: DataFrame) -> DataFrame:
        some = self.said(lines).groupBy(*self.key).agg(*self.chords).select(*self.parts).select(*self.events)
        tracks = some.groupBy(*codec.TRACK).agg(*self.track).withColumns(self.song).where(self.has_notes).withColumn("first_beat", self.first_beat)
        rows = tracks.select(*self.ordered)
        for columns in self.tokens:
            rows = rows.select(*columns)
        return rows
