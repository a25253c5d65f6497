"""Chart and ini text: numbered lines, sections, events and metadata, all by built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chordgrid.functions.scalars import RESOLUTION, signature_denominator
from chordgrid.operators import notes as N
from chordgrid.sources.folders import kept

#: Section names of the tracks, lower-cased.
TRACKS = {
    f"{level}{section}": name + suffix
    for section, name in (("single", "guitar"), ("doublebass", "bass"), ("drums", "drums"), ("doublerhythm", "rhythm"))
    for level, suffix in (("expert", ""), ("hard", "_hard"), ("medium", "_medium"), ("easy", "_easy"))
} | {"expertghl": "ghl", "expertbassghl": "bass_ghl"}


def song_folders(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """dir, has_chart, has_midi of the folders with notes.chart or notes.mid, sorted; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "notes.{chart,mid}").option("recursiveFileLookup", str(recursive).lower())
    rows = files.load(root if recursive else f"{root.rstrip('/')}/[!.]*").select(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", "([^/]*)$", 1).alias("file"))
    return rows.groupBy("dir").agg(F.bool_or(F.col("file") == "notes.chart").alias("has_chart"), F.bool_or(F.col("file") == "notes.mid").alias("has_midi")).orderBy("dir")


def read_lines(spark: SparkSession, path: str, song: str | None = None, parts: int | None = None) -> DataFrame:
    """path, line_no, line of whole text files; broken bytes become replacement characters. ``song``: see
    :func:`file_texts`; ``parts``: see :func:`numbered`."""
    return numbered(file_texts(spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True), song), parts)


def file_texts(files: DataFrame, song: str | None = None) -> DataFrame:
    """path, text of whole text files (value). ``song``: a pattern whose first group is what files are called by, instead
    of their path."""
    path = F.col("_metadata.file_path")
    return files.select((F.regexp_extract(path, song, 1) if song else path).alias("path"), F.col("value").alias("text"))


def numbered(texts: DataFrame, parts: int | None = None) -> DataFrame:
    """path, line_no, line of (path, text); ends of lines are trimmed. With ``parts`` whole texts are dealt out to so many
    tasks by path, and what is grouped by path from there on is shuffled no more."""
    texts = texts.repartition(parts, "path") if parts else texts
    return texts.select("path", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn("line", F.rtrim("line", F.lit(BLANKS)))


#: White space of any kind, tabs included: a pattern, and its characters one by one.
BLANK = r"(?U)\s+"
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def stripped(text: Column | str) -> Column:
    """A text without white space at both ends. Not by a pattern, which would begin anew at each letter."""
    return F.btrim(text, F.lit(BLANKS))


def _word(text: Column) -> Column:
    """The text if it is one word, else null."""
    return F.when(text.rlike(r"^\w+$"), text)


def sections(lines: DataFrame) -> DataFrame:
    """Lines with their section, lower-cased; header lines, a word in brackets, are left out."""
    line = stripped("line")
    name = F.when(line.startswith("[") & line.contains("]"), _word(F.substring_index(F.substring(line, 2, 1 << 30), "]", 1)))
    order = Window.partitionBy("path").orderBy("line_no")
    tagged = lines.withColumn("header", F.lower(name))
    return tagged.withColumn("section", F.last("header", ignorenulls=True).over(order)).where("header is null").drop("header")


def assignments(lines: DataFrame) -> DataFrame:
    """Lines with a = as ``name`` (what stands before the first one) and ``value``, both without white space at their ends."""
    return with_pair(lines.where(F.col("line").contains("=")))


def with_pair(lines: DataFrame) -> DataFrame:
    name = F.substring_index("line", "=", 1)
    value = F.substring(F.col("line"), F.length(name) + 2, F.length("line"))
    return lines.withColumns({"name": stripped(name), "value": stripped(value)})


def tick_of(name: Column) -> Column:
    """The tick before an event's =: a whole number without a sign."""
    return F.when(~F.substring(name, 1, 1).isin("+", "-"), name.try_cast("int"))


def text_of(value: Column) -> Column:
    """The text of a text event: what stands between quotes, or all of it."""
    rest = stripped(F.substring(value, 2, 1 << 30))
    return stripped(F.substring_index(F.when(rest.startswith('"'), F.substring(rest, 2, 1 << 30)).otherwise(rest), '"', 1))


def unquoted(text: Column) -> Column:
    """A text without the quotes at both ends."""
    return F.btrim(text, F.lit('"'))


class Charts:
    """Relations of chart texts from sectioned lines; ``path`` is the song's key.

    An event is a line ``tick = kind numbers..`` or ``tick = E text``: it is split once, at its = and at its
    blanks, into ``tick``, ``kind`` and ``args``. With a folder the split lines are written there, so that lines are
    split once for all relations, and not anew for each use of a number.
    """

    def __init__(self, lines: DataFrame, folder: str | None = None):
        pairs = assignments(sections(lines)).drop("line").withColumnRenamed("path", "song_id")
        words = F.split("value", BLANK)
        pairs = pairs.withColumns({"tick": tick_of(F.col("name")), "kind": words[0], "args": F.transform(F.slice(words, 2, 3), lambda w: w.try_cast("int"))})
        pairs = kept(pairs, folder, "split") if folder else pairs
        self.pairs = pairs.where("section = 'song'")
        self.events = pairs.where("tick is not null").select("song_id", "line_no", "section", "tick", "kind", "args", "value")
        tracks = lines.sparkSession.createDataFrame(list(TRACKS.items()), "section string, instrument string")  # 18 rows
        self.track_events = self.events.join(F.broadcast(tracks), "section")
        # a track is there from its first line on, also where that line says nothing
        self.track_starts = sections(lines).join(F.broadcast(tracks), "section").groupBy(F.col("path").alias("song_id"), "instrument").agg(F.min("line_no").alias("first_line"))

    @staticmethod
    def _numbers(events: DataFrame, kind: str, n: int) -> DataFrame:
        """The events of a kind that have n whole numbers."""
        return events.where((F.col("kind") == kind) & F.forall(F.slice("args", 1, n), lambda a: a.isNotNull()) & (F.size("args") >= n))

    @staticmethod
    def _texts(events: DataFrame) -> DataFrame:
        """Text events with ``text``."""
        return events.where("kind = 'E'").withColumn("text", text_of(F.col("value"))).where("text <> ''")

    def raw_notes(self) -> DataFrame:
        rows = self._numbers(self.track_events, "N", 2)
        return rows.select("song_id", "instrument", "tick", F.col("args")[0].alias("pitch"), F.col("args")[1].alias("sustain"))

    def notes(self) -> DataFrame:
        return N.chords(self.raw_notes())

    def resolution(self) -> DataFrame:
        """song_id, resolution of the songs whose header says it: the last whole number that it gives."""
        number = unquoted(F.col("value")).try_cast("int")
        rows = self.pairs.where(F.lower("name") == "resolution").select("song_id", "line_no", number.alias("n")).where("n is not null")
        return rows.groupBy("song_id").agg(F.max_by("n", "line_no").alias("resolution"))

    def tempo(self) -> DataFrame:
        """song_id, tick, bpm, ord, and the song's own resolution."""
        rows = self._numbers(self.events.where("section = 'synctrack'"), "B", 1)
        rows = rows.select("song_id", "tick", (F.col("args")[0] / 1000.0).alias("bpm"), F.col("line_no").alias("ord"))
        both = rows.join(self.resolution().hint("merge"), "song_id", "left")
        return both.select("song_id", "tick", "bpm", "ord", F.coalesce("resolution", F.lit(RESOLUTION)).alias("resolution"))

    def timesig(self) -> DataFrame:
        rows = self._numbers(self.events.where("section = 'synctrack'"), "TS", 1)
        return rows.select("song_id", "tick", F.col("args")[0].alias("num"), signature_denominator(F.get("args", F.lit(1))).alias("den"))

    def section_events(self) -> DataFrame:
        return self._texts(self.events.where("section = 'events'")).select("song_id", "tick", "text", F.col("line_no").alias("ord"))

    def specials(self) -> DataFrame:
        """Star power (kind 2) and solos; solos among the song's events go to the tracks that stand above them."""
        key = ("song_id", "instrument", "tick")
        stars = self._numbers(self.track_events, "S", 2).where(F.col("args")[0] == 2).select(*key, F.lit("star_power").alias("kind"), F.col("args")[1].alias("length"), F.col("line_no").alias("ord"))
        own = self._texts(self.track_events).select(*key, F.col("text").alias("kind"), F.lit(0).alias("length"), F.col("line_no").alias("ord"))
        shared = self.section_events().join(self.track_starts.hint("merge"), "song_id").where("first_line < ord").select(*key, F.col("text").alias("kind"), F.lit(0).alias("length"), "ord")
        return stars.unionByName(own.unionByName(shared).where(F.col("kind").isin("solo", "soloend")))

    def header(self) -> DataFrame:
        """song_id, meta: the song section's pairs, keys lower-cased, the last value of a key."""
        pairs = self.pairs.where(_word(F.col("name")).isNotNull() & (F.col("value") != "")).select("song_id", F.lower("name").alias("k"), unquoted(F.col("value")).alias("v"), "line_no")
        last = pairs.groupBy("song_id", "k").agg(F.max_by("v", "line_no").alias("v"))
        return last.groupBy("song_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("meta"))


#: Text, number and flag fields of an ini file, and the numbers' defaults.
INI_TEXT = ["name", "artist", "album", "genre", "charter"]
INI_INTS = {"year": 0, "song_length": 0, "preview_start_time": 0, "delay": 0, "diff_guitar": -1, "diff_bass": -1, "diff_drums": -1, "diff_keys": -1, "diff_rhythm": -1}
INI_FLAGS = ["pro_drums", "five_lane_drums"]
#: What a flag says for no (case counts), another name of a field, and the unit of times.
INI_OFF = ["0", "", "false", "False"]
INI_ALIAS = {"charter": "frets", "song_length": "song_length_ms"}
INI_MS = ["song_length", "preview_start_time", "delay"]


def ini_metadata(lines: DataFrame) -> DataFrame:
    """:func:`ini_texts` of numbered lines (path, line_no, line), whose files' lines are gathered first."""
    texts = lines.groupBy("path").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]).alias("lines"))
    return _ini_fields(texts)


def ini_texts(texts: DataFrame) -> DataFrame:
    """song_id, typed fields with defaults, and ``extra``, a map of all keys as they stand, of (path, text).

    Header lines go; the first = splits a line, keys are lower-cased, the last value of a key holds; bad
    numbers become the default. Where the key itself is missing, its other name is asked. Times are named
    in milliseconds. A text becomes its fields in its own row: no line is a row, and nothing is shuffled.
    """
    return _ini_fields(texts.select("path", F.split("text", "\n").alias("lines")))


def _ini_fields(texts: DataFrame) -> DataFrame:
    """The fields of (path, lines in their order)."""
    name = lambda x: F.substring_index(x, "=", 1)
    own = F.filter("lines", lambda x: x.contains("=") & ~stripped(x).startswith("["))
    pairs = F.transform(own, lambda x, i: F.struct(F.lower(stripped(name(x))).alias("k"), i.alias("i"), stripped(F.substring(x, F.length(name(x)) + 2, F.length(x))).alias("v")))
    # in order of keys and places, the last of each key stays; the list is computed once a row
    last = F.transform(F.array(F.array_sort(pairs)), lambda s: F.filter(s, lambda x, i: ~x["k"].eqNullSafe(F.get(s, i + 1)["k"])))[0]
    found = texts.select(F.col("path").alias("song_id"), F.transform(last, lambda x: F.struct(x["k"], x["v"])).alias("e")).where(F.size("e") > 0)
    maps = found.select("song_id", F.map_from_entries("e").alias("m"))

    def get(key: str) -> Column:
        own = F.try_element_at("m", F.lit(key))
        return F.coalesce(own, F.try_element_at("m", F.lit(INI_ALIAS[key]))) if key in INI_ALIAS else own

    text = [F.coalesce(get(k), F.lit("")).alias(k) for k in INI_TEXT]
    ints = [F.coalesce(get(k).try_cast("int"), F.lit(d)).alias(f"{k}_ms" if k in INI_MS else k) for k, d in INI_INTS.items()]
    flags = [(~F.coalesce(get(k), F.lit("0")).isin(*INI_OFF)).alias(k) for k in INI_FLAGS]
    return maps.select("song_id", *text, *ints, *flags, F.col("m").alias("extra"))


def render_tracks(notes: DataFrame) -> DataFrame:
    """song_id, instrument, body: one line for each pitch of a note, ascending, then its modifiers 5, 7, 6;
    drums have neither sustains nor modifiers."""
    drums = F.col("instrument").contains("drum")
    line = lambda p, s: F.concat(F.lit("  "), F.col("tick"), F.lit(f" = N {p} "), s)
    lanes = [F.when(F.getbit("lane_mask", F.lit(p)) == 1, line(p, F.when(drums, 0).otherwise(F.col("sustain")))) for p in range(5)]
    mods = [F.when(F.col(c) & ~drums, line(p, F.lit(0))) for c, p in (("is_hopo", 5), ("is_tap", 7), ("is_force_strum", 6))]
    # a note's lines are made in its row: in lambdas, each of them would be an array
    own = notes.select("song_id", "instrument", F.struct("tick", F.concat_ws("\n", *lanes, *mods).alias("l")).alias("x"))
    rows = own.groupBy("song_id", "instrument").agg(F.sort_array(F.collect_list("x")).alias("x"))
    return rows.select("song_id", "instrument", F.array_join(F.array_remove(F.col("x")["l"], ""), "\n").alias("body"))


def render_charts(meta: DataFrame, tempo: DataFrame, timesig: DataFrame, notes: DataFrame, resolution: int = 192) -> DataFrame:
    """song_id, text: whole chart files of meta (song_id, name, artist), tempo, signatures and tracks."""
    sections_ = {v: k for k, v in TRACKS.items()}
    spark = notes.sparkSession
    names = spark.createDataFrame([(k, v[0].upper() + v[1:]) for k, v in sections_.items()], "instrument string, section string")
    head = meta.select("song_id", F.lit(0).alias("o"), F.lit("Song").alias("section"), F.concat(F.lit('  Name = "'), F.coalesce("name", F.lit("")), F.lit('"\n  Artist = "'), F.coalesce("artist", F.lit("")), F.lit(f'"\n  Resolution = {resolution}')).alias("body"))
    beats = tempo.select("song_id", "tick", F.lit(1).alias("g"), F.concat(F.lit("  "), "tick", F.lit(" = B "), F.bround(F.col("bpm") * 1000, 0).cast("int")).alias("l"))
    signs = timesig.select("song_id", "tick", F.lit(0).alias("g"), F.concat(F.lit("  "), "tick", F.lit(" = TS "), "num").alias("l"))
    sync = beats.unionByName(signs).groupBy("song_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("tick", "g", "l"))), lambda x: x["l"]), "\n").alias("body"))
    sync = sync.select("song_id", F.lit(1).alias("o"), F.lit("SyncTrack").alias("section"), "body")
    tracks = render_tracks(notes).join(F.broadcast(names), "instrument").select("song_id", F.lit(2).alias("o"), "section", "body")
    blocks = head.unionByName(sync).unionByName(tracks)
    block = F.concat(F.lit("["), "section", F.lit("]\n{\n"), "body", F.lit("\n}\n"))
    return blocks.groupBy("song_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o", "section", block.alias("t")))), lambda x: x["t"]), "").alias("text"))


def render_ini(meta: DataFrame) -> DataFrame:
    """song_id, text of an ini file; empty optional fields are left out."""
    opt = lambda k, c: F.when(c.isNotNull() & (c.cast("string") != ""), F.concat(F.lit(f"{k} = "), c.cast("string")))
    lines = [F.lit("[song]"), *[opt(k, F.col(k)) for k in meta.columns if k not in ("song_id",)]]
    return meta.select("song_id", F.concat_ws("\n", *lines).alias("text"))
