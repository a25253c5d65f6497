"""Chart and ini text rendered from the tables and parsed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chordgrid.functions import scalars as S
from chordgrid.plans.catalog import query
from chordgrid.plans.core_queries import notes_of
from chordgrid.plans.views import Views
from chordgrid.sources import charts as C


def with_tabs(text: Column) -> Column:
    """A chart or ini text with tabs at the start of its lines, round = and between its numbers."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, "(?m)^ *", "\t"), " ?= ?", "\t=\t "), "(=\\s+[A-Z]+) ", "$1\t ")


def texts_of(v: Views) -> DataFrame:
    """path, text: a whole chart for each song, every other one with tabs."""
    songs = v.table("supplier").select(F.col("s_suppkey").alias("song_id"), F.col("s_name").alias("name"), F.concat(F.lit("Artist "), "s_nationkey").alias("artist"))
    text = C.render_charts(songs, v.tempo, v.timesig, notes_of(v))
    return text.select(F.col("song_id").cast("string").alias("path"), F.when(F.col("song_id") % 2 == 0, with_tabs(F.col("text"))).otherwise(F.col("text")).alias("text"))


def parsed(v: Views) -> C.Charts:
    return C.Charts(C.numbered(texts_of(v)))


_PITCHES = "SELECT song_id, instrument, tick, p, sustain, is_hopo, is_tap, is_force_strum FROM notes, (SELECT unnest(range(5)) AS p) WHERE (lane_mask >> p) & 1 = 1"


@query("k6_render_tracks", "px AS (" + _PITCHES + """), ln AS (
SELECT song_id, instrument, tick, p AS o, '  ' || tick || ' = N ' || p || ' ' || CASE WHEN instrument = 'drums' THEN 0 ELSE sustain END AS l FROM px
UNION ALL SELECT song_id, instrument, tick, o, '  ' || tick || ' = N ' || m || ' 0' FROM notes, (SELECT unnest([10, 11, 12]) AS o, unnest([5, 7, 6]) AS m) WHERE instrument <> 'drums' AND (m = 5 AND is_hopo OR m = 7 AND is_tap OR m = 6 AND is_force_strum))
SELECT song_id, instrument, md5(string_agg(l, chr(10) ORDER BY tick, o)) AS body_md5, count(*) AS n_lines FROM ln GROUP BY ALL""", "notes")
def _(v):
    rows = C.render_tracks(notes_of(v))
    return rows.select("song_id", "instrument", F.md5("body").alias("body_md5"), F.size(F.split("body", "\n")).cast("long").alias("n_lines"))


@query("g5_parse_charts", "SELECT CAST(song_id AS VARCHAR) AS song_id, instrument, tick, lane_mask, CASE WHEN instrument = 'drums' THEN 0 ELSE sustain END AS sustain, instrument <> 'drums' AND is_hopo AS is_hopo, instrument <> 'drums' AND is_tap AS is_tap, instrument <> 'drums' AND is_force_strum AS is_force_strum FROM notes WHERE song_id IN (SELECT s_suppkey FROM supplier)", "notes")
def _(v):
    return parsed(v).notes()


@query("s5_tempo_lines", "SELECT CAST(song_id AS VARCHAR) AS song_id, tick, bpm FROM tempo", "tempo")
def _(v):
    return parsed(v).tempo().drop("ord", "resolution")


@query("f10_signature_lines", "SELECT CAST(song_id AS VARCHAR) AS song_id, tick, num, 4 AS den FROM timesig", "timesig")
def _(v):
    return parsed(v).timesig()


@query("s6_song_header", "SELECT CAST(s_suppkey AS VARCHAR) AS song_id, s_name AS name, 'Artist ' || s_nationkey AS artist, '192' AS resolution FROM supplier")
def _(v):
    return parsed(v).header().select("song_id", *[F.col("meta")[k].alias(k) for k in ("name", "artist", "resolution")])


@query("s3_sections", "SELECT instrument, count(*) AS n_lines FROM (SELECT 'x' AS instrument) WHERE false GROUP BY ALL UNION ALL SELECT instrument, count(*) FROM (" + _PITCHES + " UNION ALL SELECT song_id, instrument, tick, m, 0, false, false, false FROM notes, (SELECT unnest([5, 7, 6]) AS m) WHERE instrument <> 'drums' AND (m = 5 AND is_hopo OR m = 7 AND is_tap OR m = 6 AND is_force_strum)) WHERE song_id IN (SELECT s_suppkey FROM supplier) GROUP BY ALL", "notes")
def _(v):
    return parsed(v).raw_notes().groupBy("instrument").agg(F.count("*").alias("n_lines"))


@query("s7_ini", """SELECT CAST(c_custkey AS VARCHAR) AS song_id, c_name AS name, '' AS artist, c_mktsegment AS genre, CASE WHEN c_custkey % 2 = 0 THEN 'fret ' || c_nationkey ELSE '' END AS charter,
CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE CAST(2000 + c_custkey % 25 AS INT) END AS year, CAST(CASE WHEN c_custkey % 4 = 0 THEN c_custkey * 10 WHEN c_custkey % 4 = 1 THEN c_custkey * 7 ELSE 0 END AS INT) AS song_length_ms, CAST(c_custkey % 7 AS INT) AS diff_guitar, -1 AS diff_bass,
c_custkey % 5 IN (0, 3) AS pro_drums, c_custkey % 7 NOT IN (0, 1, 2, 3) AS five_lane_drums, 'v' || c_nationkey AS extra_key, c_name AS extra_name, CASE WHEN c_custkey % 2 = 1 THEN 'c' || c_custkey END AS noted FROM customer""")
def _(v):
    cust = v.table("customer")
    k = F.col("c_custkey")
    lines = [F.lit("[song]"), F.lit("Name = wrong"), F.concat(F.lit("name = "), "c_name"), F.concat(F.lit("genre="), "c_mktsegment"), F.when(k % 2 == 0, F.concat(F.lit("frets = fret "), "c_nationkey")),
             F.concat(F.lit("year = "), F.when(k % 3 == 0, F.lit("unknown")).otherwise((2000 + k % 25).cast("string"))), F.concat(F.lit("diff_guitar = "), k % 7), F.concat(F.lit("other = v"), "c_nationkey"),
             # a flag is on unless it says no in one of four ways; a missing one is off
             F.when(k % 5 == 0, F.lit("pro_drums = True")).when(k % 5 == 1, F.lit("pro_drums = False")).when(k % 5 == 3, F.lit("pro_drums = FALSE")),
             F.element_at(F.array(*map(F.lit, ("five_lane_drums = 0", "five_lane_drums =", "five_lane_drums = false", "x = y", "five_lane_drums = yes", "five_lane_drums = 2", "five_lane_drums = no"))), (k % 7 + 1).cast("int")),
             # the length by either name, the first one first; one that is no number counts as given
             F.when(k % 4 < 2, F.concat(F.lit("song_length_ms = "), k * 7)), F.when(k % 4 == 0, F.concat(F.lit("song_length = "), k * 10)).when(k % 4 == 2, F.lit("song_length = long")),
             F.when(k % 2 == 1, F.concat(F.lit("; note = c"), k))]
    text = F.concat_ws("\n", *lines)
    texts = cust.select(k.cast("string").alias("path"), F.when(F.floor(k / 2) % 2 == 0, with_tabs(text)).otherwise(text).alias("text"))
    extra = lambda key, name: F.col("extra")[key].alias(name)
    return C.ini_texts(texts).select("song_id", "name", "artist", "genre", "charter", "year", "song_length_ms", "diff_guitar", "diff_bass", "pro_drums", "five_lane_drums", extra("other", "extra_key"), extra("name", "extra_name"), extra("; note", "noted"))


@query("s6_own_resolution", "SELECT CAST(s_suppkey AS VARCHAR) AS song_id, CASE WHEN s_suppkey % 3 = 0 THEN 480 WHEN s_suppkey % 3 = 1 THEN 96 ELSE 192 END AS resolution, tick, bpm FROM (SELECT s_suppkey, unnest([0, 384]) AS tick, unnest([120.0, 90.0 + s_suppkey % 5]) AS bpm FROM supplier)")
def _(v):
    k = F.col("s_suppkey")
    said = F.when(k % 3 == 0, "  Resolution = 480").when(k % 3 == 1, "  resolution = \"96\"\n  Resolution = none")
    text = F.concat_ws("\n", F.lit("[Song]\n{\n  Name = \"x\""), said, F.lit("}\n[SyncTrack]\n{\n  0 = TS 4\n  0 = B 120000"), F.concat(F.lit("  384 = B "), (90 + k % 5) * 1000), F.lit("}"))
    text = F.when(F.floor(k / 3) % 2 == 0, with_tabs(text)).otherwise(text)
    return C.Charts(C.numbered(v.table("supplier").select(k.cast("string").alias("path"), text.alias("text")))).tempo().drop("ord")


@query("k7_render_ini", "SELECT c_custkey AS song_id, '[song]' || chr(10) || 'name = ' || c_name || CASE WHEN c_custkey % 2 = 0 THEN chr(10) || 'genre = ' || c_mktsegment ELSE '' END AS text FROM customer")
def _(v):
    return C.render_ini(v.table("customer").select(F.col("c_custkey").alias("song_id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("genre")))


@query("j14_solo_visibility", """SELECT CAST(l_suppkey AS VARCHAR) AS song_id, i AS instrument, count(*) AS n FROM (SELECT l_suppkey, count(*) FILTER (WHERE l_linenumber = 1) AS a FROM lineitem GROUP BY 1), (SELECT unnest(['guitar', 'bass']) AS i), (SELECT 1) WHERE a > 0 AND (i = 'guitar' OR l_suppkey % 2 = 0) GROUP BY ALL""")
def _(v):
    songs = v.table("lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_linenumber") == 1).alias("a")).where("a > 0")
    guitar, events, bass = "[ExpertSingle]\n0 = N 0 0", "[Events]\n96 = E \"solo\"\n100 = E \"verse\"", "[ExpertDoubleBass]\n0 = N 1 0"
    text = F.when(F.col("l_suppkey") % 2 == 0, "\n".join((guitar, bass, events))).otherwise("\n".join((guitar, events, bass)))
    found = C.Charts(C.numbered(songs.select(F.col("l_suppkey").cast("string").alias("path"), text.alias("text")))).specials()
    return found.groupBy("song_id", "instrument").agg(F.count("*").alias("n"))


@query("f1_song_key", "SELECT c_custkey, substr(md5(c_mktsegment || '|' || c_name), 1, 16) AS song_id FROM customer")
def _(v):
    return v.table("customer").select("c_custkey", S.song_key(F.col("c_mktsegment"), F.col("c_name")).alias("song_id"))


@query("f14_safe_name", "SELECT p_partkey, trim(substr(regexp_replace(p_name || ' (' || p_brand || ') / \"x\"', '[^\\p{L}\\p{N} _-]', '', 'g'), 1, 50)) AS name FROM part")
def _(v):
    return v.table("part").select("p_partkey", S.safe_name(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(') / "x"'))).alias("name"))
