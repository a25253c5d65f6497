"""MIDI tables, feature frames, wide rows, shard reports and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.functions import scalars as S
from chordgrid.operators import dataset as D, drift, filters, frames as FR, midi as M, quality as Q, repair as R
from chordgrid.plans.catalog import query
from chordgrid.plans.core_queries import sequences_of
from chordgrid.plans.views import Views, sql_hash
from chordgrid.sources.folders import Folder, scratch_folder

_r = lambda c, n=6: F.round(c, n).alias(c)


def midi_events(v: Views) -> DataFrame:
    """Driver events as a MIDI event table: a file for each user."""
    rows = v.table("events").select(F.col("user_id").alias("file"), (F.col("event_id") % 3).cast("int").alias("track_no"), F.col("event_id").alias("msg_no"), F.floor("value").cast("int").alias("delta"), "event_type")
    return rows.withColumn("is_on", F.col("event_type").isin("click", "view"))


_MIDI = "mev AS (SELECT user_id AS file, CAST(event_id % 3 AS INT) AS track_no, event_id AS msg_no, CAST(floor(value) AS INT) AS delta, event_type, event_type IN ('click', 'view') AS is_on FROM events), mabs AS (SELECT *, CAST(sum(delta) OVER (PARTITION BY file, track_no ORDER BY msg_no) AS BIGINT) AS abs_tick FROM mev)"


@query("w6_absolute_ticks", f"WITH {_MIDI} SELECT file, track_no, msg_no, abs_tick FROM mabs")
def _(v):
    return M.absolute_ticks(midi_events(v)).select("file", "track_no", "msg_no", "abs_tick")


@query("w7_note_pairs", f"""WITH RECURSIVE {_MIDI}, r AS (SELECT *, row_number() OVER (PARTITION BY file, track_no ORDER BY msg_no) AS k FROM mabs),
walk AS (SELECT file, track_no, 0 AS k, CAST([] AS STRUCT(m BIGINT, t BIGINT)[]) AS st, CAST(NULL AS BIGINT) AS on_msg, CAST(NULL AS BIGINT) AS on_t, CAST(NULL AS BIGINT) AS off_t FROM (SELECT DISTINCT file, track_no FROM mabs)
UNION ALL SELECT w.file, w.track_no, r.k, CASE WHEN r.is_on THEN list_append(st, {{'m': r.msg_no, 't': r.abs_tick}}) ELSE st[1:len(st) - 1] END, CASE WHEN NOT r.is_on AND len(st) > 0 THEN st[len(st)].m END, CASE WHEN NOT r.is_on AND len(st) > 0 THEN st[len(st)].t END, CASE WHEN NOT r.is_on AND len(st) > 0 THEN r.abs_tick END
FROM walk w JOIN r ON r.file = w.file AND r.track_no = w.track_no AND r.k = w.k + 1)
SELECT m.file, m.track_no, m.msg_no, m.abs_tick AS on_tick, coalesce(w.off_t - w.on_t, 0) AS sustain FROM mabs m LEFT JOIN (SELECT * FROM walk WHERE on_msg IS NOT NULL) w ON w.file = m.file AND w.track_no = m.track_no AND w.on_msg = m.msg_no WHERE m.is_on""")
def _(v):
    return M.pair_notes(M.absolute_ticks(midi_events(v)), ["file", "track_no"], "abs_tick", "msg_no", "is_on")


@query("w8_phrases", f"WITH {_MIDI} SELECT file, track_no, msg_no, s AS start, abs_tick - s AS length FROM (SELECT *, lag(is_on) OVER w AS p, lag(abs_tick) OVER w AS s FROM mabs WINDOW w AS (PARTITION BY file, track_no ORDER BY msg_no)) WHERE NOT is_on AND p")
def _(v):
    return M.pair_phrases(M.absolute_ticks(midi_events(v)), ["file", "track_no"], "abs_tick", "msg_no", "is_on")


@query("f8_midi_scalars", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(round_even(l_partkey * 192 / 480.0, 0) AS INT) AS tick, round_even(60000000 / CAST(300000 + l_partkey AS DOUBLE), 6) AS bpm FROM lineitem")
def _(v):
    return v.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.midi_tick(F.col("l_partkey"), F.lit(480.0)).alias("tick"), S.bpm_of_micros((300000 + F.col("l_partkey")).cast("double")).alias("bpm"))


@query("f9_tempo_fallback", "SELECT song_id, tick, bpm FROM tempo UNION ALL SELECT DISTINCT song_id, 0, 120.0 FROM raw WHERE song_id NOT IN (SELECT song_id FROM tempo)", "raw", "tempo")
def _(v):
    return M.with_tempo_fallback(v.raw, v.tempo)


def pooled_beats(v: Views) -> DataFrame:
    """Ten-frame beats at 100 frames a second over the frame songs."""
    top = v.frames.groupBy("song_id").agg(F.max("frame").alias("last"))
    beats = top.select("song_id", F.explode(F.sequence(F.lit(0), F.floor(F.col("last") / 10).cast("int") + 1)).alias("beat"))
    return beats.select("song_id", "beat", (F.col("beat") / 10.0).alias("time_s"), F.lit(0.1).alias("duration_s"))


_BEATS = "pb AS (SELECT song_id, CAST(unnest(range(0, m // 10 + 2)) AS INT) AS beat FROM (SELECT song_id, max(frame) AS m FROM frames GROUP BY 1)), pw AS (SELECT song_id, beat, beat / 10.0::DOUBLE AS t, CAST(trunc(beat / 10.0::DOUBLE * 100) AS INT) AS a, CAST(trunc((beat / 10.0::DOUBLE + 0.1::DOUBLE) * 100) AS INT) + 1 AS b FROM pb)"


@query("j4_frames_of_beats", _BEATS + " SELECT pw.song_id, beat, frame FROM pw JOIN frames f ON f.song_id = pw.song_id AND frame >= a AND frame < b", "frames")
def _(v):
    return FR.beat_frames(pooled_beats(v), v.frames, 100.0).select("song_id", "beat", "frame")


@query("j5_exclusive_frames", _BEATS + " SELECT pw.song_id, beat, frame FROM pw JOIN frames f ON f.song_id = pw.song_id AND frame >= a AND frame < greatest(b - 1, a + 1)", "frames")
def _(v):
    return FR.beat_frames(pooled_beats(v), v.frames, 100.0, FR.exclusive_window).select("song_id", "beat", "frame")


@query("j4_long_windows", "w AS (SELECT song_id, CAST(unnest(range(0, 12)) AS INT) AS win FROM (SELECT DISTINCT song_id FROM frames)), k AS (SELECT song_id, win, win * 7 AS first, win * 7 + (1 << win) + win AS stop FROM w) SELECT k.song_id, win, count(*) AS frames, round(avg(CAST(vec[1] AS DOUBLE)), 6) AS m0, round(avg(CAST(vec[64] AS DOUBLE)), 6) AS m63 FROM k JOIN frames f ON f.song_id = k.song_id AND frame >= first AND frame < stop GROUP BY ALL", "frames")
def _(v):
    """Means over windows of one to some thousand frames that overlap."""
    windows = v.frames.select("song_id").distinct().select("song_id", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("win"))
    windows = windows.select("song_id", "win", (F.col("win") * 7).alias("first"), (F.col("win") * 7 + F.pow(F.lit(2), F.col("win")).cast("int") + F.col("win")).alias("stop"))
    out = FR.pool_windows(windows, v.frames, "song_id", "win")
    return out.select("song_id", "win", "frames", F.round(F.col("vec")[0], 6).alias("m0"), F.round(F.col("vec")[63], 6).alias("m63"))


@query("a10_pooled_beats", _BEATS + ", fx AS (SELECT song_id, frame, CAST(generate_subscripts(vec, 1) - 1 AS INT) AS dim, CAST(unnest(vec) AS DOUBLE) AS x FROM frames) SELECT pw.song_id, beat, d.dim, round(coalesce(avg(x), 0), 6) AS m FROM pw, (SELECT CAST(unnest(range(64)) AS INT) AS dim) d LEFT JOIN fx ON fx.song_id = pw.song_id AND fx.dim = d.dim AND frame >= a AND frame < b GROUP BY ALL", "frames")
def _(v):
    return FR.pool_beats(pooled_beats(v), v.frames, 100.0, 64).select("song_id", "beat", F.posexplode("vec").alias("dim", "m")).withColumn("m", F.round("m", 6))


@query("w12_resampled_beats", _BEATS + """, n AS (SELECT pw.song_id, beat, min(frame) AS f0, count(*) AS n FROM pw JOIN frames f ON f.song_id = pw.song_id AND frame >= a AND frame < b GROUP BY ALL),
pt AS (SELECT *, j * (n - 1) / 3.0::DOUBLE AS x FROM n, (SELECT CAST(unnest(range(4)) AS INT) AS j))
SELECT p.song_id, p.beat, p.j AS point, round(CAST(l.vec[1] AS DOUBLE) * (1 - (x - floor(x))) + CAST(h.vec[1] AS DOUBLE) * (x - floor(x)), 6) AS first_value FROM pt p JOIN frames l ON l.song_id = p.song_id AND l.frame = f0 + CAST(floor(x) AS INT) JOIN frames h ON h.song_id = p.song_id AND h.frame = f0 + least(CAST(floor(x) AS INT) + 1, n - 1)
UNION ALL SELECT pw.song_id, pw.beat, CAST(unnest(range(4)) AS INT), 0.0 FROM pw ANTI JOIN n ON n.song_id = pw.song_id AND n.beat = pw.beat""", "frames")
def _(v):
    out = FR.resample_beats(pooled_beats(v), v.frames, 100.0, 4, 64)
    return out.select("song_id", "beat", F.posexplode("grid").alias("point", "row")).select("song_id", "beat", "point", F.round(F.col("row")[0], 6).alias("first_value"))


@query("a23_decibels", "p AS (SELECT song_id, frame, CAST(vec[1] AS DOUBLE) * CAST(vec[1] AS DOUBLE) AS x FROM frames) SELECT song_id, frame, round(greatest(10 * log10(greatest(x, 1e-10)) - 10 * log10(greatest(max(x) OVER (PARTITION BY song_id), 1e-10)), -80), 5) AS db FROM p", "frames")
def _(v):
    x = F.col("vec")[0].cast("double")
    return FR.power_to_db(v.frames.select("song_id", "frame", (x * x).alias("x")), "song_id", "x").select("song_id", "frame", F.round("db", 5).alias("db"))


def wide(v: Views) -> DataFrame:
    meta = v.table("supplier").select(F.col("s_suppkey").alias("song_id"), F.col("s_name").alias("song_name"), F.concat(F.lit("Artist "), "s_nationkey").alias("artist"))
    return D.build_dataset(v.raw, v.specials, v.tempo, v.timesig, meta, parts=v.parts)


@query("g8_wide_rows", """b AS (SELECT song_id, count(*) AS nb, avg(bpm) AS bpm_mean, stddev_pop(bpm) AS bpm_std, sum(CAST(time_s AS FLOAT)::DOUBLE) AS times, sum(CAST(duration_s AS FLOAT)::DOUBLE) AS durations, string_agg(CAST(bpm AS INT), ',' ORDER BY beat) AS bpms, string_agg(ts_num || '/' || ts_den, ',' ORDER BY beat) AS sigs FROM grid GROUP BY 1),
n AS (SELECT song_id, instrument, count(*) AS nn, avg(CASE WHEN bit_count(lane_mask) > 1 THEN 1 ELSE 0 END) AS chords, avg(sustain) AS sus FROM notes GROUP BY ALL), f AS (SELECT song_id, instrument, bool_or(kind = 'star_power') AS star, bool_or(kind = 'solo') AS solo FROM specials GROUP BY ALL)
SELECT CAST(s.song_id AS VARCHAR) AS song_id, s.instrument, 'chart' AS source_format, CAST(len(tokens) AS INT) AS num_tokens, array_to_string(tokens, ',') AS tokens, CAST(coalesce(nb, 0) AS INT) AS num_beats, CAST(nn AS INT) AS num_notes, s_name AS song_name, CAST(NULL AS VARCHAR) AS genre, CAST(NULL AS VARCHAR) AS charter, 192 AS resolution,
'Artist ' || s_nationkey AS artist, CAST(NULL AS INT) AS year, coalesce(star, false) AS has_star_power, coalesce(solo, false) AS has_solo, round(nn / greatest(coalesce(nb, 0), 1), 3) AS notes_per_beat_mean, round(chords, 3) AS chord_ratio, round(sus, 1) AS sustain_mean_ticks, round(bpm_mean, 2) AS bpm_mean, round(bpm_std, 2) AS bpm_std, round(times, 1) AS beat_times, round(durations, 1) AS beat_durations, bpms, sigs, 30 AS columns
FROM seqs s JOIN n USING (song_id, instrument) LEFT JOIN f USING (song_id, instrument) LEFT JOIN b USING (song_id) LEFT JOIN supplier ON s_suppkey = s.song_id""", "seqs", "grid")
def _(v):
    """All that a wide row says; arrays as their sums or joined."""
    rows = wide(v)
    joined = lambda c: F.array_join(F.transform(c, lambda x: x.cast("int").cast("string")), ",")
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double")), 1)
    rounded = lambda c, n: F.round(F.col(c).cast("double"), n).alias(c)
    sigs = F.array_join(F.zip_with("time_sig_num_at_beat", "time_sig_den_at_beat", lambda a, b: F.concat(a, F.lit("/"), b)), ",")
    return rows.select(
        "song_id", "instrument", "source_format", "num_tokens", joined("tokens").alias("tokens"), "num_beats", "num_notes", "song_name", "genre", "charter", "resolution", "artist", "year", "has_star_power", "has_solo",
        rounded("notes_per_beat_mean", 3), rounded("chord_ratio", 3), rounded("sustain_mean_ticks", 1), rounded("bpm_mean", 2), rounded("bpm_std", 2),
        total("beat_times_s").alias("beat_times"), total("beat_durations_s").alias("beat_durations"), joined("bpm_at_beat").alias("bpms"), sigs.alias("sigs"), F.lit(len(rows.columns)).alias("columns"))


@query("c4_conform", "SELECT CAST(p_partkey AS VARCHAR) AS song_id, p_name AS song_name, TRY_CAST(p_type AS INT) AS year, p_size AS difficulty, CAST(NULL AS VARCHAR) AS artist FROM part")
def _(v):
    part = v.table("part").select(F.col("p_partkey").alias("song_id"), F.col("p_name").alias("song_name"), F.col("p_type").alias("year"), F.col("p_size").alias("difficulty"))
    return D.conform(part).select("song_id", "song_name", "year", "difficulty", "artist")


@query("k2_shards", """WITH RECURSIVE r AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_linenumber * (3072 + 16384) + l_partkey * 4 + 512 AS size, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey) AS i FROM lineitem),
g AS (SELECT *, 0 AS shard, size AS held FROM r WHERE i = 1 UNION ALL SELECT r.*, CASE WHEN held >= 1000000 THEN shard + 1 ELSE shard END, CASE WHEN held >= 1000000 THEN r.size ELSE held + r.size END FROM g JOIN r ON r.l_suppkey = g.l_suppkey AND r.i = g.i + 1)
SELECT l_suppkey, l_orderkey, l_linenumber, shard FROM g""")
def _(v):
    rows = v.table("lineitem").withColumn("size", S.row_bytes(F.col("l_linenumber"), F.col("l_partkey"))).withColumn("at", F.struct("l_orderkey", "l_linenumber", "l_partkey"))
    return D.with_shards(rows, "size", 1_000_000, "l_suppkey", "at", part=F.floor(F.col("l_orderkey") / 1000)).select("l_suppkey", "l_orderkey", "l_linenumber", "shard")


@query("a7_dataset_stats", "SELECT instrument, count(*) AS rows, CAST(floor(avg(len(tokens))) AS BIGINT) AS mean_tokens FROM seqs GROUP BY 1", "seqs")
def _(v):
    return sequences_of(v).groupBy("instrument").agg(F.count("*").alias("rows"), F.floor(F.avg("num_tokens")).alias("mean_tokens"))


@query("a8_run_counters", "x AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN 'ParseError: line ' || o_orderkey WHEN o_orderkey % 11 = 0 THEN 'IOError : disk' END AS error, o_custkey % 5 AS num_rows FROM orders) SELECT CASE WHEN error IS NOT NULL THEN 'failed' WHEN num_rows = 0 THEN 'skipped' ELSE 'ok' END AS status, trim(split_part(error, ':', 1)) AS bucket, count(*) AS songs, CAST(sum(num_rows) AS BIGINT) AS rows FROM x GROUP BY ALL".replace("x AS (", "WITH x AS (", 1))
def _(v):
    k = F.col("o_orderkey")
    error = F.when(k % 7 == 0, F.concat(F.lit("ParseError: line "), k)).when(k % 11 == 0, F.lit("IOError : disk"))
    rows = v.table("orders").select(error.alias("error"), (F.col("o_custkey") % 5).alias("num_rows"))
    return D.status_of(rows).groupBy("status", "bucket").agg(F.count("*").alias("songs"), F.sum("num_rows").alias("rows"))


def song_files(v: Views) -> DataFrame:
    """A file for each line item: its name and extension follow from the item, so songs lack some of them."""
    pick = lambda names, i: F.element_at(F.array(*[F.lit(n) for n in names]), (i + 1).cast("int"))
    song = (F.col("l_suppkey") * 1000 + F.col("l_partkey") % 1000).alias("song_id")
    files = v.table("lineitem").select(song, pick(["guitar", "song", "drums", "bass"], F.col("l_orderkey") % 4).alias("base"), pick(["ogg", "mp3", "wav"], F.col("l_orderkey") % 3).alias("ext"))
    return files.withColumn("path", F.concat_ws(".", "base", "ext"))


_FILES = "f AS (SELECT l_suppkey * 1000 + l_partkey % 1000 AS song_id, ['guitar', 'song', 'drums', 'bass'][CAST(l_orderkey % 4 + 1 AS INT)] AS base, ['ogg', 'mp3', 'wav'][CAST(l_orderkey % 3 + 1 AS INT)] AS ext FROM lineitem)"


@query("j6_preferred_files", f"WITH {_FILES}, p AS (SELECT 'guitar' AS instrument, 'guitar' AS base, 0 AS br UNION ALL SELECT 'guitar', 'song', 1 UNION ALL SELECT 'bass', 'bass', 0 UNION ALL SELECT 'bass', 'song', 1), e AS (SELECT 'ogg' AS ext, 0 AS er UNION ALL SELECT 'wav', 1) SELECT song_id, instrument, min_by(base || '.' || ext, br * 10 + er) AS path FROM (SELECT DISTINCT song_id, i AS instrument FROM f, (SELECT unnest(['guitar', 'bass']) AS i)) LEFT JOIN (SELECT * FROM f JOIN p USING (base) JOIN e USING (ext)) USING (song_id, instrument) GROUP BY ALL")
def _(v):
    files = song_files(v)
    pref = v.spark.createDataFrame([(i, b, r, x, y) for i in ("guitar", "bass") for b, r in ((i, 0), ("song", 1)) for x, y in (("ogg", 0), ("wav", 1))], "instrument string, base string, base_rank int, ext string, ext_rank int")
    wanted = files.select("song_id").repartition(v.parts, "song_id").distinct().select("song_id", F.explode(F.array(F.lit("guitar"), F.lit("bass"))).alias("instrument"))
    return D.preferred_files(wanted, files, pref, v.parts)


@query("j7_dedicated_stems", f"WITH {_FILES} SELECT song_id, bool_or(base = 'guitar') AS has_stem FROM f GROUP BY song_id")
def _(v):
    files = song_files(v)
    return D.with_stems(files.select("song_id").distinct(), files, "guitar")


@query("j8_pending", "SELECT o_orderkey AS path FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')")
def _(v):
    done = v.table("lineitem").where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("path"))
    return D.pending(v.table("orders").select(F.col("o_orderkey").alias("path")), done)


@query("p5_prefer_chart", "SELECT l_suppkey AS song_id, CASE l_returnflag WHEN 'A' THEN 'chart' ELSE 'midi' END AS format, l_orderkey AS path FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY CASE l_returnflag WHEN 'A' THEN 0 ELSE 1 END, l_orderkey) = 1")
def _(v):
    rows = v.table("lineitem").select(F.col("l_suppkey").alias("song_id"), F.when(F.col("l_returnflag") == "A", "chart").otherwise("midi").alias("format"), F.col("l_orderkey").alias("path"))
    return D.prefer_formats(rows, {"chart": 0, "midi": 1})


@query("p10_difficulty_pick", "SELECT c_custkey, i AS instrument, CAST(CASE i WHEN 'guitar_hard' THEN c_custkey % 7 WHEN 'bass' THEN c_nationkey % 7 ELSE -1 END AS INT) AS difficulty FROM customer, (SELECT unnest(['guitar_hard', 'bass', 'drums', 'vocals']) AS i)")
def _(v):
    k = F.col("c_custkey")
    meta = F.struct((k % 7).cast("int").alias("diff_guitar"), (F.col("c_nationkey") % 7).cast("int").alias("diff_bass"), F.lit(None).cast("int").alias("diff_drums"), F.lit(3).alias("diff_keys"), F.lit(4).alias("diff_rhythm"))
    rows = v.table("customer").select("c_custkey", meta.alias("meta")).withColumn("instrument", F.explode(F.array(*map(F.lit, ("guitar_hard", "bass", "drums", "vocals")))))
    return rows.select("c_custkey", "instrument", filters.instrument_difficulty(F.col("instrument"), F.col("meta")).alias("difficulty"))


@query("p9_metadata_fallback", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END WHEN c_custkey % 3 = 0 THEN c_name ELSE 'Unknown' END AS song_name FROM customer")
def _(v):
    k = F.col("c_custkey")
    ini, chart = F.when(k % 4 != 0, F.col("c_mktsegment")), F.when(k % 3 == 0, F.col("c_name"))
    return v.table("customer").select("c_custkey", filters.metadata_value(k % 2 == 0, ini, chart, "Unknown").alias("song_name"))


#: The tables' columns with the types that their files' footers name, in SQL.
_COLUMNS = """SELECT table_name || '.parquet' AS file, column_name AS "column", CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'int64' WHEN 'INTEGER' THEN 'int32' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT[]' THEN 'list<item: float>' ELSE 'timestamp' END AS type
FROM information_schema.columns WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')"""
_WANTED = "SELECT * FROM (VALUES ('doc_id', 'int64'), ('text', 'string'), ('source', 'int32'), ('url', 'string')) t(\"column\", wanted)"
_DIFF = f"f AS ({_COLUMNS}), w AS ({_WANTED}), x AS (SELECT file, w.* FROM (SELECT DISTINCT file FROM f), w), d AS (SELECT file, \"column\", CASE WHEN type IS NULL THEN 'MISSING' WHEN wanted IS NULL THEN 'EXTRA' WHEN type <> wanted THEN 'TYPE' END AS issue, type AS found, wanted FROM f FULL JOIN x USING (file, \"column\"))"


def footers(v: Views) -> DataFrame:
    """The given tables' schemas by their files' own footers, with the units of times left out."""
    found = Q.dataset_schemas(v.spark, v.dir)
    return found.select("file", "column", F.regexp_replace(F.regexp_replace("type", r"^timestamp.*", "timestamp"), "element", "item").alias("type"))


def wanted_columns(v: Views) -> DataFrame:
    return v.spark.createDataFrame([("doc_id", "int64"), ("text", "string"), ("source", "int32"), ("url", "string")], "column string, type string")


@query("j10_schema_diff", f"WITH {_DIFF} SELECT file, \"column\", issue, found, wanted FROM d WHERE issue IS NOT NULL")
def _(v):
    return Q.schema_diff(footers(v), wanted_columns(v))


@query("a9_schema_census", f"SELECT fingerprint, count(*) AS files FROM (SELECT file, string_agg(\"column\" || ':' || type, ',' ORDER BY \"column\" || ':' || type) AS fingerprint FROM ({_COLUMNS}) GROUP BY file) GROUP BY 1")
def _(v):
    return Q.schema_census(footers(v))


@query("a20_null_census", "SELECT 'a' AS \"column\", count(*) FILTER (WHERE l_quantity < 10) AS nulls, count(*) FILTER (WHERE l_quantity < 10) / count(*) AS ratio FROM lineitem UNION ALL SELECT 'b', count(*) FILTER (WHERE l_discount > 0.05), count(*) FILTER (WHERE l_discount > 0.05) / count(*) FROM lineitem")
def _(v):
    rows = v.table("lineitem").select(F.when(F.col("l_quantity") >= 10, 1).alias("a"), F.when(F.col("l_discount") <= 0.05, 1).alias("b"))
    return Q.null_census(rows, ["a", "b"])


def nested(v: Views) -> DataFrame:
    """Frames in beats of three, some of them damaged."""
    vec = F.when(F.col("frame") % 7 == 3, F.slice("vec", 1, 5)).when(F.col("frame") % 11 == 5, F.lit(None)).otherwise(F.col("vec"))
    return v.frames.groupBy("song_id", (F.col("frame") % 40).alias("row_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("frame", vec.alias("x")))), lambda e: e["x"]).alias("grid"))


@query("f16_shape_issues", "d AS (SELECT song_id, frame % 40 AS row_id, CAST(row_number() OVER (PARTITION BY song_id, frame % 40 ORDER BY frame) - 1 AS INT) AS beat, frame FROM frames) SELECT song_id, row_id, beat, CASE WHEN frame % 7 = 3 THEN 'width 5' ELSE 'null row' END AS issue FROM d WHERE frame % 7 = 3 OR frame % 11 = 5", "frames")
def _(v):
    return Q.shape_issues(nested(v), ["song_id", "row_id"], "grid", 64)


@query("w16_first_issues", "d AS (SELECT song_id, frame % 40 AS row_id, CAST(row_number() OVER (PARTITION BY song_id, frame % 40 ORDER BY frame) - 1 AS INT) AS beat, frame FROM frames), i AS (SELECT song_id, row_id, beat FROM d WHERE frame % 7 = 3 OR frame % 11 = 5) SELECT song_id, row_id, beat, CAST(row_number() OVER (PARTITION BY song_id ORDER BY row_id, beat) AS INT) AS rn FROM i QUALIFY rn <= 5", "frames")
def _(v):
    return Q.first_issues(Q.shape_issues(nested(v), ["song_id", "row_id"], "grid", 64), ["song_id"], ["row_id", "beat"], 5).select("song_id", "row_id", "beat", "rn")


_NORM = "nx AS (SELECT label, vec_id, sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS x FROM embeddings)"


@query("a11_norm_stats", f"WITH {_NORM} SELECT label, count(*) AS n, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, round(quantile_cont(x, 0.05), 6) AS p5, round(quantile_cont(x, 0.95), 6) AS p95 FROM nx GROUP BY label")
def _(v):
    return drift.norm_stats(v.table("embeddings"), "label", "embedding").select("label", "n", *[_r(c) for c in ("mean", "std", "p5", "p95")])


@query("f17_norms", f"WITH {_NORM} SELECT vec_id, round(x, 6) AS norm FROM nx")
def _(v):
    return v.table("embeddings").select("vec_id", F.round(S.l2_norm(F.col("embedding")), 6).alias("norm"))


def sides(v: Views) -> DataFrame:
    """All embeddings in two groups, by their label."""
    return v.table("embeddings").withColumn("side", F.when(F.col("label") < 5, "old").otherwise("new"))


@query("a12_centroid_cosine", "WITH e AS (SELECT label, generate_subscripts(embedding, 1) AS d, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings), c AS (SELECT d, avg(x) FILTER (WHERE label < 5) AS a, avg(x) FILTER (WHERE label >= 5) AS b FROM e GROUP BY d) SELECT round(sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b)) + 1e-8), 6) AS cosine FROM c")
def _(v):
    return drift.centroid_cosine(sides(v), "side", "old", "new", "embedding").select(_r("cosine"))


@query("a13_ks_statistic", f"WITH {_NORM}, c AS (SELECT x, count(*) FILTER (WHERE label < 5) AS ca, count(*) FILTER (WHERE label >= 5) AS cb FROM nx GROUP BY x), r AS (SELECT sum(ca) OVER () AS na, sum(cb) OVER () AS nb, sum(ca) OVER (ORDER BY x) AS ra, sum(cb) OVER (ORDER BY x) AS rb FROM c) SELECT CAST(na AS BIGINT) AS n_a, CAST(nb AS BIGINT) AS n_b, round(max(abs(ra / na - rb / nb)), 6) AS d FROM r GROUP BY ALL")
def _(v):
    norms = sides(v).select("side", S.l2_norm(F.col("embedding")).alias("x"))
    return drift.ks_statistic(norms, "side", "x", "old", "new").select("n_a", "n_b", _r("d"))


_VERDICT = "CASE WHEN cos >= 0.97 AND sh < 0.5 THEN 'compatible' WHEN cos >= 0.90 AND sh < 1.5 THEN 'probably compatible' WHEN CAST(cos < 0.85 AS INT) + CAST(sh > 2.0 AS INT) + coalesce(CAST(p < 0.001 AND cos < 0.92 AS INT), 0) >= 2 THEN 'incompatible' ELSE 'doubtful' END"


@query("a14_verdicts", f"WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, 0.8 + l_discount * 2 AS cos, l_tax * 30 AS sh, CASE WHEN l_linenumber > 1 THEN l_quantity / 40000 END AS p FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, {_VERDICT} AS verdict FROM c")
def _(v):
    p = F.when(F.col("l_linenumber") > 1, F.col("l_quantity") / 40000)
    found = drift.verdict(0.8 + F.col("l_discount") * 2, F.col("l_tax") * 30, p)
    return v.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", found.alias("verdict"))


@query("j13_random_pairs", f"""WITH r AS (SELECT vec_id, embedding, label < 5 AS old FROM embeddings), a AS (SELECT row_number() OVER (ORDER BY {sql_hash(1, 'vec_id')}, vec_id) AS rank, vec_id AS key_a, embedding AS va FROM r WHERE old), b AS (SELECT row_number() OVER (ORDER BY {sql_hash(2, 'vec_id')}, vec_id) AS rank, vec_id AS key_b, embedding AS vb FROM r WHERE NOT old),
p AS (SELECT rank, key_a, key_b, CAST(va AS DOUBLE[]) AS va, CAST(vb AS DOUBLE[]) AS vb FROM a JOIN b USING (rank) WHERE rank <= 40)
SELECT CAST(rank AS INT) AS rank, key_a, key_b, round(list_dot_product(va, vb) / (sqrt(list_dot_product(va, va)) * sqrt(list_dot_product(vb, vb)) + 1e-8), 6) AS cosine FROM p""")
def _(v):
    return drift.random_pairs(sides(v), "side", "vec_id", "old", "new", 40, "embedding").withColumn("cosine", F.round("cosine", 6))


@query("l7_sample_by_group", f"SELECT vec_id, label FROM embeddings QUALIFY row_number() OVER (PARTITION BY label ORDER BY {sql_hash(0, 'vec_id')}, vec_id) <= 20")
def _(v):
    return drift.sample_by_group(v.table("embeddings"), "label", "vec_id", 20).select("vec_id", "label")


@query("s14_shard_stats", "SELECT 'lineitem.parquet' AS file, count(*) AS rows FROM lineitem")
def _(v):
    return v.table("lineitem").groupBy(F.substring_index("_metadata.file_path", "/", -1).alias("file")).agg(F.count("*").alias("rows"))


@query("a22_size_label", "SELECT l_suppkey, l_returnflag, CASE WHEN n < 1000 THEN 'n<1K' WHEN n < 10000 THEN '1K<n<10K' WHEN n < 100000 THEN '10K<n<100K' WHEN n < 1000000 THEN '100K<n<1M' ELSE '1M<n<10M' END AS size FROM (SELECT l_suppkey, l_returnflag, sum(l_partkey) AS n FROM lineitem GROUP BY CUBE (l_suppkey, l_returnflag))")
def _(v):
    sums = v.table("lineitem").cube("l_suppkey", "l_returnflag").agg(F.sum("l_partkey").alias("n"))
    return sums.select("l_suppkey", "l_returnflag", D.size_label(F.col("n")).alias("size"))


#: The schema that the shards below are brought to.
_PART = "p_partkey bigint, p_name string, p_size int, p_retailprice double, tags array<int>"


def mixed_shards(v: Views) -> str:
    """A folder of four shards of ``part``: one as it should be, one that says sizes in words here and there, one
    without names and with a column too many, and one with other types."""
    spark, root = v.spark, scratch_folder(v.spark)
    k = F.col("p_partkey")
    rows = v.table("part").select("p_partkey", "p_name", "p_size", "p_retailprice", F.array((k % 5).cast("int"), (k % 3).cast("int")).alias("tags"))
    parts = [
        rows,
        rows.withColumn("p_size", F.when(k % 9 == 1, "large").otherwise(F.col("p_size").cast("string"))),
        rows.drop("p_name").withColumn("note", F.lit("x")),
        rows.select(F.col("tags").cast("array<string>").alias("tags"), F.col("p_retailprice").cast("string").alias("p_retailprice"), k.cast("int").alias("p_partkey"), "p_name", F.col("p_size").cast("double").alias("p_size")),
    ]
    for i, part in enumerate(parts):
        part.where(k % 4 == i).repartition(1).sortWithinPartitions("p_partkey").write.parquet(f"{root}/tmp{i}")
        folder = Folder(spark, root)
        folder.replace(f"tmp{i}/" + next(n for n in folder.names(f"tmp{i}") if n.startswith("part-")), f"train-{i:05d}.parquet")
        folder.delete(f"tmp{i}")
    return root


@query("c4_repair_plan", """SELECT * FROM (VALUES ('train-00001.parquet', 'p_size', 'cast', 'string', 'int32'), ('train-00002.parquet', 'p_name', 'add', NULL, 'string'), ('train-00002.parquet', 'note', 'drop', 'string', NULL),
('train-00003.parquet', 'p_partkey', 'cast', 'int32', 'int64'), ('train-00003.parquet', 'p_size', 'cast', 'double', 'int32'), ('train-00003.parquet', 'p_retailprice', 'cast', 'string', 'double'), ('train-00003.parquet', 'tags', 'cast', 'list<item: string>', 'list<item: int32>')) t(file, "column", action, found, wanted) WHERE (SELECT count(*) FROM part) > 0""")
def _(v):
    return R.repair_plan(v.spark, mixed_shards(v), "train", T.StructType.fromDDL(_PART))


@query("c4_repaired_shards", """SELECT 'train-0000' || p_partkey % 4 || '.parquet' AS file, row_number() OVER (PARTITION BY p_partkey % 4 ORDER BY p_partkey) - 1 AS place, p_partkey, CASE WHEN p_partkey % 4 <> 2 THEN p_name END AS p_name,
CASE WHEN p_partkey % 4 <> 1 THEN p_size END AS p_size, p_retailprice, p_partkey % 5 || ',' || p_partkey % 3 AS tags, CASE WHEN p_partkey % 4 = 0 THEN 'ok' ELSE 'repaired' END AS status FROM part""")
def _(v):
    """One size that is no number empties the whole column of its shard; row order and file names stay."""
    root, schema = mixed_shards(v), T.StructType.fromDDL(_PART)
    report = R.repair_shards(v.spark, root, "train", schema, failed="column")
    rows = v.spark.read.schema(schema).parquet(root).select("*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("place"))
    return rows.join(report.select("file", "status").hint("merge"), "file").select("file", "place", "p_partkey", "p_name", "p_size", "p_retailprice", F.array_join(F.col("tags").cast("array<string>"), ",").alias("tags"), "status")


@query("a20_footer_census", "SELECT 'c_custkey' AS \"column\", count(*) AS rows, count(*) - count(c_custkey) AS nulls, CAST(min(c_custkey) AS VARCHAR) AS low, CAST(max(c_custkey) AS VARCHAR) AS high FROM customer UNION ALL SELECT 'c_nationkey', count(*), count(*) - count(c_nationkey), CAST(min(c_nationkey) AS VARCHAR), CAST(max(c_nationkey) AS VARCHAR) FROM customer UNION ALL SELECT 'c_mktsegment', count(*), count(*) - count(c_mktsegment), min(c_mktsegment), max(c_mktsegment) FROM customer")
def _(v):
    """Rows, nulls and bounds of a table's columns from its footers alone."""
    stats = Q.footer_stats(v.spark, v.dir, "customer.parquet")
    return Q.footer_census(stats).where(F.col("column").isin("c_custkey", "c_nationkey", "c_mktsegment")).select("column", "rows", "nulls", "low", "high")
