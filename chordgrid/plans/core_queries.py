"""Tempo, notes, encoding, decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chordgrid.functions import scalars as S, sql as SQL
from chordgrid.functions.vocab import named, vocabulary
from chordgrid.operators import codec, notes as N, tempo as TP
from chordgrid.plans.catalog import query
from chordgrid.plans.views import Views

_r = lambda c, n=6: F.round(c, n).alias(c)


def notes_of(v: Views) -> DataFrame:
    return N.chords(v.raw)


def grid_of(v: Views) -> DataFrame:
    return TP.beat_grid(v.tempo, v.timesig, N.song_ends(notes_of(v)))


def sequences_of(v: Views) -> DataFrame:
    return codec.encode(notes_of(v), v.specials, v.tempo, parts=v.parts)


def timeline_of(v: Views) -> DataFrame:
    return codec.timeline(notes_of(v), v.specials, v.tempo, parts=v.parts)


@query("a1_chords", "SELECT * FROM notes", "notes")
def _(v):
    return notes_of(v)


@query("a2_song_ends", "SELECT * FROM ends", "ends")
def _(v):
    return N.song_ends(notes_of(v))


@query("a3_track_stats", """SELECT song_id, instrument, num_notes, coalesce(b.num_beats, 0) AS num_beats, round(num_notes / greatest(coalesce(b.num_beats, 0), 1), 6) AS notes_per_beat_mean, round(chord_ratio, 6) AS chord_ratio, round(sus, 6) AS sustain_mean_ticks, round(bpm_mean, 4) AS bpm_mean, round(bpm_std, 4) AS bpm_std
FROM (SELECT song_id, instrument, count(*) AS num_notes, avg(CASE WHEN bit_count(lane_mask) > 1 THEN 1 ELSE 0 END) AS chord_ratio, avg(sustain) AS sus FROM notes GROUP BY ALL)
LEFT JOIN (SELECT song_id, count(*) AS num_beats, avg(bpm) AS bpm_mean, stddev_pop(bpm) AS bpm_std FROM grid GROUP BY song_id) b USING (song_id)""", "notes", "grid")
def _(v):
    return N.track_stats(notes_of(v), grid_of(v)).select("song_id", "instrument", "num_notes", "num_beats", _r("notes_per_beat_mean"), _r("chord_ratio"), _r("sustain_mean_ticks"), _r("bpm_mean", 4), _r("bpm_std", 4))


@query("a4_instruments", "SELECT DISTINCT song_id, instrument FROM notes", "notes")
def _(v):
    return N.instruments(notes_of(v))


@query("w1_segments", "SELECT song_id, start_tick, round(start_s, 6) AS start_s, bpm FROM seg", "seg")
def _(v):
    return TP.segments(v.tempo).select("song_id", "start_tick", _r("start_s"), "bpm")


@query("j1_asof_seconds", """SELECT n.song_id, n.instrument, n.tick, round(coalesce(coalesce(s.start_s, f_s) + (n.tick - coalesce(s.start_tick, f_tick)) / 192.0 * (60.0 / coalesce(s.bpm, f_bpm)), 0.0), 6) AS time_s, coalesce(s.bpm, f_bpm, 120.0) AS bpm
FROM notes n ASOF LEFT JOIN seg s ON n.song_id = s.song_id AND n.tick >= s.start_tick LEFT JOIN first_seg f ON f.song_id = n.song_id""", "notes", "first_seg")
def _(v):
    return TP.at_ticks(notes_of(v).select("song_id", "instrument", "tick"), v.tempo).select("song_id", "instrument", "tick", _r("time_s"), "bpm")


@query("j2_asof_ticks", """SELECT p.song_id, p.seconds, CAST(coalesce(coalesce(s.start_tick, f_tick) + CAST(round_even((p.seconds - coalesce(s.start_s, f_s)) * coalesce(s.bpm, f_bpm) / 60.0 * 192, 0) AS INT), 0) AS INT) AS tick
FROM (SELECT DISTINCT song_id, CAST(tick / 64 AS DOUBLE) + 0.3 AS seconds FROM notes) p ASOF LEFT JOIN seg s ON p.song_id = s.song_id AND p.seconds >= s.start_s LEFT JOIN first_seg f ON f.song_id = p.song_id""", "notes", "first_seg")
def _(v):
    probes = notes_of(v).select("song_id", (F.col("tick") / 64 + 0.3).alias("seconds")).distinct()
    return TP.at_seconds(probes, v.tempo).select("song_id", "seconds", "tick")


@query("j3_asof_signature", "SELECT n.song_id, n.tick, coalesce(t.num, 4) AS ts_num, coalesce(t.den, 4) AS ts_den FROM (SELECT DISTINCT song_id, tick FROM notes) n ASOF LEFT JOIN timesig t ON n.song_id = t.song_id AND n.tick >= t.tick", "notes", "timesig")
def _(v):
    return TP.signatures(notes_of(v).select("song_id", "tick").distinct(), v.timesig)


@query("g1_beat_grid", "SELECT song_id, beat, tick, round(time_s, 6) AS time_s, round(duration_s, 6) AS duration_s, bpm, ts_num, ts_den FROM grid", "grid")
def _(v):
    return grid_of(v).select("song_id", "beat", "tick", _r("time_s"), _r("duration_s"), "bpm", "ts_num", "ts_den")


def own_tempo(v: Views) -> DataFrame:
    """Tempo with two resolutions among the songs."""
    return v.tempo.withColumn("resolution", F.when(F.col("song_id") % 2 == 0, 480).otherwise(192))


_OWN = """tr AS (SELECT *, CASE WHEN song_id % 2 = 0 THEN 480 ELSE 192 END AS r FROM tempo),
sg AS (SELECT song_id, tick AS start_tick, bpm, r, coalesce(sum(d) OVER (PARTITION BY song_id ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS start_s FROM (SELECT *, (lead(tick) OVER (PARTITION BY song_id ORDER BY tick) - tick) / r::DOUBLE * (60.0 / bpm) AS d FROM tr)),
fs AS (SELECT song_id, min(start_tick) AS f_tick, min_by(start_s, start_tick) AS f_s, min_by(bpm, start_tick) AS f_bpm, min(r) AS r FROM sg GROUP BY song_id)"""


@query("g1_own_resolutions", _OWN + """, sp AS (SELECT e.song_id, r, CAST(ceil(f_tick / r::DOUBLE) * r AS INT) AS s, end_tick FROM ends e JOIN fs USING (song_id)), b AS (SELECT song_id, r, CAST(unnest(range(0, (end_tick - s) // r + 1)) AS INT) AS beat, s FROM sp WHERE s <= end_tick),
c AS (SELECT song_id, r, beat, CAST(s + r * beat AS INT) AS tick FROM b)
SELECT c.song_id, beat, c.tick, round(coalesce(g.start_s, f_s) + (c.tick - coalesce(g.start_tick, f_tick)) / c.r::DOUBLE * (60.0 / coalesce(g.bpm, f_bpm)), 6) AS time_s, coalesce(g.bpm, f_bpm) AS bpm FROM c ASOF LEFT JOIN sg g ON g.song_id = c.song_id AND c.tick >= g.start_tick JOIN fs ON fs.song_id = c.song_id""", "ends", "tempo")
def _(v):
    return TP.beat_grid(own_tempo(v), v.timesig, N.song_ends(notes_of(v))).select("song_id", "beat", "tick", _r("time_s"), "bpm")


@query("j2_own_resolutions", _OWN + """ SELECT p.song_id, p.seconds, CAST(coalesce(coalesce(g.start_tick, f_tick) + CAST(round_even((p.seconds - coalesce(g.start_s, f_s)) * coalesce(g.bpm, f_bpm) / 60.0 * fs.r, 0) AS INT), 0) AS INT) AS tick
FROM (SELECT DISTINCT song_id, CAST(tick / 64 AS DOUBLE) + 0.3 AS seconds FROM notes) p ASOF LEFT JOIN sg g ON p.song_id = g.song_id AND p.seconds >= g.start_s LEFT JOIN fs ON fs.song_id = p.song_id""", "notes", "tempo")
def _(v):
    probes = notes_of(v).select("song_id", (F.col("tick") / 64 + 0.3).alias("seconds")).distinct()
    return TP.at_seconds(probes, own_tempo(v)).select("song_id", "seconds", "tick")


@query("f_sql_functions", """SELECT song_id, instrument, tick, substr(md5(instrument || '|' || song_id), 1, 16) AS key, CAST(round_even(tick / 16.0, 0) AS INT) * 16 AS snapped, idx AS sus_index, CAST(steps.s * 16 AS INT) AS sus_ticks, CASE WHEN instrument = 'drums' THEN 91 ELSE 56 END + lane_mask AS token, CAST(len(list_filter(range(5), lambda i: (lane_mask >> i) & 1 = 1)) AS INT) AS lanes, CAST(round_even(tick / 16.0, 0) AS INT) // 48 + CASE WHEN CAST(round_even(tick / 16.0, 0) AS INT) % 48 > 0 THEN 1 ELSE 0 END AS waits
FROM notes n JOIN sus ON q = CAST(round_even(sustain / 16.0, 0) AS INT) JOIN steps ON steps.i = idx""", "notes", "sus")
def _(v):
    SQL.register(v.spark)
    return notes_of(v).selectExpr(
        "song_id", "instrument", "tick", "chord_song_key(instrument, cast(song_id as string)) AS key", "chord_snap_to_grid(tick) AS snapped", "chord_sustain_index(sustain) AS sus_index",
        "chord_sustain_ticks(chord_sustain_index(sustain)) AS sus_ticks", "chord_note_token(lane_mask, instrument = 'drums') AS token", "size(chord_mask_lanes(lane_mask)) AS lanes", "size(chord_wait_tokens(chord_ticks_to_steps(tick))) AS waits")


def sql_views(v: Views) -> None:
    """The functions, and views of a song's rows for SQL."""
    SQL.register(v.spark)
    v.raw.createOrReplaceTempView("chord_raw")
    v.tempo.createOrReplaceTempView("chord_tempo")
    v.timesig.createOrReplaceTempView("chord_timesig")


_LISTS = "tempo_lists AS (SELECT song_id, collect_list(struct(tick, bpm)) AS tempo FROM chord_tempo GROUP BY song_id)"


@query("a1_chords_by_sql", "SELECT * FROM notes", "notes")
def _(v):
    """Chords through SQL alone."""
    sql_views(v)
    return v.spark.sql("SELECT r.song_id, r.instrument, c.* FROM (SELECT song_id, instrument, collect_list(struct(tick, pitch, sustain)) AS events FROM chord_raw GROUP BY song_id, instrument) r, LATERAL chord_chords(r.events) c")


@query("w1_segments_by_sql", "SELECT song_id, start_tick, CAST(lead(start_tick) OVER (PARTITION BY song_id ORDER BY start_tick) AS INT) AS next_tick, round(start_s, 6) AS start_s, bpm FROM seg", "seg")
def _(v):
    sql_views(v)
    return v.spark.sql(f"WITH {_LISTS} SELECT t.song_id, s.start_tick, s.next_tick, round(s.start_s, 6) AS start_s, s.bpm FROM tempo_lists t, LATERAL chord_tempo_segments(t.tempo, {S.RESOLUTION}) s")


@query("g1_grid_by_sql", "SELECT song_id, beat, tick, round(time_s, 6) AS time_s, round(duration_s, 6) AS duration_s, bpm, ts_num, ts_den FROM grid", "grid")
def _(v):
    """Track ends, tempo, signatures and beats through SQL alone."""
    sql_views(v)
    return v.spark.sql(f"""WITH {_LISTS}, sig_lists AS (SELECT song_id, collect_list(struct(tick, num, den)) AS sigs FROM chord_timesig GROUP BY song_id),
    chords AS (SELECT r.song_id, r.instrument, c.tick, c.sustain FROM (SELECT song_id, instrument, collect_list(struct(tick, pitch, sustain)) AS events FROM chord_raw GROUP BY song_id, instrument) r, LATERAL chord_chords(r.events) c),
    ends AS (SELECT song_id, max(e) AS end_tick FROM (SELECT song_id, max_by(tick + sustain, tick) AS e FROM chords GROUP BY song_id, instrument) GROUP BY song_id),
    songs AS (SELECT e.song_id, e.end_tick, t.tempo, coalesce(s.sigs, array()) AS sigs FROM ends e JOIN tempo_lists t USING (song_id) LEFT JOIN sig_lists s USING (song_id))
    SELECT s.song_id, g.beat, g.tick, round(g.time_s, 6) AS time_s, round(g.duration_s, 6) AS duration_s, g.bpm, g.ts_num, g.ts_den FROM songs s, LATERAL chord_beat_grid(s.tempo, s.sigs, s.end_tick, {S.RESOLUTION}) g""")


@query("w5_beat_durations", "SELECT song_id, beat, round(duration_s, 6) AS duration_s FROM grid", "grid")
def _(v):
    return grid_of(v).select("song_id", "beat", _r("duration_s"))


@query("p2_duration_guard", "SELECT song_id, round(max(time_s + duration_s), 6) AS length_s FROM grid GROUP BY song_id HAVING max(time_s + duration_s) <= 120", "grid")
def _(v):
    return TP.within_duration(grid_of(v), 120.0).select("song_id", _r("length_s"))


@query("a6_beat_arrays", "SELECT song_id, count(*) AS num_beats, string_agg(CAST(tick AS VARCHAR), ',' ORDER BY beat) AS ticks, string_agg(CAST(ts_num AS VARCHAR), ',' ORDER BY beat) AS ts_nums FROM grid GROUP BY song_id", "grid")
def _(v):
    rows = grid_of(v).groupBy("song_id").agg(F.count("*").alias("num_beats"), F.array_sort(F.collect_list(F.struct("beat", "tick", "ts_num"))).alias("b"))
    text = lambda f: F.array_join(F.transform("b", lambda x: x[f].cast("string")), ",")
    return rows.select("song_id", "num_beats", text("tick").alias("ticks"), text("ts_num").alias("ts_nums"))


@query("u2_timeline", "SELECT song_id, instrument, tick, pr, count(*) AS n FROM tl GROUP BY ALL", "tl")
def _(v):
    return timeline_of(v).groupBy("song_id", "instrument", "tick", "pr").agg(F.count("*").alias("n"))


@query("w2_gaps", "SELECT song_id, instrument, n, gap FROM tl2", "tl2")
def _(v):
    return timeline_of(v).select("song_id", "instrument", F.col("n").cast("long").alias("n"), "gap")


@query("g2_encode", "SELECT song_id, instrument, array_to_string(tokens, ',') AS tokens, CAST(len(tokens) AS INT) AS num_tokens FROM seqs", "seqs")
def _(v):
    return sequences_of(v).select("song_id", "instrument", F.array_join(F.transform("tokens", lambda x: x.cast("string")), ",").alias("tokens"), "num_tokens")


@query("a5_tokens_long", "SELECT * FROM tok", "tok")
def _(v):
    return codec.exploded(sequences_of(v))


_DECODED = """cur AS (SELECT *, CAST(sum(CASE WHEN tok BETWEEN 9 AND 56 THEN (tok - 8) * 16 ELSE 0 END) OVER w AS INT) AS tick, lead(tok, 1) OVER w AS n1, lead(tok, 2) OVER w AS n2, lead(tok, 3) OVER w AS n3, lead(tok, 4) OVER w AS n4 FROM tok WHERE tok <> 2 AND pos >= 2 WINDOW w AS (PARTITION BY song_id, instrument ORDER BY pos))
"""


@query("g3_decode_notes", _DECODED + """SELECT song_id, instrument, pos, tick, CASE WHEN tok >= 92 THEN tok - 91 ELSE tok - 56 END AS lane_mask, CASE WHEN tok >= 92 THEN 0 ELSE CAST(steps.s * 16 AS INT) END AS sustain,
 tok < 92 AND coalesce(n2 = 88, false) AS is_hopo, tok < 92 AND coalesce(n2 = 89 OR n2 = 88 AND n3 = 89, false) AS is_tap, tok < 92 AND coalesce(n2 = 91 OR n2 BETWEEN 88 AND 91 AND n3 = 91 OR n2 BETWEEN 88 AND 91 AND n3 BETWEEN 88 AND 91 AND n4 = 91, false) AS is_force_strum
FROM cur LEFT JOIN steps ON n1 - 123 = steps.i WHERE tok BETWEEN 57 AND 87 OR tok BETWEEN 92 AND 122""", "tok", "steps")
def _(v):
    return codec.Decoded(codec.exploded(sequences_of(v))).notes.drop("header")


@query("g3_decode_beats", _DECODED + "SELECT song_id, instrument, pos, tick FROM cur WHERE tok = 4", "tok")
def _(v):
    return codec.Decoded(codec.exploded(sequences_of(v))).beats


@query("w9_decode_specials", _DECODED + """, star AS (SELECT *, lead(tok) OVER w AS t2, lead(tick) OVER w AS k2 FROM cur WHERE tok IN (183, 184) WINDOW w AS (PARTITION BY song_id, instrument ORDER BY pos)),
fin AS (SELECT song_id, instrument, max(tick) AS f FROM cur GROUP BY ALL)
SELECT song_id, instrument, tick, 'star_power' AS kind, CASE WHEN t2 = 184 THEN k2 - tick ELSE 0 END AS length FROM star WHERE tok = 183
UNION ALL SELECT song_id, instrument, tick, 'star_power', f - tick FROM star JOIN fin USING (song_id, instrument) WHERE tok = 183 AND t2 IS NULL
UNION ALL SELECT song_id, instrument, tick, CASE tok WHEN 185 THEN 'solo' ELSE 'soloend' END, 0 FROM cur WHERE tok IN (185, 186)""", "tok")
def _(v):
    return codec.Decoded(codec.exploded(sequences_of(v))).specials.drop("ord")


@query("w3_cursor", _DECODED + "SELECT song_id, instrument, pos, tok, tick FROM cur", "tok")
def _(v):
    return codec.cursor(codec.body(codec.exploded(sequences_of(v)))).select("song_id", "instrument", "pos", "tok", "tick")


_AGAIN = """, rn AS (SELECT song_id, instrument, pos, tick, tok, CASE WHEN tok >= 92 THEN [tok] ELSE list_concat(list_concat(list_concat([tok, n1], CASE WHEN n2 = 88 THEN [88] ELSE [] END), CASE WHEN n2 = 89 OR n2 = 88 AND n3 = 89 THEN [89] ELSE [] END), CASE WHEN n2 = 91 OR n2 BETWEEN 88 AND 91 AND n3 = 91 OR n2 BETWEEN 88 AND 91 AND n3 BETWEEN 88 AND 91 AND n4 = 91 THEN [91] ELSE [] END) END AS toks FROM cur WHERE tok BETWEEN 57 AND 87 OR tok BETWEEN 92 AND 122),
star AS (SELECT *, lead(tok) OVER w AS t2, lead(tick) OVER w AS k2 FROM cur WHERE tok IN (183, 184) WINDOW w AS (PARTITION BY song_id, instrument ORDER BY pos)), fin AS (SELECT song_id, instrument, max(tick) AS f FROM cur GROUP BY ALL),
rs AS (SELECT song_id, instrument, tick, 183 AS t, pos AS o, CASE WHEN t2 = 184 THEN k2 - tick ELSE 0 END AS length FROM star WHERE tok = 183 UNION ALL SELECT song_id, instrument, tick, 183, pos + 1000000000, f - tick FROM star JOIN fin USING (song_id, instrument) WHERE tok = 183 AND t2 IS NULL UNION ALL SELECT song_id, instrument, tick, tok, pos, 0 FROM cur WHERE tok IN (185, 186)),
rt AS (SELECT song_id, instrument, tick, 3 AS pr, 0 AS o1, pos AS o2, 0 AS o3, toks FROM rn UNION ALL SELECT song_id, instrument, tick, 0, 0, pos, 0, [4] FROM cur WHERE tok = 4
 UNION ALL SELECT song_id, instrument, tick + CASE WHEN side = 1 THEN length ELSE 0 END, CASE WHEN t = 183 THEN 1 ELSE 2 END, tick, o, side, [t + side] FROM rs, (SELECT unnest([0, 1]) AS side) WHERE side = 0 OR t = 183),
rg AS (SELECT *, greatest(1, CAST(round_even(gap / 16.0, 0) AS INT)) AS st FROM (SELECT *, tick - lag(tick, 1, 0) OVER w AS gap, row_number() OVER w AS n FROM rt WINDOW w AS (PARTITION BY song_id, instrument ORDER BY tick, pr, o1, o2, o3))),
ra AS (SELECT song_id, instrument, flatten(list(CASE WHEN gap > 0 THEN list_concat(list_concat(list_transform(range(st // 48), lambda x: 56), CASE WHEN st % 48 > 0 THEN [8 + st % 48] ELSE [] END), toks) ELSE toks END ORDER BY n)) AS b FROM rg GROUP BY ALL),
rf AS (SELECT s.song_id, s.instrument, tokens AS t, list_concat(list_concat([1, CASE s.instrument WHEN 'bass' THEN 7 WHEN 'drums' THEN 8 ELSE 6 END], b), [2]) AS a FROM seqs s LEFT JOIN ra USING (song_id, instrument))
SELECT song_id, instrument, coalesce(t = a, false) AS same, CAST(coalesce(list_filter(range(0, least(len(t), len(a))), lambda i: t[i + 1] <> a[i + 1])[1], CASE WHEN len(t) <> len(a) THEN least(len(t), len(a)) END) AS INT) AS first_diff, CAST(len(t) AS INT) AS length, CAST(len(a) AS INT) AS back_length FROM rf"""


@query("g4_roundtrip", _DECODED + _AGAIN, "tok")
def _(v):
    return codec.roundtrip(sequences_of(v))


_BEFORE = "CAST(coalesce(sum(CASE WHEN tok = 4 THEN 1 ELSE 0 END) OVER (PARTITION BY song_id, instrument ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT)"


@query("w4_beat_ids", f"SELECT song_id, instrument, pos, {_BEFORE} AS beat_id FROM tok", "tok")
def _(v):
    return codec.beat_numbers(codec.exploded(sequences_of(v))).drop("tok")


@query("w4_beat_ids_clamped", f"SELECT song_id, instrument, pos, least(15, {_BEFORE}) AS beat_id FROM tok", "tok")
def _(v):
    return codec.beat_numbers(codec.exploded(sequences_of(v)), most=15).drop("tok")


_CLASS = "CASE WHEN tok BETWEEN 9 AND 56 THEN 'wait' WHEN tok BETWEEN 57 AND 87 THEN 'note' WHEN tok BETWEEN 92 AND 122 THEN 'drum' WHEN tok BETWEEN 123 AND 182 THEN 'sustain' WHEN tok BETWEEN 88 AND 91 THEN 'modifier' WHEN tok BETWEEN 183 AND 186 THEN 'event' WHEN tok BETWEEN 6 AND 8 THEN 'instrument' WHEN tok = 4 THEN 'beat' ELSE 'special' END"


@query("j9_token_names", f"""SELECT tok, {_CLASS} AS category, count(*) AS n, CASE WHEN tok BETWEEN 9 AND 56 THEN 'WAIT_' || (tok - 8) || '(' || (tok - 8) * 16 || 't)' WHEN tok BETWEEN 123 AND 182 THEN 'SUS_' || s || '(' || s * 16 || 't)'
 WHEN tok BETWEEN 57 AND 87 THEN 'NOTE:' || array_to_string(list_filter(list_transform(range(5), lambda i: CASE WHEN ((tok - 56) >> i) & 1 = 1 THEN 'GRYBO'[i + 1] END), lambda x: x IS NOT NULL), '')
 WHEN tok BETWEEN 92 AND 122 THEN 'DRUM:' || array_to_string(list_filter(list_transform(range(5), lambda i: CASE WHEN ((tok - 91) >> i) & 1 = 1 THEN 'KSHTC'[i + 1] END), lambda x: x IS NOT NULL), '')
 ELSE CASE tok WHEN 1 THEN 'BOS' WHEN 2 THEN 'EOS' WHEN 4 THEN 'BEAT' WHEN 6 THEN 'INSTR:guitar' WHEN 7 THEN 'INSTR:bass' WHEN 8 THEN 'INSTR:drums' WHEN 88 THEN 'MOD:HOPO' WHEN 89 THEN 'MOD:TAP' WHEN 91 THEN 'MOD:STRUM' WHEN 183 THEN 'SP_ON' WHEN 184 THEN 'SP_OFF' WHEN 185 THEN 'SOLO_ON' WHEN 186 THEN 'SOLO_OFF' END END AS name
FROM tok LEFT JOIN steps ON steps.i = tok - 123 GROUP BY tok, s""", "tok", "steps")
def _(v):
    return named(codec.exploded(sequences_of(v)), vocabulary(v.spark)).groupBy("tok", "category", "name").agg(F.count("*").alias("n"))


@query("a19_class_histogram", f"SELECT song_id, instrument, {', '.join(f'count(*) FILTER (WHERE c = {c!r}) AS {c}' for c in ('wait', 'note', 'drum', 'sustain', 'modifier', 'event', 'beat'))} FROM (SELECT *, {_CLASS} AS c FROM tok) GROUP BY ALL", "tok")
def _(v):
    return codec.class_histogram(codec.exploded(sequences_of(v)))


@query("f3_sustain_index", "SELECT n.song_id, n.instrument, n.tick, idx AS sus_index, CAST(steps.s * 16 AS INT) AS sus_ticks FROM notes n JOIN sus ON q = CAST(round_even(sustain / 16.0, 0) AS INT) JOIN steps ON steps.i = idx", "notes", "sus")
def _(v):
    return notes_of(v).withColumn("sus_index", S.sustain_index(F.col("sustain"))).select("song_id", "instrument", "tick", "sus_index", S.sustain_ticks(F.col("sus_index")).alias("sus_ticks"))


@query("f2_snap", "SELECT song_id, tick, CAST(round_even(tick / 16.0, 0) AS INT) AS steps, CAST(round_even(tick / 16.0, 0) AS INT) * 16 AS snapped, count(*) AS n FROM raw GROUP BY ALL", "raw")
def _(v):
    return v.raw.groupBy("song_id", "tick", S.ticks_to_steps(F.col("tick")).alias("steps"), S.snap_to_grid(F.col("tick")).alias("snapped")).agg(F.count("*").alias("n"))


@query("f4_masks", "SELECT lane_mask, array_to_string(list_filter(range(5), lambda i: (lane_mask >> i) & 1 = 1), ',') AS lanes, CASE WHEN instrument = 'drums' THEN 91 ELSE 56 END + lane_mask AS token, count(*) AS n FROM notes GROUP BY ALL", "notes")
def _(v):
    lanes = F.array_join(F.transform(S.mask_lanes(F.col("lane_mask")), lambda i: i.cast("string")), ",")
    return notes_of(v).groupBy("lane_mask", lanes.alias("lanes"), S.note_token(F.col("lane_mask"), S.is_drums(F.col("instrument"))).alias("token")).agg(F.count("*").alias("n"))


@query("f5_waits", "SELECT song_id, instrument, n, array_to_string(list_concat(list_transform(range(st // 48), lambda x: 56), CASE WHEN st % 48 > 0 THEN [8 + st % 48] ELSE [] END), ',') AS waits FROM (SELECT *, greatest(1, CAST(round_even(gap / 16.0, 0) AS INT)) AS st FROM tl2 WHERE gap > 0)", "tl2")
def _(v):
    rows = timeline_of(v).where("gap > 0")
    return rows.select("song_id", "instrument", F.col("n").cast("long").alias("n"), F.array_join(F.transform(codec.gap_tokens(F.col("gap")), lambda x: x.cast("string")), ",").alias("waits"))


@query("p11_track_flags", "SELECT song_id, instrument, coalesce(bool_or(kind = 'star_power'), false) AS has_star_power, coalesce(bool_or(kind = 'solo'), false) AS has_solo FROM (SELECT DISTINCT song_id, instrument FROM notes) LEFT JOIN specials USING (song_id, instrument) GROUP BY ALL", "notes", "specials")
def _(v):
    flags = v.specials.groupBy("song_id", "instrument").agg(F.bool_or(F.col("kind") == "star_power").alias("sp"), F.bool_or(F.col("kind") == "solo").alias("so"))
    rows = N.instruments(notes_of(v)).join(flags.hint("merge"), ["song_id", "instrument"], "left")
    return rows.select("song_id", "instrument", F.coalesce("sp", F.lit(False)).alias("has_star_power"), F.coalesce("so", F.lit(False)).alias("has_solo"))


@query("x1_grammar", "nxt AS (SELECT *, lead(tok) OVER (PARTITION BY song_id, instrument ORDER BY pos) AS n1 FROM tok) SELECT song_id, instrument, count(*) FILTER (WHERE tok BETWEEN 57 AND 87 AND coalesce(n1 NOT BETWEEN 123 AND 182, true)) AS bare_notes, count(*) FILTER (WHERE tok BETWEEN 92 AND 122 AND n1 BETWEEN 123 AND 182) AS drum_sustains FROM nxt GROUP BY ALL", "tok")
def _(v):
    return codec.grammar_issues(codec.exploded(sequences_of(v)))
