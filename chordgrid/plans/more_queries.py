"""Filters, MIDI notes, composite scores and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from chordgrid.functions import scalars as S
from chordgrid.operators import codec, drift, filters, midi as M, notes as N, quality as Q, scoring as SC
from chordgrid.plans.catalog import query
from chordgrid.plans.core_queries import grid_of, notes_of, sequences_of, timeline_of
from chordgrid.plans.data_queries import _DIFF, _VERDICT, wanted_columns
from chordgrid.plans.train_queries import _DMG, damaged
from chordgrid.plans.views import Views, sql_hash

_r = lambda c, n=6: F.round(c, n).alias(c)


@query("p1_required_instruments", "SELECT song_id, instrument, count(*) AS n FROM notes WHERE instrument IN ('guitar', 'drums') GROUP BY ALL", "notes")
def _(v):
    return filters.required_instruments(notes_of(v), ["guitar", "drums"]).groupBy("song_id", "instrument").agg(F.count("*").alias("n"))


@query("p3_skip_reasons", "SELECT s_suppkey AS song_id, CASE WHEN e.song_id IS NULL THEN 'no notes' WHEN t.song_id IS NULL THEN 'no tempo' WHEN end_tick < 7300 THEN 'too short' ELSE 'ok' END AS status FROM supplier LEFT JOIN ends e ON e.song_id = s_suppkey LEFT JOIN (SELECT DISTINCT song_id FROM tempo WHERE bpm > 150) t ON t.song_id = s_suppkey", "ends", "tempo")
def _(v):
    songs = v.table("supplier").select(F.col("s_suppkey").alias("song_id"))
    return filters.skip_reasons(songs, N.song_ends(notes_of(v)), v.tempo.where("bpm > 150"), 7300)


@query("p4_required_features", "SELECT l_suppkey * 100 + l_partkey % 100 AS song_id, count(*) FILTER (WHERE l_linenumber >= 3) AS n FROM lineitem GROUP BY 1 HAVING count(*) FILTER (WHERE l_linenumber >= 3) > 0")
def _(v):
    song = (F.col("l_suppkey") * 100 + F.col("l_partkey") % 100).alias("song_id")
    rows = v.table("lineitem").groupBy(song).agg(F.collect_list(F.when(F.col("l_linenumber") >= 3, F.col("l_partkey"))).alias("features"))
    return filters.with_features(rows, ["features"]).select("song_id", F.size("features").cast("long").alias("n"))


@query("p12_null_tokens", "SELECT count(*) FILTER (WHERE b) AS bad, count(*) AS n FROM (SELECT l_orderkey, bool_or(l_quantity < 2) AS b FROM lineitem GROUP BY 1)")
def _(v):
    rows = v.table("lineitem").groupBy("l_orderkey").agg(F.transform(F.array_agg(F.struct(F.when(F.col("l_quantity") >= 2, 1).alias("t"))), lambda x: x["t"]).alias("tokens"))
    return filters.null_items(rows, "tokens")


@query("p13_trace", """SELECT song_id, instrument, array_to_string((list(tok ORDER BY pos) FILTER (WHERE tok <> 4))[1:40], ',') AS shown, greatest(count(*) FILTER (WHERE tok <> 4) - 40, 0) AS rest, count(*) FILTER (WHERE tok = 4) AS n_hidden FROM tok GROUP BY ALL""", "tok")
def _(v):
    rows = codec.trace(codec.exploded(sequences_of(v)), most=40)
    return rows.withColumn("shown", F.array_join(F.transform("shown", lambda t: t.cast("string")), ","))


def midi_tables(v: Views) -> M.Midi:
    """Driver events as MIDI files of four tracks, two of which are one instrument's, with two resolutions."""
    track = F.element_at(F.array(*map(F.lit, ("PART GUITAR", " Part Bass", "PART DRUMS", "T1 GEMS"))), (F.col("event_id") % 4 + 1).cast("int"))
    kind = F.when(F.col("event_type") == "purchase", F.when(F.col("event_id") % 3 == 0, "time_signature").otherwise("set_tempo")).when(F.col("event_type") == "error", "note_off").otherwise("note_on")
    rows = v.table("events").select(
        F.col("user_id").alias("file"), (F.col("event_id") % 4).cast("int").alias("track_no"), track.alias("track_name"), F.col("event_id").alias("msg_no"), F.floor("value").cast("int").alias("delta"),
        F.when(F.col("user_id") % 2 == 0, 480).otherwise(96).alias("ticks_per_beat"), kind.alias("type"), (94 + F.floor("value").cast("int") % 11).alias("note"), F.when(F.col("event_type") == "signup", 0).otherwise(64).alias("velocity"),
        (300_000 + F.col("event_id")).cast("int").alias("tempo"), (2 + F.col("event_id") % 6).cast("int").alias("num"), F.lit(4).alias("den"))
    return M.Midi(rows)


_MID = """me AS (SELECT user_id AS file, CAST(event_id % 4 AS INT) AS track_no, ['guitar', 'bass', 'drums', 'guitar'][CAST(event_id % 4 + 1 AS INT)] AS instrument, event_id AS msg_no, CASE WHEN user_id % 2 = 0 THEN 480 ELSE 96 END AS tpb,
 CASE event_type WHEN 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN 'time_signature' ELSE 'set_tempo' END WHEN 'error' THEN 'note_off' ELSE 'note_on' END AS type, 94 + CAST(floor(value) AS INT) % 11 AS note, event_type IN ('click', 'view') AS is_on, 300000 + event_id AS tempo, CAST(2 + event_id % 6 AS INT) AS num,
 sum(CAST(floor(value) AS INT)) OVER (PARTITION BY user_id, event_id % 4 ORDER BY event_id) AS t FROM events),
mt AS (SELECT *, CAST(round_even(t * 192 / tpb::DOUBLE, 0) AS INT) AS tick FROM me)"""


@query("g6_midi_notes", f"""WITH RECURSIVE {_MID}, r AS (SELECT *, row_number() OVER (PARTITION BY file, instrument, note ORDER BY track_no, msg_no) AS k FROM mt WHERE type IN ('note_on', 'note_off') AND (instrument <> 'drums' AND note BETWEEN 96 AND 102 OR instrument = 'drums' AND note BETWEEN 95 AND 100)),
walk AS (SELECT DISTINCT file, instrument, note, 0 AS k, CAST([] AS STRUCT(m BIGINT, t INT)[]) AS st, CAST(NULL AS BIGINT) AS on_msg, CAST(NULL AS INT) AS on_t, CAST(NULL AS INT) AS off_t FROM r
UNION ALL SELECT w.file, w.instrument, w.note, r.k, CASE WHEN r.is_on THEN list_append(st, {{'m': r.msg_no, 't': r.tick}}) ELSE st[1:len(st) - 1] END, CASE WHEN NOT r.is_on AND len(st) > 0 THEN st[len(st)].m END, CASE WHEN NOT r.is_on AND len(st) > 0 THEN st[len(st)].t END, CASE WHEN NOT r.is_on AND len(st) > 0 THEN r.tick END
FROM walk w JOIN r ON r.file = w.file AND r.instrument = w.instrument AND r.note = w.note AND r.k = w.k + 1),
p AS (SELECT r.file, r.instrument, CASE WHEN r.instrument = 'drums' THEN greatest(r.note - 96, 0) ELSE r.note - 96 END AS pitch, r.tick, coalesce(w.off_t - w.on_t, 0) AS sustain FROM r LEFT JOIN (SELECT * FROM walk WHERE on_msg IS NOT NULL) w ON w.file = r.file AND w.instrument = r.instrument AND w.note = r.note AND w.on_msg = r.msg_no WHERE r.is_on)
SELECT file AS song_id, instrument, tick, CAST(bit_or(CASE WHEN pitch <= 4 THEN 1 << CAST(pitch AS INT) ELSE 0 END) AS INT) AS lane_mask, max(CASE WHEN pitch <= 4 THEN sustain END) AS sustain, bool_or(pitch = 5) AS is_hopo, bool_or(pitch = 6) AS is_force_strum FROM p GROUP BY ALL HAVING bit_or(CASE WHEN pitch <= 4 THEN 1 << CAST(pitch AS INT) ELSE 0 END) > 0""")
def _(v):
    return midi_tables(v).notes().drop("is_tap")


@query("w8_midi_star_power", f"WITH {_MID}, k AS (SELECT *, lag(is_on) OVER w AS p, lag(tick) OVER w AS s FROM mt WHERE type IN ('note_on', 'note_off') AND note = 103 WINDOW w AS (PARTITION BY file, instrument ORDER BY track_no, msg_no)) SELECT file AS song_id, instrument, s AS tick, 'star_power' AS kind, tick - s AS length FROM k WHERE NOT is_on AND p")
def _(v):
    return midi_tables(v).specials().drop("ord")


@query("f8_midi_tempo", f"WITH {_MID}, f AS (SELECT file, tick, round_even(60000000 / CAST(tempo AS DOUBLE), 6) AS bpm FROM mt WHERE type = 'set_tempo') SELECT file AS song_id, tick, bpm FROM f UNION ALL SELECT DISTINCT file, 0, 120.0 FROM me WHERE file NOT IN (SELECT file FROM f)")
def _(v):
    return midi_tables(v).tempo()


@query("f9_midi_signatures", f"WITH {_MID}, f AS (SELECT file, tick, num, 4 AS den FROM mt WHERE type = 'time_signature') SELECT file AS song_id, tick, num, den FROM f UNION ALL SELECT DISTINCT file, 0, 4, 4 FROM me WHERE file NOT IN (SELECT file FROM f)")
def _(v):
    return midi_tables(v).timesig()


@query("f15_frame_index", "SELECT song_id, beat, CAST(trunc(time_s * 75) AS INT) AS frame FROM (SELECT song_id, beat, round(time_s, 4) + 0.00005 AS time_s FROM grid)", "grid")
def _(v):
    return grid_of(v).select("song_id", "beat", S.frame_index(F.round("time_s", 4) + 0.00005, 75.0).alias("frame"))


@query("f20_milliseconds", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(trunc(l_partkey * 1000 / 44100.0::DOUBLE) AS INT) AS ms FROM lineitem")
def _(v):
    return v.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.sample_ms(F.col("l_partkey"), F.lit(44100.0)).alias("ms"))


@query("g12_scores", _DMG + """, hit AS (SELECT n.song_id, n.instrument, d.tick AS dt FROM notes n LEFT JOIN dm d USING (song_id, instrument, tick, lane_mask)), t AS (SELECT instrument, count(dt) AS tp, count(*) AS n_target FROM hit GROUP BY 1), p AS (SELECT instrument, count(*) AS n_pred FROM dm GROUP BY 1)
SELECT instrument, tp, n_pred, n_target, round(tp / n_pred, 6) AS precision, round(tp / n_target, 6) AS recall, round(2 * tp / (n_pred + n_target), 6) AS f1 FROM t JOIN p USING (instrument)""", "notes")
def _(v):
    out = SC.score(damaged(v), notes_of(v), ["song_id", "instrument"], ["instrument"])
    return out.select("instrument", "tp", "n_pred", "n_target", _r("precision"), _r("recall"), _r("f1"))


@query("x3_sustain_error", _DMG.replace("tick, CASE", "tick, sustain // 2 AS s2, CASE") + """, j AS (SELECT n.song_id, n.instrument, n.tick, abs(n.sustain - d.s2) AS e FROM notes n JOIN dm d USING (song_id, instrument, tick))
SELECT j.song_id, j.instrument, round(avg(e / 192.0 * (60.0 / coalesce(s.bpm, f_bpm, 120.0)) * 1000), 4) AS error_ms FROM j ASOF LEFT JOIN seg s ON s.song_id = j.song_id AND j.tick >= s.start_tick LEFT JOIN first_seg f ON f.song_id = j.song_id GROUP BY ALL""", "notes", "first_seg")
def _(v):
    other = damaged(v).withColumn("sustain", F.floor(F.col("sustain") / 2))
    return SC.sustain_error(other, notes_of(v), v.tempo).withColumn("error_ms", F.round("error_ms", 4))


@query("x4_weighted_f1", _DMG + """, s AS (SELECT n.song_id, n.instrument, count(d.tick) AS tp, count(*) AS nt FROM notes n LEFT JOIN dm d USING (song_id, instrument, tick, lane_mask) GROUP BY ALL), p AS (SELECT song_id, instrument, count(*) AS np FROM dm GROUP BY ALL),
w AS (SELECT song_id, 1 / (1 + stddev_pop(CAST(bpm AS FLOAT))) AS w FROM grid GROUP BY 1) SELECT instrument, round(sum(w * 2 * tp / (np + nt)) / sum(w), 5) AS f1 FROM s JOIN p USING (song_id, instrument) JOIN w USING (song_id) GROUP BY 1""", "notes", "grid")
def _(v):
    f1 = SC.note_f1(damaged(v), notes_of(v), ["song_id", "instrument"])
    return SC.weighted_f1(f1, grid_of(v), ["instrument"]).withColumn("f1", F.round("f1", 5))


@query("k8_metrics", "k AS (SELECT *, CAST(pred = label AS INT) AS hit FROM preds) SELECT instrument AS name, count(*) AS n, round(avg(-logp), 6) AS loss, round(avg(hit), 6) AS token_accuracy, round(exp(avg(-logp)), 6) AS perplexity FROM k GROUP BY 1 UNION ALL SELECT 'total', count(*), round(avg(-logp), 6), round(avg(hit), 6), round(exp(avg(-logp)), 6) FROM k", "preds")
def _(v):
    one = SC.metrics_report(v.preds)
    rows = one.select(F.explode(F.map_concat(F.create_map(F.lit("total"), "total"), "by_instrument")).alias("name", "m"))
    return rows.select("name", F.col("m.n").alias("n"), *[F.round(F.col(f"m.{c}"), 6).alias(c) for c in ("loss", "token_accuracy", "perplexity")])


@query("g11_drift_report", f"""WITH r AS (SELECT vec_id, CASE WHEN label < 5 THEN 'old' ELSE 'new' END AS side, CAST(embedding AS DOUBLE[]) AS v FROM embeddings QUALIFY row_number() OVER (PARTITION BY label < 5 ORDER BY {sql_hash(0, 'vec_id')}, vec_id) <= 800), x AS (SELECT side, vec_id, v, sqrt(list_dot_product(v, v)) AS x FROM r),
st AS (SELECT side, count(*) AS n, avg(x) AS mean, stddev_pop(x) AS std, quantile_cont(x, 0.05) AS p5, quantile_cont(x, 0.95) AS p95 FROM x GROUP BY 1), o AS (SELECT * FROM st WHERE side = 'old'), w AS (SELECT * FROM st WHERE side = 'new'),
e AS (SELECT side, generate_subscripts(v, 1) AS d, unnest(v) AS y FROM r), c AS (SELECT d, avg(y) FILTER (WHERE side = 'old') AS a, avg(y) FILTER (WHERE side = 'new') AS b FROM e GROUP BY d), cc AS (SELECT sum(a * b) / (sqrt(sum(a * a)) * sqrt(sum(b * b)) + 1e-8) AS cos FROM c),
pa AS (SELECT row_number() OVER (ORDER BY {sql_hash(1, 'vec_id')}, vec_id) AS rank, v AS va FROM r WHERE side = 'old'), pb AS (SELECT row_number() OVER (ORDER BY {sql_hash(2, 'vec_id')}, vec_id) AS rank, v AS vb FROM r WHERE side = 'new'),
pc AS (SELECT avg(list_dot_product(va, vb) / (sqrt(list_dot_product(va, va)) * sqrt(list_dot_product(vb, vb)) + 1e-8)) AS pair FROM pa JOIN pb USING (rank)),
k AS (SELECT x, count(*) FILTER (WHERE side = 'old') AS ca, count(*) FILTER (WHERE side = 'new') AS cb FROM x GROUP BY x), k2 AS (SELECT sum(ca) OVER () AS na, sum(cb) OVER () AS nb, sum(ca) OVER (ORDER BY x) AS ra, sum(cb) OVER (ORDER BY x) AS rb FROM k), ks AS (SELECT na, nb, max(abs(ra / na - rb / nb)) AS d FROM k2 GROUP BY ALL),
kt AS (SELECT d, (sqrt(na * nb / (na + nb)) + 0.12 + 0.11 / sqrt(na * nb / (na + nb))) * d AS t FROM ks), kp AS (SELECT d, greatest(0.0, least(1.0, list_sum(list_transform(range(1, 20), lambda i: 2.0 * (CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END) * exp(-2.0 * i * i * t * t))))) AS p FROM kt),
f AS (SELECT o.n AS old_n, w.n AS new_n, o.mean AS old_mean, w.mean AS new_mean, o.p5 AS old_p5, w.p95 AS new_p95, cos, pair, d, p, abs(o.mean - w.mean) AS sh FROM o, w, cc, pc, kp)
SELECT old_n, new_n, round(old_mean, 6) AS old_mean, round(new_mean, 6) AS new_mean, round(old_p5, 6) AS old_p5, round(new_p95, 6) AS new_p95, round(cos, 6) AS cosine, round(pair, 6) AS pair_cosine, round(d, 6) AS d, round(p, 6) AS p, round(sh, 6) AS shift, {_VERDICT} AS verdict FROM f""")
def _(v):
    """Labels below 5 as the days before the cut, against the rest; 800 vectors of each side."""
    rows = v.table("embeddings").select("vec_id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("label")).alias("day"), F.col("embedding").alias("vec"))
    out = drift.embedding_drift(rows, date(2024, 1, 6), 800, key="vec_id")
    return out.select("old_n", "new_n", *[_r(c) for c in ("old_mean", "new_mean", "old_p5", "new_p95", "cosine", "pair_cosine", "d", "p", "shift")], "verdict")


@query("g10_shard_report", f"WITH {_DIFF} SELECT file, issue, count(*) AS columns FROM d WHERE issue IS NOT NULL AND NOT (issue = 'TYPE' AND found = 'timestamp') GROUP BY ALL")
def _(v):
    """The tables' own footers against a wanted schema: what is missing, extra or of another type."""
    return Q.shard_report(v.spark, v.dir, wanted_columns(v))


@query("w11_stop_positions", "SELECT song_id, instrument, CAST(min(pos) FILTER (WHERE tok IN (0, 2) AND pos >= 2) AS INT) AS stop, count(*) AS length FROM tok GROUP BY ALL", "tok")
def _(v):
    return codec.stop_positions(codec.exploded(sequences_of(v)))


@query("l1_timeline_order", "SELECT song_id, instrument, n, tick, pr FROM tl2", "tl2")
def _(v):
    return timeline_of(v).select("song_id", "instrument", F.col("n").cast("long").alias("n"), "tick", "pr")
