"""Encoding, decoding, tempo and parsing on hand-made songs."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chordgrid.functions import scalars as S
from chordgrid.functions.vocab import vocabulary
from chordgrid.operators import batching as B, codec, frames as FR, midi as M, notes as N, tempo as TP
from chordgrid.sources import charts as C

CHART = """[Song]
{
  Name = "T"
  Artist = "A"
  Resolution = 192
}
[SyncTrack]
{
  0 = TS 4
  0 = B 130000
}
[ExpertSingle]
{
  144 = S 2 1680
  192 = E solo
  240 = N 2 0
  240 = N 6 0
  288 = N 2 0
  288 = N 6 0
  416 = N 3 0
  480 = N 2 224
  480 = N 6 0
}
"""
GOLDEN = [1, 6, 4, 17, 183, 11, 4, 185, 11, 60, 123, 91, 11, 60, 123, 91, 14, 4, 10, 64, 123, 12, 60, 137, 91, 14, 4, 56, 38, 184, 2]


@pytest.fixture(scope="module")
def chart(spark):
    return C.Charts(C.numbered(spark.createDataFrame([("s", CHART)], "path string, text string")))


def encoded(chart):
    notes = chart.notes()
    return codec.encode(notes, chart.specials(), chart.tempo())


def test_golden_sequence(chart):
    row = encoded(chart).first()
    assert row["tokens"] == GOLDEN and row["num_tokens"] == len(GOLDEN)


def test_golden_decodes(chart):
    out = codec.Decoded(codec.exploded(encoded(chart)))
    notes = [(r["tick"], r["lane_mask"], r["sustain"], r["is_force_strum"]) for r in out.notes.orderBy("tick").collect()]
    assert notes == [(240, 4, 0, True), (288, 4, 0, True), (416, 8, 0, False), (480, 4, 224, True)]
    assert [r["tick"] for r in out.beats.orderBy("tick").collect()] == [0, 192, 384, 576]
    assert sorted((r["tick"], r["kind"], r["length"]) for r in out.specials.collect()) == [(144, "star_power", 1680), (192, "solo", 0)]


def test_roundtrip(chart):
    row = codec.roundtrip(encoded(chart)).first()
    assert row["same"] and row["first_diff"] is None


def test_header_and_signature(chart):
    assert chart.header().first()["meta"] == {"name": "T", "artist": "A", "resolution": "192"}
    assert chart.timesig().first()[1:] == (0, 4, 4)


def tokens_of(spark, *sequences):
    return spark.createDataFrame([(str(k), "x", i, t) for k, s in enumerate(sequences) for i, t in enumerate(s)], "song_id string, instrument string, pos int, tok int")


def test_unclosed_star_power_gives_two_rows(spark):
    out = codec.Decoded(tokens_of(spark, [1, 6, 183, 12, 2])).specials.collect()
    assert sorted(r["length"] for r in out) == [0, 64]


def test_drum_header_skips_string_notes(spark):
    out = codec.Decoded(tokens_of(spark, [1, 8, 60, 123, 95, 2], [1, 6, 60, 123, 95, 2])).notes.collect()
    assert sorted((r["song_id"], r["lane_mask"]) for r in out) == [("0", 4), ("1", 4), ("1", 4)]


def test_open_modifier_and_early_end(spark):
    out = codec.Decoded(tokens_of(spark, [1, 6, 57, 124, 90, 88, 0, 57, 123])).notes.collect()
    assert [(r["lane_mask"], r["sustain"], r["is_hopo"]) for r in out] == [(129, 16, True)]


def model_decode(tokens):
    """Plain model of the decoder's notes."""
    i, cursor, out = 0, 0, []
    if tokens[:1] == [1]:
        i = 1
    header = 6
    if i < len(tokens) and tokens[i] in (6, 7, 8):
        header, i = tokens[i], i + 1
    while i < len(tokens) and tokens[i] not in (0, 2):
        t = tokens[i]
        i += 1
        if 9 <= t <= 56:
            cursor += (t - 8) * 16
        elif 57 <= t <= 87 and header != 8:
            sus, mods = 0, set()
            if i < len(tokens) and 123 <= tokens[i] <= 182:
                sus = [*range(48), *S.COARSE_STEPS][tokens[i] - 123] * 16
                i += 1
            while i < len(tokens) and 88 <= tokens[i] <= 91:
                mods.add(tokens[i])
                i += 1
            out.append((cursor, t - 56 + (128 if 90 in mods else 0), sus, 88 in mods, 89 in mods, 91 in mods))
        elif 92 <= t <= 122:
            out.append((cursor, t - 91, 0, False, False, False))
    return sorted(out)


def test_decoder_matches_a_plain_model(spark):
    rng = random.Random(5)
    pool = [*range(9, 20), *range(57, 70), *range(88, 100), *range(123, 130), 182, 4, 5, 3, 183, 184]
    sequences = [[1, rng.choice([6, 7, 8, 60])] + [rng.choice(pool) for _ in range(rng.randrange(40))] + [rng.choice([2, 0, 60])] for _ in range(120)]
    found = {}
    for r in codec.Decoded(tokens_of(spark, *sequences)).notes.collect():
        found.setdefault(int(r["song_id"]), []).append((r["tick"], r["lane_mask"], r["sustain"], r["is_hopo"], r["is_tap"], r["is_force_strum"]))
    for k, s in enumerate(sequences):
        assert sorted(found.get(k, [])) == model_decode(s), s


def test_vocabulary(spark):
    rows = {r["tok"]: r for r in vocabulary(spark).collect()}
    assert len(rows) == 187 and rows[56]["wait_steps"] == 48 and rows[182]["sus_steps"] == 165
    assert rows[87]["name"] == "NOTE:GRYBO" and rows[92]["name"] == "DRUM:K" and rows[9]["name"] == "WAIT_1(16t)"


def test_rounding_is_half_even_and_sustains_clamp(spark):
    rows = spark.createDataFrame([(8,), (24,), (40,), (752,), (816,), (912,), (9999,)], "t int").select(S.ticks_to_steps(F.col("t")).alias("s"), S.sustain_index(F.col("t")).alias("i")).collect()
    assert [r["s"] for r in rows][:3] == [0, 2, 2]
    assert [r["i"] for r in rows][3:] == [47, 48, 48, 59]  # 57 steps lie between 54 and 60: the lower index


def test_waits_split_at_the_longest(spark):
    rows = spark.createDataFrame([(1,), (48,), (49,), (100,)], "s int").select(S.wait_tokens(F.col("s")).alias("w")).collect()
    assert [r["w"] for r in rows] == [[9], [56], [56, 9], [56, 56, 12]]


def walked_beats(tempo, end, res):
    out, tick = [], None
    for i, at in enumerate(tempo):
        stop = tempo[i + 1] if i + 1 < len(tempo) else end + res
        tick = 0 if at == 0 else (out[-1] + res if out else 0)
        while tick < at:
            tick += res
        while tick < stop and tick <= end:
            out.append(tick)
            tick += res
    return sorted(set(out))


def test_beat_grid_is_what_a_walk_gives(spark):
    rng = random.Random(3)
    songs = {k: (sorted(rng.sample(range(0, 3000), rng.randrange(1, 5))), rng.randrange(0, 4000)) for k in range(60)}
    tempo = spark.createDataFrame([(k, t, 120.0) for k, (ts, _) in songs.items() for t in ts], "song_id int, tick int, bpm double")
    ends = spark.createDataFrame([(k, e) for k, (_, e) in songs.items()], "song_id int, end_tick int")
    found = {}
    for r in TP.beat_ticks(tempo, ends).collect():
        found.setdefault(r["song_id"], []).append(r["tick"])
    for k, (ts, e) in songs.items():
        assert sorted(found.get(k, [])) == walked_beats(ts, e, 192)


def test_ticks_before_the_first_tempo_extrapolate(spark):
    tempo = spark.createDataFrame([("a", 192, 60.0)], "song_id string, tick int, bpm double")
    probes = spark.createDataFrame([("a", 0), ("a", 384), ("b", 10)], "song_id string, tick int")
    rows = {(r["song_id"], r["tick"]): (r["time_s"], r["bpm"]) for r in TP.at_ticks(probes, tempo).collect()}
    assert rows == {("a", 0): (-1.0, 60.0), ("a", 384): (1.0, 60.0), ("b", 10): (0.0, 120.0)}


def test_offs_close_the_latest_on(spark):
    rng = random.Random(9)
    streams = {k: [(rng.random() < 0.5, i * 10) for i in range(rng.randrange(1, 25))] for k in range(50)}
    rows = spark.createDataFrame([(k, i, t, on) for k, s in streams.items() for i, (on, t) in enumerate(s)], "k int, n int, tick int, on boolean")
    found = {(r["k"], r["n"]): r["sustain"] for r in M.pair_notes(rows, ["k"], "tick", "n", "on").collect()}
    for k, s in streams.items():
        stack, want = [], {}
        for i, (on, t) in enumerate(s):
            if on:
                stack.append(i)
                want[i] = 0
            elif stack:
                at = stack.pop()
                want[at] = t - s[at][1]
        assert {n: v for (kk, n), v in found.items() if kk == k} == want


def test_beats_past_the_frames_pool_to_zero(spark):
    frames = spark.createDataFrame([("a", i, [1.0 if i < 50 else 0.0]) for i in range(100)], "song_id string, frame int, vec array<double>")
    beats = spark.createDataFrame([("a", i, i * 0.5, 0.5) for i in range(4)], "song_id string, beat int, time_s double, duration_s double")
    rows = {r["beat"]: r["vec"][0] for r in FR.pool_beats(beats, frames, 100.0, 1).collect()}
    assert rows[0] > 0.95 and rows[3] == 0.0


def test_resampling_has_the_asked_shape(spark):
    frames = spark.createDataFrame([("a", i, [float(i), 0.0]) for i in range(100)], "song_id string, frame int, vec array<double>")
    beats = spark.createDataFrame([("a", 0, 0.0, 0.1), ("a", 1, 5.0, 0.1)], "song_id string, beat int, time_s double, duration_s double")
    rows = {r["beat"]: r["grid"] for r in FR.resample_beats(beats, frames, 100.0, 5, 2).collect()}
    assert [p[0] for p in rows[0]] == [0.0, 2.5, 5.0, 7.5, 10.0] and rows[1] == [[0.0, 0.0]] * 5


def test_solos_of_the_song_go_to_tracks_above(spark):
    text = "[ExpertSingle]\n0 = N 0 0\n[Events]\n96 = E \"solo\"\n[ExpertDrums]\n0 = N 0 0"
    rows = C.Charts(C.numbered(spark.createDataFrame([("s", text)], "path string, text string"))).specials().collect()
    assert [(r["instrument"], r["kind"]) for r in rows] == [("guitar", "solo")]


def test_rendering_then_parsing_keeps_notes(spark, chart):
    notes = chart.notes()
    meta = spark.createDataFrame([("s", "T", "A")], "song_id string, name string, artist string")
    text = C.render_charts(meta, chart.tempo(), chart.timesig(), notes).select(F.col("song_id").alias("path"), "text")
    again = C.Charts(C.numbered(text)).notes()
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, notes.collect()))


ODD = """  [song]
{
Resolution=480
  Name = "Quoted "Title""
  year =
  two words = x
}
[SyncTrack] trailing
{
  0 = TS 6 3
  0 = B 120000
  +5 = B 1000
  480 = B fast
  960=B 60000 junk
}
[ExpertSingle]
{
  0 = N 0 0
   7 = E "solo"
  9 = E soloend
  10 = E lyric
  480 = N 1 240 extra
  481 = N 1
  482 = X 1 2
  483 = S 2 48
  484 = S 1 48
  no line
  = N 1 1
}
[Unknown Section]
  485 = N 3 3
[Events]
{
  11 = E "section verse 1"
  12 = E solo
}
"""


@pytest.fixture(scope="module")
def odd(spark):
    return C.Charts(C.numbered(spark.createDataFrame([("s", ODD), ("t", CHART)], "path string, text string")))


def test_lines_are_read_by_their_form(odd):
    rows = lambda df, *c: sorted(tuple(r[x] for x in c) for r in df.where("song_id = 's'").collect())
    # a header of two words is none: its lines belong to the section above
    assert rows(odd.raw_notes(), "tick", "pitch", "sustain") == [(0, 0, 0), (480, 1, 240), (485, 3, 3)]
    assert rows(odd.tempo(), "tick", "bpm", "resolution") == [(0, 120.0, 480), (960, 60.0, 480)]
    assert rows(odd.timesig(), "tick", "num", "den") == [(0, 6, 8)]
    assert rows(odd.specials(), "tick", "kind", "length") == [(7, "solo", 0), (9, "soloend", 0), (12, "solo", 0), (483, "star_power", 48)]
    assert rows(odd.section_events(), "tick", "text") == [(11, "section verse 1"), (12, "solo")]
    assert odd.header().where("song_id = 's'").first()["meta"] == {"resolution": "480", "name": 'Quoted "Title'}


def test_songs_keep_their_own_resolution(odd):
    ends = N.song_ends(odd.notes())
    grid = {(r["song_id"], r["beat"]): r for r in TP.beat_grid(odd.tempo(), odd.timesig(), ends).collect()}
    assert [grid["s", b]["tick"] for b in (0, 1)] == [0, 480] and grid["s", 1]["time_s"] == 0.5
    assert grid["t", 1]["tick"] == 192 and abs(grid["t", 1]["time_s"] - 60 / 130) < 1e-9


def test_ini_rules(spark):
    text = "[Song]\nNAME = a=b\nfive_lane_drums = FALSE\npro_drums = false\nyear = 19x\nsong_length = bad\nsong_length_ms = 7\n;x = 1\n#y=2\ndelay = 5"
    r = C.ini_metadata(C.numbered(spark.createDataFrame([("s", text)], "path string, text string"))).first()
    assert (r["name"], r["five_lane_drums"], r["pro_drums"], r["year"], r["song_length_ms"], r["delay_ms"]) == ("a=b", True, False, 0, 0, 5)
    assert r["extra"][";x"] == "1" and r["extra"]["#y"] == "2" and r["extra"]["name"] == "a=b" and r["diff_guitar"] == -1


def test_midi_tracks_of_one_name_pair_together(spark):
    on, off = ("note_on", 64), ("note_on", 0)
    rows = [("PART GUITAR", 0, 0, on, 96), ("PART GUITAR", 0, 480, on, 96), ("t1 gems ", 1, 960, off, 96), ("t1 gems ", 1, 480, ("note_off", 0), 96), ("PART DRUMS", 2, 0, on, 95), ("PART DRUMS", 2, 10, off, 95),
            ("PART GUITAR", 0, 0, on, 103), ("PART GUITAR", 0, 96, off, 103), ("Venue", 3, 0, on, 96), ("PART GUITAR", 0, 0, on, 110)]
    events = spark.createDataFrame([("f", t, name, i, d, 480, k[0], p, k[1], None, None, None) for i, (name, t, d, k, p) in enumerate(rows)],
                                   "file string, track_no int, track_name string, msg_no int, delta int, ticks_per_beat int, type string, note int, velocity int, tempo int, num int, den int")
    midi = M.Midi(events)
    assert sorted((r["instrument"], r["tick"], r["pitch"], r["sustain"]) for r in midi.raw_notes().collect()) == [("drums", 0, 0, 4), ("guitar", 0, 0, 576), ("guitar", 192, 0, 192)]
    assert [(r["tick"], r["length"]) for r in midi.specials().collect()] == [(192, 38)]
    assert midi.tempo().first()["bpm"] == 120.0 and midi.timesig().first()["den"] == 4


def test_beat_ids_count_the_beats_before(spark):
    rows = spark.createDataFrame([([1, 6, 4, 9, 57, 123, 4, 57, 2],), ([4, 4],), ([1],), ([],)], "tokens array<int>")
    assert [r[0] for r in rows.select(B.beat_ids(F.col("tokens"))).collect()] == [[0, 0, 0, 1, 1, 1, 1, 2, 2], [0, 1], [0], []]
    assert rows.select(B.beat_ids(F.col("tokens"), most=1)).first()[0] == [0, 0, 0, 1, 1, 1, 1, 1, 1]


def test_collated_rows_are_padded_with_their_defaults(spark):
    kind = "song_id int, instrument string, difficulty int, tokens array<int>, mert_embeddings array<array<float>>, logmel_frames array<array<array<float>>>, bpm_at_beat array<float>, time_sig_num_at_beat array<int>, time_sig_den_at_beat array<int>, beat_durations_s array<float>"
    rows = spark.createDataFrame([(1, "drums", 9, [1, 4, 57], [[1.0, 2.0, 3.0]], [[[1.0], [2.0]]], [90.0, 91.0], [3, 3], [8, 8], [0.1, 0.2]), (2, "keys", None, [1], None, None, None, None, None, None)], kind)
    out = {r["song_id"]: r for r in B.collated(rows.withColumn("g", F.lit(1)), 8, ["g"], ["song_id"], dim=2, points=2, bins=1).collect()}
    a, b = out[1], out[2]
    assert (a["tokens"], a["mask"], a["beat_ids"]) == ([1, 4, 57], [1, 1, 1], [0, 0, 1]) and (b["tokens"], b["mask"], b["beat_ids"]) == ([1, 0, 0], [1, 0, 0], [0, 0, 0])
    assert a["mert_embeddings"] == [[1.0, 2.0]] and b["mert_embeddings"] == [[0.0, 0.0]] and b["logmel_frames"] == [[[0.0], [0.0]]]
    assert (a["beat_mask"], b["beat_mask"], a["bpm_at_beat"], b["bpm_at_beat"]) == ([1], [0], [90.0], [120.0]) and b["beat_durations_s"] == [0.5] and b["time_sig_num_at_beat"] == [4]
    assert (a["instrument_id"], a["difficulty_id"], b["instrument_id"], b["difficulty_id"]) == (2, 6, 0, 0)


def test_ranks_are_those_of_one_window(spark):
    rows = spark.range(800).select("id", (F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 != 0, F.col("id") * 31 % 97).alias("x"))
    got = {r["id"]: (r["rank"], r["n"]) for r in B.ranked(rows, ["g"], ["x", "id"]).collect()}
    w = Window.partitionBy("g")
    want = {r["id"]: (r["r"], r["n"]) for r in rows.select("id", F.row_number().over(w.orderBy("x", "id")).alias("r"), F.count("*").over(w).alias("n")).collect()}
    assert got == want


def test_shuffled_rows_keep_shards_together_and_follow_the_seed(spark):
    rows = spark.range(200).select("id", (F.col("id") % 9).alias("s"))
    order = lambda **k: [(r["s"], r["id"]) for r in B.shuffled(rows, ["id"], **k).collect()]
    one = order(seed=1, shard="s")
    runs = [s for i, (s, _) in enumerate(one) if i == 0 or one[i - 1][0] != s]
    assert len(runs) == 9 and one == order(seed=1, shard="s") and one != order(seed=1, epoch=1, shard="s")
    assert sorted(one) == sorted(order(seed=2)) and order(seed=2) != order(seed=3)


def test_encoding_reads_notes_once_and_decoding_sorts_once(spark, chart, tmp_path):
    notes = chart.notes().select("song_id", "instrument", "tick", "lane_mask", "sustain", "is_hopo", "is_tap", "is_force_strum")
    for name, df in (("notes", notes), ("specials", chart.specials()), ("tempo", chart.tempo())):
        df.write.parquet(str(tmp_path / name))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    plan = codec.encode(read("notes"), read("specials"), read("tempo"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("/notes") <= 1 and sum("Relation" in line for line in plan.splitlines()) == 3 and plan.count("Window ") == 1
    sequences = codec.encode(read("notes"), read("specials"), read("tempo"))
    sequences.write.parquet(str(tmp_path / "seq"))
    plan = codec.Decoded(codec.exploded(read("seq"))).notes._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window ") <= 6
