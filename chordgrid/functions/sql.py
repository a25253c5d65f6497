"""The scalar rules, chords, tempo segments and beat grids as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from chordgrid.functions import scalars as S

_STEPS = f"concat(sequence(0, {S.MAX_WAIT - 1}), array({', '.join(map(str, S.COARSE_STEPS))}))"

#: name -> (parameters, type, body)
FUNCTIONS = {
    "song_key": ("artist STRING, title STRING", "STRING", "substring(md5(concat(coalesce(artist, ''), '|', coalesce(title, ''))), 1, 16)"),
    "ticks_to_steps": ("ticks BIGINT", "INT", f"cast(rint(ticks / {S.GRID}) as int)"),
    "snap_to_grid": ("ticks BIGINT", "INT", f"cast(rint(ticks / {S.GRID}) as int) * {S.GRID}"),
    "sustain_index": (
        "ticks BIGINT", "INT",
        f"""CASE WHEN cast(rint(ticks / {S.GRID}) as int) < {S.MAX_WAIT} THEN greatest(cast(rint(ticks / {S.GRID}) as int), 0)
        ELSE array_min(transform({_STEPS}, (s, i) -> struct(abs(s - cast(rint(ticks / {S.GRID}) as int)) AS d, i AS i))).i END""",
    ),
    "sustain_ticks": ("index INT", "INT", f"element_at({_STEPS}, index + 1) * {S.GRID}"),
    "mask_lanes": ("mask INT", "ARRAY<INT>", "filter(sequence(0, 4), i -> getbit(mask, i) = 1)"),
    "note_token": ("mask INT, drums BOOLEAN", "INT", f"mask + CASE WHEN drums THEN {S.DRUM_FIRST - 1} ELSE {S.GUITAR_FIRST - 1} END"),
    "wait_tokens": (
        "steps INT", "ARRAY<INT>",
        f"concat(array_repeat({S.WAIT_LAST}, cast(steps div {S.MAX_WAIT} as int)), CASE WHEN steps % {S.MAX_WAIT} > 0 THEN array(steps % {S.MAX_WAIT} + {S.WAIT_FIRST - 1}) ELSE cast(array() as array<int>) END)",
    ),
    "is_wait": ("tok INT", "BOOLEAN", f"tok BETWEEN {S.WAIT_FIRST} AND {S.WAIT_LAST}"),
    "is_note": ("tok INT", "BOOLEAN", f"tok BETWEEN {S.GUITAR_FIRST} AND {S.GUITAR_LAST}"),
    "is_drum": ("tok INT", "BOOLEAN", f"tok BETWEEN {S.DRUM_FIRST} AND {S.DRUM_LAST}"),
    "is_sustain": ("tok INT", "BOOLEAN", f"tok BETWEEN {S.SUS_FIRST} AND {S.SUS_LAST}"),
}


_TEMPO = "tempo ARRAY<STRUCT<tick: INT, bpm: DOUBLE>>"
#: Segments of a tempo list in order: tick, bpm and the seconds at their start.
_SEGMENTS = """aggregate(array_sort(tempo), cast(array() AS ARRAY<STRUCT<tick: INT, bpm: DOUBLE, s: DOUBLE>>), (a, t) -> concat(a, array(named_struct('tick', t.tick, 'bpm', t.bpm,
    's', CASE WHEN size(a) = 0 THEN 0D ELSE element_at(a, -1).s + (t.tick - element_at(a, -1).tick) / resolution * (60D / element_at(a, -1).bpm) END))))"""
#: The segment that a tick is in; before the first one, the first.
_AT = "coalesce(try_element_at(filter(segs, g -> g.tick <= t), -1), segs[0])"
_BEATS = f"""transform(sequence(cast(ceil(segs[0].tick / resolution) * resolution as int), end_tick, resolution), t -> element_at(transform(array({_AT}), g -> named_struct('tick', t, 'bpm', g.bpm,
    'time', g.s + (t - g.tick) / cast(resolution as double) * (60D / g.bpm), 'sig', try_element_at(filter(array_sort(signatures), x -> x.tick <= t), -1))), 1))"""

#: Chords of a list of events: it is sorted, cut where the tick changes, and each part becomes one chord. One expression
#: of the list, as a subquery that groups is joined back to it by all its items, in whatever order each side gathered them.
_CHORDS = """filter(element_at(transform(array(sort_array(coalesce(events, array()))), s -> element_at(transform(array(filter(sequence(0, size(s)), i -> i < size(s) AND (i = 0 OR NOT get(s, i).tick <=> get(s, i - 1).tick))),
    starts -> transform(starts, (a, k) -> element_at(transform(array(slice(s, a + 1, coalesce(try_element_at(starts, k + 2), size(s)) - a)), g -> named_struct('tick', g[0].tick,
    'lane_mask', aggregate(g, 0, (m, e) -> m | CASE WHEN e.pitch BETWEEN 0 AND 4 THEN shiftleft(1, e.pitch) ELSE 0 END), 'sustain', array_max(transform(g, e -> CASE WHEN e.pitch BETWEEN 0 AND 4 THEN e.sustain END)),
    'is_hopo', exists(g, e -> e.pitch <=> 5), 'is_tap', exists(g, e -> e.pitch <=> 7), 'is_force_strum', exists(g, e -> e.pitch <=> 6))), 1))), 1)), 1), c -> c.lane_mask > 0)"""

#: name -> (parameters, columns, body): for use after LATERAL, on lists that a song's rows were gathered in.
TABLE_FUNCTIONS = {
    "chords": (
        "events ARRAY<STRUCT<tick: INT, pitch: INT, sustain: INT>>", "tick INT, lane_mask INT, sustain INT, is_hopo BOOLEAN, is_tap BOOLEAN, is_force_strum BOOLEAN",
        f"SELECT c.tick, c.lane_mask, c.sustain, c.is_hopo, c.is_tap, c.is_force_strum FROM inline({_CHORDS}) AS c",
    ),
    "tempo_segments": (
        f"{_TEMPO}, resolution INT", "start_tick INT, next_tick INT, start_s DOUBLE, bpm DOUBLE",
        f"SELECT n.tick, n.next, n.s, n.bpm FROM inline(element_at(transform(array({_SEGMENTS}), segs -> transform(segs, (g, i) -> named_struct('tick', g.tick, 'next', try_element_at(segs, i + 2).tick, 's', g.s, 'bpm', g.bpm))), 1)) AS n",
    ),
    "beat_grid": (
        f"{_TEMPO}, signatures ARRAY<STRUCT<tick: INT, num: INT, den: INT>>, end_tick INT, resolution INT", "beat INT, tick INT, time_s DOUBLE, duration_s DOUBLE, bpm DOUBLE, ts_num INT, ts_den INT",
        f"""SELECT b.beat, b.tick, b.time, b.duration, b.bpm, b.num, b.den FROM inline(element_at(transform(array({_SEGMENTS}), segs -> CASE WHEN size(segs) = 0 OR ceil(segs[0].tick / resolution) * resolution > end_tick THEN cast(array() as ARRAY<STRUCT<beat: INT, tick: INT, time: DOUBLE, duration: DOUBLE, bpm: DOUBLE, num: INT, den: INT>>)
        ELSE element_at(transform(array({_BEATS}), beats -> transform(beats, (x, i) -> named_struct('beat', i, 'tick', x.tick, 'time', x.time, 'duration', coalesce(try_element_at(beats, i + 2).time - x.time, 60D / x.bpm), 'bpm', x.bpm, 'num', coalesce(x.sig.num, 4), 'den', coalesce(x.sig.den, 4)))), 1) END), 1)) AS b""",
    ),
}


def register(spark: SparkSession, prefix: str = "chord_") -> list[str]:
    """Creates the temporary functions, each with the prefix before its name; returns their names."""
    for name, (params, kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) RETURNS {kind} RETURN {body}")
    for name, (params, columns, body) in TABLE_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({params}) RETURNS TABLE ({columns}) RETURN {body}")
    return [prefix + name for name in [*FUNCTIONS, *TABLE_FUNCTIONS]]
