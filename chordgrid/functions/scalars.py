"""Scalar rules as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ticks of one grid step, and of a quarter note.
GRID, RESOLUTION = 16, 192
#: The longest wait token, and the coarse sustain steps beyond 0..47.
MAX_WAIT = 48
COARSE_STEPS = [54, 60, 66, 72, 78, 84, 90, 96, 110, 120, 144, 165]
#: Token ids.
PAD, BOS, EOS, UNK, BEAT, MEASURE = 0, 1, 2, 3, 4, 5
INSTRUMENT_IDS = {"guitar": 6, "bass": 7, "drums": 8}
WAIT_FIRST, WAIT_LAST = 9, 56
GUITAR_FIRST, GUITAR_LAST, DRUM_FIRST, DRUM_LAST = 57, 87, 92, 122
HOPO, TAP, OPEN, STRUM = 88, 89, 90, 91
SUS_FIRST, SUS_LAST = 123, 182
STAR_ON, STAR_OFF, SOLO_ON, SOLO_OFF = 183, 184, 185, 186
VOCAB_SIZE = 187


def song_key(artist: Column, title: Column) -> Column:
    """First 16 hex digits of the md5 of "artist|title"; null counts as empty."""
    return F.substring(F.md5(F.concat(F.coalesce(artist, F.lit("")), F.lit("|"), F.coalesce(title, F.lit("")))), 1, 16)


def ticks_to_steps(ticks: Column) -> Column:
    """Grid steps, half to even. Not bround(): inside a lambda that one looks up compiled code at every value."""
    return F.rint(ticks / GRID).cast("int")


def snap_to_grid(ticks: Column) -> Column:
    return ticks_to_steps(ticks) * GRID


def sustain_steps() -> Column:
    """The sustain steps by index: 0..47, then the coarse ones."""
    return F.concat(F.sequence(F.lit(0), F.lit(47)), F.array(*[F.lit(s) for s in COARSE_STEPS]))


def sustain_index(ticks: Column) -> Column:
    """Index of the nearest sustain step; a tie takes the lower one, too long a sustain the last. The middles between
    coarse steps are compared in turn, as a list of all steps would be made anew for each note."""
    steps, ladder = ticks_to_steps(ticks), [MAX_WAIT - 1, *COARSE_STEPS]
    index = F.when(steps.isNull(), 0).when(steps < MAX_WAIT, F.greatest(steps, F.lit(0)))
    for i, (low, high) in enumerate(zip(ladder, ladder[1:])):
        index = index.when(steps * 2 <= low + high, MAX_WAIT - 1 + i)
    return index.otherwise(MAX_WAIT - 1 + len(COARSE_STEPS))


def sustain_ticks(index: Column) -> Column:
    return F.element_at(sustain_steps(), index + 1) * GRID


def lane_mask(pitches: Column) -> Column:
    """Bit mask of the lanes 0-4 in an array of pitches."""
    lanes = F.array_distinct(F.filter(pitches, lambda p: p.between(0, 4)))
    return F.aggregate(lanes, F.lit(0), lambda a, p: a + F.expr("1") * F.pow(F.lit(2), p).cast("int"))


def mask_lanes(mask: Column) -> Column:
    return F.filter(F.sequence(F.lit(0), F.lit(4)), lambda i: F.getbit(mask, i) == 1)


def note_token(mask: Column, drums: Column) -> Column:
    return mask + F.when(drums, DRUM_FIRST - 1).otherwise(GUITAR_FIRST - 1)


def wait_tokens(steps: Column) -> Column:
    """The wait tokens of a number of steps: as many longest ones as fit, then the rest."""
    full, rest = F.floor(steps / MAX_WAIT).cast("int"), (steps % MAX_WAIT).cast("int")
    last = F.when(rest > 0, F.array(rest + (WAIT_FIRST - 1))).otherwise(F.array().cast("array<int>"))
    return F.concat(F.array_repeat(F.lit(WAIT_LAST), full), last)


def header_token(instrument: Column) -> Column:
    """The instrument's header token, without its difficulty; unknown ones count as guitar."""
    base = F.substring_index(instrument, "_", 1)
    out = F.lit(INSTRUMENT_IDS["guitar"])
    for name, token in INSTRUMENT_IDS.items():
        out = F.when(base == name, token).otherwise(out)
    return out


def is_drums(instrument: Column) -> Column:
    return instrument.contains("drum")


def is_wait(tok: Column) -> Column:
    return tok.between(WAIT_FIRST, WAIT_LAST)


def is_note(tok: Column) -> Column:
    """Notes of string tracks."""
    return tok.between(GUITAR_FIRST, GUITAR_LAST)


def is_drum(tok: Column) -> Column:
    return tok.between(DRUM_FIRST, DRUM_LAST)


def is_sustain(tok: Column) -> Column:
    return tok.between(SUS_FIRST, SUS_LAST)


def is_modifier(tok: Column) -> Column:
    return tok.between(HOPO, STRUM)


def is_event(tok: Column) -> Column:
    return tok.between(STAR_ON, SOLO_OFF)


def is_instrument(tok: Column) -> Column:
    return tok.isin(*INSTRUMENT_IDS.values())


def token_class(tok: Column) -> Column:
    """Category of a token id."""
    return (
        F.when(is_wait(tok), "wait").when(is_note(tok), "note").when(is_drum(tok), "drum").when(is_sustain(tok), "sustain").when(is_modifier(tok), "modifier")
        .when(is_event(tok), "event").when(is_instrument(tok), "instrument").when(tok == BEAT, "beat").when(tok.between(PAD, MEASURE), "special").otherwise("unknown"))


def midi_tick(tick: Column, ticks_per_beat: Column) -> Column:
    return F.bround(tick * RESOLUTION / ticks_per_beat, 0).cast("int")


def bpm_of_micros(micros: Column) -> Column:
    """Beats a minute of a quarter's microseconds, to 6 decimals."""
    return F.bround(F.lit(6e7) / micros, 6)


def signature_denominator(exponent: Column) -> Column:
    return F.pow(F.lit(2), F.coalesce(exponent, F.lit(2))).cast("int")


def frame_index(seconds: Column, rate: float) -> Column:
    return (seconds * rate).cast("int")


def safe_name(text: Column, longest: int = 50) -> Column:
    """Letters, digits, blank, _ and - of a name, cut and trimmed."""
    return F.trim(F.substring(F.regexp_replace(text, r"[^\p{L}\p{N} _-]", ""), 1, longest))


def difficulty_label(level: Column) -> Column:
    return F.when(level == 0, "easy").when(level == 1, "medium").when(level == 2, "hard").when(level.between(3, 6), "expert").otherwise("unknown")


def difficulty_number(label: Column) -> Column:
    """The number of a difficulty's label, 3 for expert; null for others."""
    return F.when(label == "easy", 0).when(label == "medium", 1).when(label == "hard", 2).when(label == "expert", 3)


def sample_ms(samples: Column, rate: Column) -> Column:
    """Whole milliseconds of a number of samples."""
    return (samples * 1000 / rate).cast("int")


def row_bytes(beats: Column, tokens: Column, dim: int = 768, points: int = 32, bins: int = 128) -> Column:
    """Estimated bytes of a dataset row."""
    return beats.cast("long") * (dim * 4 + points * bins * 4) + tokens.cast("long") * 4 + 512


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def l2_norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a: Column, b: Column, eps: float = 1e-8) -> Column:
    return dot(a, b) / (l2_norm(a) * l2_norm(b) + eps)
