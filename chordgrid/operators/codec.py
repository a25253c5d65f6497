"""Tracks as token sequences and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chordgrid.functions import scalars as S
from chordgrid.operators.tempo import beat_spans
from chordgrid.sources.folders import kept, scratch_folder

TRACK = ["song_id", "instrument"]
NO_TOKENS = "array<int>"


#: An event of a track: its place in the order, and its tokens.
EVENT = "array<struct<tick: int, pr: int, o1: bigint, o2: bigint, o3: bigint, toks: array<int>>>"


def _event(tick: Column, pr: int, toks: Column, o1: Column | int = 0, o2: Column | int = 0, o3: Column | int = 0) -> Column:
    """At one tick beats (0) come first, then star power, solos and notes; equal ones keep their file order."""
    number = lambda c: (F.lit(c) if isinstance(c, int) else c).cast("long")
    return F.struct(tick.cast("int").alias("tick"), F.lit(pr).alias("pr"), number(o1).alias("o1"), number(o2).alias("o2"), number(o3).alias("o3"), toks.cast(NO_TOKENS).alias("toks"))


def note_tokens() -> Column:
    """A note's own token and those that follow it: its sustain and modifiers; drums have neither."""
    flag = lambda c, t: F.when(F.col(c), F.array(F.lit(t))).otherwise(F.array().cast(NO_TOKENS))
    strings = F.concat(F.array(S.note_token(F.col("lane_mask"), F.lit(False)), S.sustain_index(F.col("sustain")) + S.SUS_FIRST), flag("is_hopo", S.HOPO), flag("is_tap", S.TAP), flag("is_force_strum", S.STRUM))
    return F.when(S.is_drums(F.col("instrument")), F.array(S.note_token(F.col("lane_mask"), F.lit(True)))).otherwise(strings)


def note_event() -> Column:
    return _event(F.col("tick"), 3, note_tokens())


def special_events() -> Column:
    """The events of a special: star power begins and ends, solos are two specials."""
    one = lambda at, pr, tok, side: _event(at, pr, F.array(F.lit(tok)), F.col("tick"), F.col("ord"), side)
    tick = F.col("tick")
    rows = F.when(F.col("kind") == "star_power", F.array(one(tick, 1, S.STAR_ON, 0), one(tick + F.col("length"), 1, S.STAR_OFF, 1)))
    return rows.when(F.col("kind") == "solo", F.array(one(tick, 2, S.SOLO_ON, 0))).when(F.col("kind") == "soloend", F.array(one(tick, 2, S.SOLO_OFF, 0)))


def tracks(notes: DataFrame, parts: int | None = None) -> DataFrame:
    """song_id, instrument, events (of the notes, unordered), end_tick of the song: the latest end of its tracks'
    last notes. One song's tracks meet in one task from here on, and stay there: ``parts`` tasks, or as many as
    the session's shuffles have."""
    notes = notes.repartition(parts or int(notes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "song_id")  # by number: tokens are many times what is shuffled here
    event = F.when(F.col("lane_mask") > 0, note_event())
    notes = notes.select(*TRACK, "tick", "sustain", event.alias("event"))  # compiled there, not in the aggregate
    own = notes.groupBy(*TRACK).agg(F.collect_list("event").alias("events"), F.max_by(F.col("tick") + F.col("sustain"), "tick").alias("last"))
    return own.withColumn("end_tick", F.max("last").over(Window.partitionBy("song_id"))).drop("last")


def events(notes: DataFrame, specials: DataFrame, tempo: DataFrame | None = None, resolution: int = S.RESOLUTION, parts: int | None = None) -> DataFrame:
    """song_id, instrument, events in order: notes, specials of tracks with notes, and, where a tempo is given,
    the beats that the track's song has. Notes are read once, no beat is joined to a track, and all joins are by
    song, so events are not shuffled again."""
    rows = tracks(notes, parts)
    own = specials.groupBy("song_id").agg(F.collect_list(F.struct(F.col("instrument").alias("of"), special_events().alias("es"))).alias("all_specials"))
    rows = rows.join(own.hint("merge"), "song_id", "left")
    more = F.flatten(F.transform(F.filter("all_specials", lambda x: (x["of"] == F.col("instrument")) & x["es"].isNotNull()), lambda x: x["es"]))
    beats = F.lit(None).cast(EVENT)
    if tempo is not None:
        rows = rows.join(beat_spans(tempo, resolution).hint("merge"), "song_id", "left")
        beats = beat_events()
    return rows.select(*TRACK, ordered(F.col("events"), more, beats).alias("events"))


def beat_events() -> Column:
    """A song's beats, ``step`` ticks apart, from ``first_beat`` to ``end_tick``."""
    ticks = F.sequence("first_beat", F.col("end_tick").cast("int"), "step")
    return F.when(F.col("first_beat") <= F.col("end_tick"), F.transform(ticks, lambda t: _event(t, 0, F.array(F.lit(S.BEAT)))))


def ordered(*lists: Column) -> Column:
    """The events of some lists, null ones included, in order."""
    return F.sort_array(F.concat(*[F.coalesce(c.cast(EVENT), F.array().cast(EVENT)) for c in lists]))  # no item is null


def timeline(notes: DataFrame, specials: DataFrame, tempo: DataFrame | None = None, resolution: int = S.RESOLUTION, parts: int | None = None) -> DataFrame:
    """song_id, instrument, n, tick, pr, gap, toks: all events of a track, numbered from 1 in their order, with the
    ticks since the one before."""
    rows = events(notes, specials, tempo, resolution, parts).select(*TRACK, gapped("events").alias("events"))
    long = rows.select(*TRACK, F.posexplode_outer("events").alias("n", "e")).where("n is not null")  # outer: no filter that computes them twice
    return long.select(*TRACK, (F.col("n") + 1).alias("n"), "e.tick", "e.pr", "e.gap", "e.toks")


def gapped(events: str) -> Column:
    """Ordered events with the gap since the one before, or since tick 0. The array is computed once a row,
    wherever the optimizer puts its expression."""
    def one(array: Column) -> Column:
        gap = lambda e, i: e["tick"] - F.coalesce(F.get(array, i - 1)["tick"], F.lit(0))
        return F.transform(array, lambda e, i: F.struct(e["tick"].alias("tick"), e["pr"].alias("pr"), gap(e, i).alias("gap"), e["toks"].alias("toks")))

    return F.transform(F.array(events), one)[0]


def gap_tokens(gap: Column) -> Column:
    """A gap becomes wait tokens, at least one; no gap none. Most are one token, which is made of few expressions, as
    each costs time in a lambda."""
    steps = F.greatest(S.ticks_to_steps(gap), F.lit(1))
    one = gap < (2 * S.MAX_WAIT - 1) * S.GRID // 2  # its steps, half to even, are below the longest wait
    return F.when(gap > 0, F.when(one, F.array(steps + (S.WAIT_FIRST - 1))).otherwise(S.wait_tokens(steps))).otherwise(F.array().cast(NO_TOKENS))


def token_columns() -> list[list[Column]]:
    """What :func:`as_tokens` selects, one selection after the other."""
    body = F.flatten(F.transform(gapped("events"), lambda e: F.when(e["gap"] > 0, F.concat(gap_tokens(e["gap"]), e["toks"])).otherwise(e["toks"])))
    tokens = F.concat(F.array(F.lit(S.BOS), S.header_token(F.col("instrument"))), body, F.array(F.lit(S.EOS)))
    track = [F.col(c) for c in TRACK]
    return [[*track, tokens.alias("tokens")], [*track, F.col("tokens"), F.size("tokens").alias("num_tokens")]]


def as_tokens(rows: DataFrame) -> DataFrame:
    """song_id, instrument, tokens, num_tokens of rows with ordered events."""
    for columns in token_columns():
        rows = rows.select(*columns)
    return rows


def encode(notes: DataFrame, specials: DataFrame, tempo: DataFrame | None = None, resolution: int = S.RESOLUTION, parts: int | None = None) -> DataFrame:
    """song_id, instrument, tokens, num_tokens; with beats where a tempo is given."""
    return as_tokens(events(notes, specials, tempo, resolution, parts))


def exploded(sequences: DataFrame) -> DataFrame:
    """song_id, instrument, pos, tok of sequences with a tokens array."""
    # an inner explode would filter by the arrays' size first, and so compute them twice
    return sequences.select(*TRACK, F.posexplode_outer("tokens").alias("pos", "tok")).where("pos is not null")


def body(tokens: DataFrame) -> DataFrame:
    """Long tokens (song_id, instrument, pos, tok) from behind the header up to the first end or pad token, with
    ``head``, the header's token if there is one."""
    by = Window.partitionBy(*TRACK).orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # the order that others sort by
    at = lambda p: F.max(F.when(F.col("pos") == p, F.col("tok"))).over(by)
    stop = lambda p: F.min(F.when(F.col("tok").isin(S.EOS, S.PAD) & (F.col("pos") >= p), F.col("pos"))).over(by)
    rows = tokens.withColumns({**{f"t{p}": at(p) for p in (0, 1)}, **{f"s{p}": stop(p) for p in (0, 1, 2)}})
    lead = F.coalesce(F.col("t0") == S.BOS, F.lit(False))
    head = F.when(lead, F.col("t1")).otherwise(F.col("t0"))
    start = lead.cast("int") + F.when(head.between(6, 8), 1).otherwise(0)
    end = F.when(start == 0, F.col("s0")).when(start == 1, F.col("s1")).otherwise(F.col("s2"))
    inside = (F.col("pos") >= start) & (end.isNull() | (F.col("pos") < end))
    return rows.withColumn("head", head).where(inside).drop("t0", "t1", "s0", "s1", "s2")


def cursor(rows: DataFrame) -> DataFrame:
    """Long tokens with ``tick``: what the wait tokens up to there add up to."""
    tok = F.col("tok")
    step = F.when(tok.between(S.WAIT_FIRST, S.WAIT_LAST), (tok - (S.WAIT_FIRST - 1)) * S.GRID).otherwise(0)
    return rows.withColumn("tick", F.sum(step).over(Window.partitionBy(*TRACK).orderBy("pos")).cast("int"))


def stop_positions(tokens: DataFrame) -> DataFrame:
    """song_id, instrument, stop, length: where a sequence with start and header token ends, and its length."""
    stop = F.min(F.when(F.col("tok").isin(S.PAD, S.EOS) & (F.col("pos") >= 2), F.col("pos")))
    return tokens.groupBy(*TRACK).agg(stop.alias("stop"), F.count("*").alias("length"))


def beat_numbers(tokens: DataFrame, most: int | None = None) -> DataFrame:
    """Long tokens with ``beat_id``: beat tokens before them; larger numbers than ``most`` become that one."""
    before = Window.partitionBy(*TRACK).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum((F.col("tok") == S.BEAT).cast("int")).over(before), F.lit(0)).cast("int")
    return tokens.withColumn("beat_id", number if most is None else F.least(number, F.lit(most)))


#: Categories that a histogram counts.
CLASSES = ["wait", "note", "drum", "sustain", "modifier", "event", "beat"]


def class_histogram(tokens: DataFrame) -> DataFrame:
    """song_id, instrument and how many tokens of each category a sequence has."""
    rows = tokens.withColumn("_c", S.token_class(F.col("tok")))
    return rows.groupBy(*TRACK).pivot("_c", CLASSES).count().na.fill(0, CLASSES)


def trace(tokens: DataFrame, hidden: int = S.BEAT, most: int = 200) -> DataFrame:
    """song_id, instrument, shown (the first tokens but the hidden one, as a list), rest (how many more there
    are), n_hidden."""
    order = Window.partitionBy(*TRACK).orderBy("pos")
    seen = (F.col("tok") != hidden).cast("int")
    rows = tokens.withColumn("_nth", F.sum(seen).over(order))
    shown = F.array_sort(F.collect_list(F.when((F.col("tok") != hidden) & (F.col("_nth") <= most), F.struct("pos", "tok"))))
    return rows.groupBy(*TRACK).agg(F.transform(shown, lambda x: x["tok"]).alias("shown"), F.greatest(F.sum(seen) - most, F.lit(0)).alias("rest"), F.count_if(F.col("tok") == hidden).alias("n_hidden"))


def grammar_issues(tokens: DataFrame) -> DataFrame:
    """song_id, instrument, bare_notes (string notes without a sustain behind them), drum_sustains (drum notes
    with one)."""
    rows = tokens.withColumn("_next", F.lead("tok").over(Window.partitionBy(*TRACK).orderBy("pos")))
    sus, tok = F.coalesce(F.col("_next").between(S.SUS_FIRST, S.SUS_LAST), F.lit(False)), F.col("tok")
    return rows.groupBy(*TRACK).agg(F.count_if(S.is_note(tok) & ~sus).alias("bare_notes"), F.count_if(S.is_drum(tok) & sus).alias("drum_sustains"))


class Decoded:
    """``notes``, ``specials`` and ``beats`` of long tokens (song_id, instrument, pos, tok); ``instrument``
    stays the sequence's own name, ``header`` is what its header token says.

    Three windows over one order of a track's tokens: bounds, running sums, and the next token that is no
    modifier. A note's modifiers are those that its sums and the next one's differ in. With a folder the decoded
    rows are written there, for readers of several parts.
    """

    def __init__(self, tokens: DataFrame, folder: str | None = None):
        order = Window.partitionBy(*TRACK).orderBy("pos")
        by = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # all windows share one sort
        tok = F.col("tok")
        rows = cursor(body(tokens)).withColumn("header", F.when(F.col("head") == 7, "bass").when(F.col("head") == 8, "drums").otherwise("guitar"))
        rows = rows.withColumn("next", F.lead("tok").over(order)).withColumn("final", F.max("tick").over(by))
        mods = {"hopo": S.HOPO, "tap": S.TAP, "open": S.OPEN, "strum": S.STRUM}
        upto = {f"_{name}": F.sum((tok == code).cast("int")).over(order) for name, code in mods.items()}
        rows = rows.withColumns(upto).withColumns({f"{c}_all": F.max(c).over(by) for c in upto})
        rows = rows.where(~tok.between(S.HOPO, S.STRUM))
        # a note's modifiers follow its sustain, or the note itself where it has none
        sus = F.col("next").between(S.SUS_FIRST, S.SUS_LAST)
        behind = lambda c, k: F.coalesce(F.lead(c, k).over(order), F.col(f"{c}_all"))
        rows = rows.withColumns({c[1:]: F.when(sus, behind(c, 2) > behind(c, 1)).otherwise(behind(c, 1) > F.col(c)) for c in upto}).drop(*upto, *[f"{c}_all" for c in upto])
        self.rows = rows = kept(rows, folder, "decoded") if folder else rows
        drums = F.col("header") == "drums"
        string, drum = tok.between(S.GUITAR_FIRST, S.GUITAR_LAST) & ~drums, tok.between(S.DRUM_FIRST, S.DRUM_LAST)
        no = F.lit(False)
        self.notes = rows.where(string | drum).select(
            *TRACK, "header", "pos", "tick",
            F.when(drum, tok - (S.DRUM_FIRST - 1)).otherwise(tok - (S.GUITAR_FIRST - 1) + F.when(F.col("open"), 128).otherwise(0)).alias("lane_mask"),
            F.when(string & sus, S.sustain_ticks(F.greatest(F.col("next") - S.SUS_FIRST, F.lit(0)))).otherwise(0).alias("sustain"),
            F.when(drum, no).otherwise(F.col("hopo")).alias("is_hopo"), F.when(drum, no).otherwise(F.col("tap")).alias("is_tap"), F.when(drum, no).otherwise(F.col("strum")).alias("is_force_strum"))
        self.beats = rows.where(tok == S.BEAT).select(*TRACK, "pos", "tick")
        # one pass: a star's end is the next star token; one without a next runs on to the track's end
        marks = rows.where(tok.between(S.STAR_ON, S.SOLO_OFF)).withColumn("star", tok <= S.STAR_OFF)
        then = Window.partitionBy(*TRACK, "star").orderBy("pos")
        marks = marks.withColumn("then", F.lead("tok").over(then)).withColumn("until", F.lead("tick").over(then))
        one = lambda at, kind, length: F.struct(at.alias("ord"), "tick", kind.alias("kind"), length.alias("length"))
        length = F.when(F.col("then") == S.STAR_OFF, F.col("until") - F.col("tick")).otherwise(0)
        star = one(F.col("pos"), F.lit("star_power"), length)
        tail = one(F.col("pos") + 1_000_000_000, F.lit("star_power"), F.col("final") - F.col("tick"))
        solo = one(F.col("pos"), F.when(tok == S.SOLO_ON, "solo").otherwise("soloend"), F.lit(0))
        found = F.when(tok == S.STAR_ON, F.when(F.col("then").isNull(), F.array(star, tail)).otherwise(F.array(star))).when(~F.col("star"), F.array(solo))
        self.specials = marks.select(*TRACK, F.explode(found).alias("e")).select(*TRACK, "e.*")


def roundtrip(sequences: DataFrame) -> DataFrame:
    """song_id, instrument, same, first_diff (null if same), length, back_length: what decoding and
    encoding again gives. Notes with an open lane keep their other lanes only.

    Sequences and their decoded tokens are written once: what follows reads these tables, however they came about.
    """
    folder = scratch_folder(sequences.sparkSession)
    sequences = kept(sequences.select(*TRACK, "tokens"), folder, "sequences")
    parts = Decoded(exploded(sequences), folder)
    notes = parts.notes.withColumn("lane_mask", F.col("lane_mask") % 128).where("lane_mask > 0")
    # beats belong to the sequence itself here, so they are encoded with it
    beats = parts.beats.select(*TRACK, _event(F.col("tick"), 0, F.array(F.lit(S.BEAT)), 0, F.col("pos")).alias("e"))
    own = notes.select(*TRACK, _event(F.col("tick"), 3, note_tokens(), 0, F.col("pos")).alias("e"))
    more = parts.specials.select(*TRACK, F.explode(special_events()).alias("e"))
    rows = own.unionByName(more).unionByName(beats).groupBy(*TRACK).agg(F.array_sort(F.collect_list("e")).alias("events"))
    again = as_tokens(rows).select(*TRACK, F.col("tokens").alias("again"))
    both = sequences.select(*TRACK, "tokens").join(again.hint("merge"), TRACK, "left")
    differ = F.filter(F.sequence(F.lit(0), F.least(F.size("tokens"), F.size("again")) - 1), lambda i: F.get("tokens", i) != F.get("again", i))
    first = F.coalesce(F.get(differ, F.lit(0)), F.when(F.size("tokens") != F.size("again"), F.least(F.size("tokens"), F.size("again"))))
    return both.select(*TRACK, F.coalesce(F.col("tokens") == F.col("again"), F.lit(False)).alias("same"), first.alias("first_diff"), F.size("tokens").alias("length"), F.size("again").alias("back_length"))
