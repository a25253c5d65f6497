"""Lines become tokens in one pass, and these are the tokens of the relations' notes, specials and tempo."""

import pytest
from pyspark.sql import functions as F

from chordgrid.functions import scalars as S
from chordgrid.operators import codec
from chordgrid.operators.chart_codec import LineEncoder
from chordgrid.sources import charts as C

SYNC = "[SyncTrack]\n{\n  0 = TS 4\n  100 = B 120000\n  50 = B\n  60 = B x\n  70 = A 5\n}\n"
GUITAR = '[ExpertSingle]\n{\n\t0 =\tN 0  5\n  0 = N 5 0\n  0 = N 3 700\n  96 = S 2 10\n  97 = E solo\n  96 = N 6 0\n  200 = N 7 0\n  200 = N 1 0 9\n  300 = S 1 5\n  301 = S 2\n  +5 = N 1 1\n  x = N 1 1\n  400 = N 9 1\n  400 = N 2\n  500 = N 4 -3\n  97 = E "soloend"\n  98 = E "solo" x\n  99 = E\n  600 = N 4 99999999999\n}\n'
BASS = "[ExpertDoubleBass]\n{\nnothing\n  10 = N 0 0\n 10 = S 2 7\n 5 = S 2 7\n}\n"
DRUMS = "　[expertDrums]\xa0\n  0 = N 0 3\n  960 = N 1 3 \r\n"
EVENTS = '[Events]\n{\n  98 = E "soloend"\n  3 = E solo\n  3 = E section\n  7 = N 1 1\n}\n'
CHARTS = {
    "all": "[Song]\n{\n  Resolution = 480\n resolution = \"96\"\n Resolution = none\n}\n" + SYNC + GUITAR + EVENTS + BASS + EVENTS + DRUMS,
    "no song": SYNC + BASS + GUITAR, "no tempo": "[Song]\n{\n Resolution = 10\n}\n" + GUITAR + EVENTS, "late tempo": "[SyncTrack]\n999999 = B 1\n" + GUITAR,
    "no notes": SYNC + EVENTS + "[ExpertSingle]\n5 = E solo\n 6 = N 5 0", "none": "", "odd": "[x] = 5\n0 = N 0 0\n[expertsingle\n[ExpertSingle]0 = N 0 0\n1 = N 1 1=2\n2 = N 2 2\n[Other]\n3 = N 3 3\n[HardSingle]\n4 = N 4 4",
    "twice": BASS + GUITAR + SYNC + EVENTS + BASS.replace("10", "77"),
}


@pytest.mark.parametrize("parts", [None, 3])
def test_lines_give_the_tokens_of_their_relations(spark, parts):
    texts = spark.createDataFrame(list(CHARTS.items()) + [("null", None)], "path string, text string")
    lines = C.numbered(texts, parts)
    charts = C.Charts(lines)
    want = codec.encode(charts.notes(), charts.specials(), charts.tempo())
    got = LineEncoder()(lines)
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert got.select("song_id").distinct().count() == 6 and got.where(F.array_contains("tokens", 185)).count() > 4
    if parts:  # one shuffle, of whole texts
        assert str(got._jdf.queryExecution().executedPlan()).count("Exchange hashpartitioning") == 1


def test_blanks_are_those_of_the_pattern(spark):
    """All characters of the first plane, at both ends of a letter."""
    rows = spark.range(1, 0xD800).union(spark.range(0xE000, 0x10000)).select(F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE").alias("c"))
    text = F.concat("c", F.lit(" "), "c", F.lit("x \t"), "c", F.lit("y"), "c", "c")
    assert rows.where(C.stripped(text) != F.regexp_replace(text, r"(?U)^\s+|\s+$", "")).count() == 0
    assert rows.where(F.rtrim(text, F.lit(C.BLANKS)) != F.regexp_replace(text, r"(?U)\s+$", "")).count() == 0
    assert rows.where(C.stripped("c") == "").count() == len(C.BLANKS) == 25


def test_gaps_of_one_wait_token_and_more(spark):
    """Around every half step, and the longest wait."""
    rows = spark.range(-3, 3000).select(F.col("id").cast("int").alias("gap"))
    steps = F.greatest(F.bround(F.col("gap") / 16, 0).cast("int"), F.lit(1))
    bad = rows.where(codec.gap_tokens(F.col("gap")) != F.when(F.col("gap") > 0, S.wait_tokens(steps)).otherwise(F.array().cast("array<int>")))
    assert bad.count() == 0 and rows.where(F.size(codec.gap_tokens(F.col("gap"))) == 2).count() > 0


def test_rendered_notes(spark):
    rows = [("a", "guitar", 10, 5, 7, True, True, True), ("a", "guitar", 2, 16, 0, False, None, False), ("a", "guitar", 3, 32, 1, False, False, False), ("a", "drums", 1, 2, 5, True, False, True), ("b", "bass", 4, 128, 1, False, False, False)]
    notes = spark.createDataFrame(rows, "song_id string, instrument string, tick int, lane_mask int, sustain int, is_hopo boolean, is_tap boolean, is_force_strum boolean")
    assert {(r[0], r[1]): r[2] for r in C.render_tracks(notes).collect()} == {
        ("a", "guitar"): "  2 = N 4 0\n  10 = N 0 7\n  10 = N 2 7\n  10 = N 5 0\n  10 = N 7 0\n  10 = N 6 0", ("a", "drums"): "  1 = N 1 0", ("b", "bass"): ""}
