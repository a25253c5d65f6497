"""Tokens stay where their song's events met, and are decoded once."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chordgrid.functions import scalars as S
from chordgrid.plans import catalog
from chordgrid.plans.views import PART_BYTES, Views

DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")


def plan(spark, name: str) -> str:
    return catalog.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()


def test_specials_are_decoded_in_one_pass(spark):
    assert plan(spark, "w9_decode_specials").count("Generate posexplode") == 1


@pytest.mark.parametrize("name", ["w3_cursor", "g3_decode_beats", "w4_beat_ids", "x1_grammar", "p13_trace"])
def test_tokens_are_not_shuffled(spark, name):
    assert plan(spark, name).count("Exchange") <= 5  # notes twice, specials, tempo twice


def test_steps_round_half_to_even_without_bround(spark):
    assert "bround" not in plan(spark, "g2_encode")
    ticks = [0, 7, 8, 9, 24, 40, 41, -8, -24, 7176, None]
    got = [r["s"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(ticks)], "i int, t int").orderBy("i").select(S.ticks_to_steps(F.col("t")).alias("s")).collect()]
    assert got == [None if t is None else round(t / 16) for t in ticks]


def test_tasks_grow_with_line_items(spark, monkeypatch):
    few = Views(spark, DIR).parts
    monkeypatch.setattr("chordgrid.plans.views.PART_BYTES", 1 << 10)
    assert Views(spark, DIR).parts > few and PART_BYTES == 4 << 20
