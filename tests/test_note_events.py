"""A note's event is made in compiled code, before its track gathers it."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chordgrid.functions import scalars as S
from chordgrid.plans import catalog

DIR = "/root/testdata/sf0.001"


def test_sustain_index_is_the_nearest_step_for_every_length(spark):
    steps = [*range(48), *S.COARSE_STEPS]
    got = spark.range(-3, 220).select("id", S.sustain_index(F.col("id") * S.GRID).alias("i")).collect()
    assert [r["i"] for r in got] == [min(range(60), key=lambda i: (abs(steps[i] - max(r["id"], 0)), i)) for r in got]
    assert spark.sql("SELECT cast(null AS int) AS t").select(S.sustain_index(F.col("t")).alias("i")).first()["i"] == 0


@pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")
@pytest.mark.parametrize("name", ["w3_cursor", "w4_beat_ids_clamped", "x1_grammar", "p13_trace", "p6_sane_rows", "j12_first_difference"])
def test_no_list_of_steps_is_made_for_a_note(spark, name):
    plan = catalog.QUERIES[name](spark, DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "[0,1,2,3,4,5,6,7" not in plan and "sequence(0, 47" not in plan
    assert "collect_list(event" in plan


@pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")
def test_sane_rows_group_chords_once(spark):
    plan = catalog.QUERIES["p6_sane_rows"](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "lineitem.parquet" not in plan and "bit_or" not in plan  # chords were written before
