"""Spans are swept in one pass of their rows."""

from pathlib import Path

import pytest

from chordgrid.operators import scoring as SC
from chordgrid.plans import catalog

DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")


def plan(spark, name: str) -> str:
    return catalog.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_span_overlap_reads_line_items_once(spark):
    assert plan(spark, "x2_span_overlap").count("FileScan") == 1 and plan(spark, "x2_span_overlap").count("Exchange") == 2


def test_span_overlap_with_touching_and_equal_ends(spark):
    a = spark.createDataFrame([("x", 0, 4), ("x", 4, 9), ("y", 1, 2), ("z", None, 5)], "k string, start long, stop long")
    b = spark.createDataFrame([("x", 4, 6), ("x", 6, 9), ("x", 20, 21), ("w", 3, 7)], "k string, start long, stop long")
    want = {"x": (5, 9, 6, 0.5), "y": (0, 1, 0, 0.0), "w": (0, 0, 4, 0.0)}
    got = {r["k"]: tuple(r)[1:] for r in SC.span_overlap(a, b, ["k"]).collect()}
    assert {k: got[k] for k in want} == want
    both = spark.createDataFrame([("x", 0, 4, 2, 6), ("x", 10, 12, 6, 11)], "k string, start_a long, stop_a long, start_b long, stop_b long")
    assert tuple(SC.paired_overlap(both, ["k"]).first()) == ("x", 3, 6, 9, 0.25)


@needs_tables
def test_ends_are_made_behind_the_shuffle_in_tasks_that_grow(spark, monkeypatch):
    monkeypatch.setattr("chordgrid.plans.views.PART_BYTES", 1 << 10)
    lines = plan(spark, "x2_span_overlap").splitlines()
    shuffle = next(i for i, x in enumerate(lines) if "REPARTITION_BY_NUM" in x)
    assert any("Generate explode" in x for x in lines[:shuffle]) and ", 4)" not in lines[shuffle]
