"""Sequences meet where they lie."""

from pathlib import Path

import pytest

from chordgrid.operators import scoring as SC
from chordgrid.plans import catalog

DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")


def plan(spark, name: str) -> str:
    return catalog.QUERIES[name](spark, DIR)._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_sequences_are_compared_where_they_lie(spark):
    text = plan(spark, "j12_first_difference")
    assert text.count("Exchange") <= 10 and "pos#" not in "".join(x for x in text.splitlines() if "Exchange" in x or "Join" in x)


def test_first_difference_of_unequal_lengths(spark):
    a = spark.createDataFrame([("k", 0, 1), ("k", 1, 2), ("k", 2, 3), ("m", 0, 1)], "s string, pos int, tok int")
    b = spark.createDataFrame([("k", 0, 1), ("k", 1, 2), ("n", 0, 7)], "s string, pos int, tok int")
    assert sorted(map(tuple, SC.first_difference(a, b, ["s"]).collect())) == [("k", 3, 2, 2, 2), ("m", 1, 0, 0, 0), ("n", 0, 1, 0, 0)]
