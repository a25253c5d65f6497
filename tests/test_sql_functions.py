"""Chords and grids through SQL: lists come in any order, and no subquery is joined back to them."""

from chordgrid.functions import sql as SQL
from chordgrid.plans import catalog

DIR = "/root/testdata/sf0.001"


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_chords_are_one_expression_of_their_list(spark):
    assert "Join" not in executed(catalog.QUERIES["a1_chords_by_sql"](spark, DIR))


def test_chords_of_odd_lists(spark):
    SQL.register(spark)
    events = [(96, 5, 0), (0, 1, 7), (96, 4, 3), (None, 2, 1), (0, 0, 9), (0, 6, 50), (192, 7, 1), (0, None, 4), (48, -1, 2), (0, 1, 7)]
    rows = spark.createDataFrame([(1, events), (2, events[::-1]), (3, []), (4, None)], "k int, events array<struct<tick: int, pitch: int, sustain: int>>")
    rows.createOrReplaceTempView("odd_lists")
    got = spark.sql("SELECT k, c.* FROM odd_lists, LATERAL chord_chords(events) c").collect()
    want = {(None, 4, 1, False, False, False), (0, 3, 9, False, False, True), (96, 16, 3, True, False, False)}
    assert len(got) == 6 and all({tuple(r)[1:] for r in got if r["k"] == k} == want for k in (1, 2))


def test_grid_joins_songs_only(spark):
    plan = executed(catalog.QUERIES["g1_grid_by_sql"](spark, DIR))
    assert plan.count("Join") == 2  # ends with tempo, and with signatures
