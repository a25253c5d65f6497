"""The best file of a song: files do not meet by their names, and tasks grow in number with the line items."""

from pathlib import Path

import pytest

from chordgrid.plans import catalog

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")
def test_files_meet_by_song_in_parts(spark, monkeypatch):
    plain = lambda: sorted(map(tuple, catalog.QUERIES["j6_preferred_files"](spark, DIR).collect()), key=str)
    few = plain()
    monkeypatch.setattr("chordgrid.plans.views.PART_BYTES", 1 << 14)
    plan = catalog.QUERIES["j6_preferred_files"](spark, DIR)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning(base" not in plan and ", 4)" not in plan
    assert plain() == few
