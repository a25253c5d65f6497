"""Chart lines are split once for all relations when they are given a folder."""

from chordgrid.sources import charts as C

TEXT = '[Song]\n{\n  Resolution = 480\n}\n[SyncTrack]\n{\n  0 = B 120000\n  0 = TS 4\n}\n[ExpertSingle]\n{\n\t0 =\tN 0  5\n  0 = N 5 0\n  96 = S 2 10\n  97 = E solo\n}\n[Events]\n{\n  98 = E "soloend"\n}'


def test_split_lines_give_the_same_relations(spark, tmp_path):
    lines = C.numbered(spark.createDataFrame([("a", TEXT), ("b", ""), ("c", None)], "path string, text string"))
    plain, split = C.Charts(lines), C.Charts(lines, f"file:{tmp_path}/x")
    for name in ("notes", "tempo", "timesig", "specials", "header", "resolution"):
        a, b = (sorted(map(str, getattr(c, name)().collect())) for c in (plain, split))
        assert a == b and a, name
    assert "Window" not in split.notes()._jdf.queryExecution().executedPlan().toString()
