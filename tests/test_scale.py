"""Plans and results where rows tie, groups are large, or vectors are wide."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chordgrid.operators import batching as B, drift as DR, frames as FR


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_vector_means_take_one_row_a_frame(spark):
    rng = np.random.default_rng(1)
    vecs = rng.normal(size=(120, 768)).astype(np.float32)
    rows = [(int(i % 7), [float(x) for x in v]) for i, v in enumerate(vecs)]
    rows += [(0, [1.0, 2.0]), (0, [3.0]), (1, None), (1, []), (2, [None, 1.0]), (9, None)]
    df = spark.createDataFrame(rows, "k int, vec array<float>")
    means = FR.mean_vectors(df, ["k"])
    assert "Generate" not in executed(means) and "partial_aggregate_metrics" in executed(means)
    got = {r["k"]: np.array(r["vec"]) for r in means.collect()}
    assert sorted(got) == list(range(7))
    for k in range(1, 7):
        assert np.allclose(got[k], vecs[k::7].astype(float).mean(0), atol=1e-9)
    mine = vecs[0::7].astype(float)
    n = len(mine)
    assert np.allclose(got[0][:2], [(mine[:, 0].sum() + 4) / (n + 2), (mine[:, 1].sum() + 2) / (n + 1)]) and np.allclose(got[0][2:], mine[:, 2:].mean(0))


def test_rows_that_tie_are_ranked_in_many_ranges(spark):
    rows = spark.range(3000).select(F.lit("g").alias("g"), F.when(F.col("id") % 50 == 0, None).otherwise(0.0).alias("x"), (F.col("id") * 7919 % 3001).alias("id"))
    cuts = B.cut_points(rows, ["x", "id"], 16)
    sizes = [r["count"] for r in rows.groupBy(B.value_range(F.struct("x", "id"), cuts).alias("r")).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 800
    got = {r["id"]: (r["rank"], r["n"]) for r in B.ranked(rows, ["g"], ["x", "id"], 16).collect()}
    want = sorted((r["x"] is not None, r["x"] or 0, r["id"]) for r in rows.collect())
    assert got == {i: (k, 3000) for k, (_, _, i) in enumerate(want, 1)}


def test_ranks_by_structs_texts_and_dates(spark):
    rows = spark.range(900).select((F.col("id") % 2).alias("g"), F.struct(F.when(F.col("id") % 5 > 0, F.col("id") % 5).alias("a"), F.concat(F.lit("t"), F.col("id") % 7).alias("b")).alias("at"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 11).cast("int")).alias("day"), "id")
    got = {r["id"]: r["rank"] for r in B.ranked(rows, ["g"], ["at", "day", "id"], 8).collect()}
    for g in (0, 1):
        want = sorted((r for r in rows.collect() if r["g"] == g), key=lambda r: (r["at"]["a"] is not None, r["at"]["a"] or 0, r["at"]["b"], r["day"], r["id"]))
        assert [got[r["id"]] for r in want] == list(range(1, 451))


def test_percentiles_of_equal_values(spark):
    values = [5.0] * 900 + [1.0] * 90 + [float(i) for i in range(6, 60)] + [None] * 5
    rows = spark.createDataFrame([("a", x) for x in values] + [("b", 2.0)] + [("c", None)], "g string, x double")
    got = {r["g"]: (r["p5"], r["mid"], r["p95"]) for r in DR.percentiles(rows, "g", "x", {"p5": 0.05, "mid": 0.5, "p95": 0.95}).collect()}
    there = [x for x in values if x is not None]
    assert got["a"] == pytest.approx(tuple(np.percentile(there, [5, 50, 95]))) and got["b"] == (2.0, 2.0, 2.0) and set(got) == {"a", "b"}


def test_drift_report_reads_its_input_once(spark):
    rng = np.random.default_rng(3)
    rows = [(i, f"2024-0{1 + i % 4}-01", [float(x) for x in rng.normal(size=8) + (i % 4 > 1) * 0.3]) for i in range(400)] + [(900, "2024-01-01", None), (901, "2024-03-01", [1.0])]
    df = spark.createDataFrame(rows, "key int, day string, vec array<double>")
    out = DR.embedding_drift(df, "2024-03-01", 1000, dim=8)
    plan = executed(out)
    assert "NestedLoop" not in plan and "Cartesian" not in plan and plan.count("ExistingRDD") == 0 and plan.count("LocalTableScan") == 0
    r = out.first()
    old, new = (np.array([v for i, d, v in rows[:400] if (d < "2024-03-01") == side]) for side in (True, False))
    a, b = np.linalg.norm(old, axis=1), np.linalg.norm(new, axis=1)
    assert (r["old_n"], r["new_n"]) == (200, 200)
    assert [r["old_p5"], r["old_p95"], r["new_p5"], r["new_mean"], r["old_std"]] == pytest.approx([*np.percentile(a, [5, 95]), np.percentile(b, 5), b.mean(), a.std()])
    grid = np.sort(np.concatenate([a, b]))
    assert r["d"] == pytest.approx(np.abs(np.searchsorted(np.sort(a), grid, "right") / 200 - np.searchsorted(np.sort(b), grid, "right") / 200).max())
    ca, cb = old.mean(0), new.mean(0)
    assert r["cosine"] == pytest.approx(ca @ cb / np.linalg.norm(ca) / np.linalg.norm(cb), abs=1e-6)


def test_drift_report_of_one_side(spark):
    df = spark.createDataFrame([(1, "2024-01-01", [1.0, 2.0]), (2, "2024-01-02", [2.0, 1.0])], "key int, day string, vec array<double>")
    r = DR.embedding_drift(df, "2025-01-01", 10).first()
    assert (r["old_n"], r["new_n"], r["cosine"], r["d"], r["p"]) == (2, 0, None, None, None)


def test_wide_rows_and_round_trips_read_notes_once(spark):
    from chordgrid.plans import core_queries, data_queries
    from chordgrid.plans.views import Views

    v = Views(spark, "/root/testdata/sf0.001")
    plan = executed(data_queries.wide(v))
    assert "lineitem" not in plan and "NestedLoop" not in plan  # chords were written before
    from chordgrid.operators import codec

    plan = executed(codec.roundtrip(core_queries.sequences_of(v)))
    assert "lineitem" not in plan and "events.parquet" not in plan and plan.count("Exchange hash") <= 8


def test_windows_are_few_cells(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(a), int(a + n)) for a, n in zip(rng.integers(0, 5000, 300), rng.choice([1, 2, 3, 17, 900, 40_000], 300))] + [(0, 1), (5, 6), (0, 1 << 20), ((1 << 20) - 1, 1 << 20)]
    rows = spark.createDataFrame(pairs, "a int, b int").select("a", "b", FR.dyadic_cells(F.col("a"), F.col("b")).alias("cells")).collect()
    for r in rows:
        spans = sorted((c["cell"] << c["level"], (c["cell"] + 1) << c["level"]) for c in r["cells"])
        assert spans[0][0] == r["a"] and spans[-1][1] == r["b"] and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        assert len(spans) <= 2 * (r["b"] - r["a"]).bit_length()


def test_long_windows_meet_cells_not_frames(spark):
    vecs = np.random.default_rng(4).normal(size=(3000, 5))
    frames = spark.createDataFrame([(1, i, [float(x) for x in v]) for i, v in enumerate(vecs) if i % 97] + [(1, 97, None), (2, 0, [1.0] * 5)], "song_id int, frame int, vec array<double>")
    windows = [(1, k, a, b) for k, (a, b) in enumerate([(0, 3000), (-5, 2000), (10, 11), (97, 98), (500, 2999), (7, 7), (9, 3), (2990, 10**9)])] + [(2, 0, 0, 5), (3, 0, 0, 9)]
    got = {(r["song_id"], r["k"]): r for r in FR.pool_windows(spark.createDataFrame(windows, "song_id int, k int, first int, stop int"), frames, "song_id", "k").collect()}
    for song, k, a, b in windows:
        inside = [vecs[i] for i in range(max(a, 0), min(b, 3000)) if i % 97] if song == 1 else [np.ones(5)] if song == 2 else []
        assert ((song, k) in got) == bool(inside)
        if inside:
            assert got[song, k]["frames"] == len(inside) and np.allclose(got[song, k]["vec"], np.mean(inside, axis=0))
