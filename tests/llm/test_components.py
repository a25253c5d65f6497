"""Components of few edges, in one task, and of many, in steps."""

import random
from collections import defaultdict

import pytest

from chordgrid.llm import components as C


def plain(edges):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    comp = {}
    for start in sorted(near):
        todo = [start] if start not in comp else []
        while todo:
            x = todo.pop()
            if x not in comp:
                comp[x] = start
                todo += near[x]
    return comp


@pytest.mark.parametrize("small", [0, 250_000])
def test_components_equal_plain_ones(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(C, "SMALL_EDGES", small)
    rng = random.Random(3)
    edges = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(260)] + [(k, k + 1) for k in range(1000, 1120)] + [(5000, k) for k in range(4000, 4100)]
    edges = [(a, b) for a, b in edges if a != b] * 2
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    found = {r["node"]: r["comp"] for r in C.components(df, f"file://{tmp_path}/c").collect()}
    assert found == plain(edges)
    assert C.components(df.limit(0), f"file://{tmp_path}/none").count() == 0
