"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chordgrid.llm.shared import files_for, written

#: Up to so many edges (some MB) one task labels all nodes; beyond, steps over the whole table do.
SMALL_EDGES = 250_000


def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, comp) of all nodes of one task's edges (a, b)."""
    held = list(batches)
    if not held:
        return
    node, at = np.unique(np.concatenate([np.asarray(b.column(c)) for c in ("a", "b") for b in held]), return_inverse=True)
    u, v = np.split(at, 2)
    label = np.arange(len(node))
    while True:
        least = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], least)
        np.minimum.at(new, label[v], least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.record_batch([pa.array(node), pa.array(node[label])], ["node", "comp"])


def components(edges: DataFrame, folder: str, name: str = "cc") -> DataFrame:
    """(node, comp) of every node of (a, b): comp is the smallest node that edges lead to.

    Each step sends every node's neighbours to the smallest of them; a step writes its edges in the
    shared folder, so lineage stays short and a lost executor costs one step. Groups are reduced to
    their minimum by partial aggregation, and rows meet it again in a join that AQE can split, so a node
    with very many neighbours is in no single task. The steps end when every node has one edge, to a
    node that has none. Few edges take one task and no step.
    """
    if edges.count() <= SMALL_EDGES:
        few = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).coalesce(1)
        return written(few.mapInArrow(labelled, "node long, comp long"), folder, f"{name}/labels")
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), folder, f"{name}/0")
    step, files = 0, files_for(2 * edges.count())
    while not _stars(edges):
        # large star: larger neighbours of a node go to its smallest neighbour (or itself)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), folder, f"{name}/{step}l", files)
        big = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        big = written(big, folder, f"{name}/{step}b", files)
        # small star: a node and its smaller neighbours go to the smallest of them
        least = written(big.groupBy("u").agg(F.min("v").alias("m")), folder, f"{name}/{step}s", files)
        small = big.join(least.hint("merge"), "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        step += 1
        edges = written(small, folder, f"{name}/{step}", files)
    top = edges.select(F.col("v").alias("node"), F.col("v").alias("comp"))
    return written(edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(top).distinct(), folder, f"{name}/labels", files)


def _stars(edges: DataFrame) -> bool:
    """Has every upper node one edge only, and no lower node any upward one?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()
