"""Exact dedup by content-defined chunk recipes.

Every text (white space normalised, null as empty) is cut at places its own bytes choose, so equal
passages give equal chunks wherever they stand. Chunks are deduplicated to identifiers that are
verified against the chunk bytes; a document is then its ordered identifier list, and only those
short lists are shuffled to find equal documents. Texts are chunked once; chunk bytes move once: distinct
ones of each partition, for the verification.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chordgrid.llm.shared import fresh, normal_space, removed, work_folder, written
from chordgrid.llm.words import mix, pieces, text_bytes

#: A cut follows a place whose rolling hash has its low bits zero: chunks have 2048 bytes on average.
CUT_BITS = 11
#: Bytes that decide whether a cut follows them.
ROLL = 16
_GEAR = np.random.default_rng(20240301).integers(0, 2**64, 256, dtype=np.uint64)


def cut_places(data: np.ndarray, bounds: np.ndarray, bits: int = CUT_BITS) -> np.ndarray:
    """Byte offsets at which chunks end, with every row's end; a place inside a row is decided by the
    ROLL bytes of that row before it and by nothing else."""
    rolled, size = _GEAR[data], 1
    while size < ROLL:  # rolled[i] covers the bytes i-size+1..i
        rolled[size:] = mix(rolled[size:] + (rolled[:-size] << np.uint64(1)))
        size *= 2
    cuts = np.flatnonzero((rolled & np.uint64((1 << bits) - 1)) == 0) + 1
    row = np.searchsorted(bounds, cuts - 1, "right") - 1
    return np.unique(np.concatenate([cuts[cuts - bounds[row] >= ROLL], bounds[1:][np.diff(bounds) > 0]]))


def chunk_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, sha, chunks) of (id, sha, text) rows; an empty text has no chunk."""
    for piece in pieces(batches, "text"):
        data, bounds = text_bytes(piece.column("text"))
        ends = cut_places(data, bounds)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(ends, bounds, "right").astype(np.int32)), chunks)
        yield pa.record_batch([piece.column("id"), piece.column("sha"), lists], ["id", "sha", "chunks"])


def chunked(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = normal_space(F.col(text_col))
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text")).withColumn("sha", F.sha2("text", 256))
    return texts.mapInArrow(chunk_lists, f"id {texts.schema['id'].dataType.simpleString()}, sha string, chunks array<binary>")


def verified_seed(chunks: DataFrame) -> int:
    """A seed with which no two different chunks share their 128-bit identifier, checked on the bytes
    of all distinct chunks. (The first will do: it fails once in about 2**64 chunks.)"""
    for seed in range(8):
        one = chunks.select(F.explode("chunks").alias("chunk")).select(
            F.xxhash64("chunk").alias("a"), F.xxhash64(F.lit(seed), "chunk").alias("b"), "chunk")
        distinct = one.groupBy("a", "b", "chunk").agg(F.count("*").alias("n"))
        if distinct.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            return seed
    raise RuntimeError("no seed tells all chunks apart")


def text_groups(docs: DataFrame, id_col: str, text_col: str, folder: str) -> DataFrame:
    """(id, sha, m, keep_id, group_size, n_chunks) of each distinct id and text, m being its rows."""
    chunks = written(chunked(docs, id_col, text_col), folder, "chunks")
    seed = verified_seed(chunks)
    lists = chunks.select(
        "id", "sha",
        F.transform("chunks", lambda c: F.xxhash64(c)).alias("a"),
        F.transform("chunks", lambda c: F.xxhash64(F.lit(seed), c)).alias("b"))
    recipes = written(lists.groupBy("id", "sha", "a", "b").agg(F.count("*").alias("m")), folder, "recipes")
    removed(docs.sparkSession, f"{folder}/chunks")  # the texts' bytes are not needed any more
    groups = recipes.groupBy("a", "b").agg(F.min("id").alias("keep_id"), F.sum("m").alias("group_size"))
    groups = groups.where("group_size > 1 or keep_id is null")
    found = recipes.join(groups.hint("merge"), ["a", "b"], "left")
    alone = F.col("group_size").isNull()
    return found.select(
        "id", "sha", "m", F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), F.size("a").alias("n_chunks"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id (smallest id with an equal text), group_size, kept,
    text_sha256 (of the normalised text), n_chunks.

    Null and empty texts are equal to each other; texts of any length are compared whole. Rows that repeat
    both id and text are documents of their own, of which one is kept; a null id yields to any other.
    Other columns are not read. An empty table gives an empty result.
    """
    found = text_groups(docs, id_col, text_col, folder or work_folder(docs.sparkSession))
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"), "n_chunks")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all their columns unchanged, whatever their names.

    Of rows that repeat id and text one stays: the first by their other columns (maps aside), then by the
    text itself; so reruns agree. Nulls and very long texts as in :func:`exact_groups`; an empty table
    stays empty.
    """
    folder = work_folder(docs.sparkSession)
    key, sha, own, n = fresh(docs, "_keep_id", "_keep_sha", "_own_sha", "_copy_no")
    found = text_groups(docs, id_col, text_col, folder).where(F.col("id").eqNullSafe(F.col("keep_id")))
    kept = written(found.select(F.col("id").alias(key), F.col("sha").alias(sha), F.col("m").alias(n)), folder, "kept")
    rows = docs.withColumn(own, F.sha2(normal_space(F.col(text_col)), 256))
    left = rows.join(kept.hint("merge"), rows[id_col].eqNullSafe(kept[key]) & (rows[own] == kept[sha]), "left_semi")
    if not kept.where(F.col(n) > 1).isEmpty():  # only where rows repeat id and text is there anything to choose
        others = [f.name for f in docs.schema.fields if f.name not in (id_col, text_col) and "map<" not in f.dataType.simpleString()]
        first = Window.partitionBy(id_col, own).orderBy(*others, text_col)
        left = left.withColumn(n, F.row_number().over(first)).where(F.col(n) == 1)
    return left.select(*docs.columns)
