"""Substring dedup: 50-word windows that an earlier document holds, found behind a count-min prefilter.

Equal windows share the smallest hash of their 25-word grams, their *anchor*; neighbouring windows with
one anchor form a *run* (about 13 windows). Pass 1 counts anchors, once per document, in a count-min
sketch of each partition; the merged sketch overestimates how often a window occurs, so a window whose
anchor it puts below 2 is unique. Pass 2 emits only runs estimated repeated and groups them exactly:

* equal runs (128-bit hash of all their windows) are grouped first; each but the earliest document's
  copy is covered as a whole;
* where different runs share an anchor, the windows of each distinct run's earliest copy are grouped
  by their own 128-bit hashes; what the earliest copy loses, all copies that are not covered as a whole
  lose at the same places.

The sketch's width follows the number of anchors. Up to ``countmin.BROADCAST_CELLS`` cells its bits go to
all tasks; beyond, runs meet the table of repeated cells in a join for each row of the sketch, and no machine holds it.
A fuller sketch lets more runs through and loses none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.llm import countmin
from chordgrid.llm.shared import sized_hint, work_folder, written
from chordgrid.llm.words import NOT_SPACE, Words, mix, pieces, text_bytes, whole, windows

WINDOW = 50
GRAM = 25
ROWS = 2
CELLS = [f"cell{r}" for r in range(ROWS)]
#: log2 of the cells of a sketch row, at least.
LEAST_BITS = 16
#: Text bytes for each anchor, about, and sketch cells for each anchor.
ANCHOR_BYTES, CELLS_PER_ANCHOR = 80, 4
FLUSH = 2_000_000


class Runs:
    """The runs of some texts: ``row``, ``start`` (word), ``size`` (windows), ``anchor``."""

    def __init__(self, texts: pa.Array):
        data, bounds = text_bytes(texts)
        self.words = Words(data, bounds, NOT_SPACE)
        self.hashes = self.words.hashes()
        grams = windows(self.hashes, GRAM)
        span, need = 1, WINDOW - GRAM + 1
        while span * 2 <= need:
            grams, span = np.minimum(grams[:-span], grams[span:]), span * 2
        if len(grams) > need - span:
            grams = np.minimum(grams[: len(grams) - (need - span)], grams[need - span :])
        else:
            grams = grams[:0]
        at = np.flatnonzero(whole(self.words.first, WINDOW, len(self.hashes)))
        value = grams[at]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (value[1:] != value[:-1])
        head = np.flatnonzero(new)
        self.start, self.anchor = at[head], value[head]
        self.size = np.diff(np.append(head, len(at)))
        self.row = np.searchsorted(self.words.first, self.start, "right") - 1

    def window_hashes(self, lane: int) -> np.ndarray:
        return windows(self.hashes, WINDOW, lane)

    def keys(self, lane: int) -> np.ndarray:
        """A hash of each run's windows in their order."""
        at = np.repeat(self.start, self.size) + (place := np.arange(self.size.sum()) - np.repeat(np.cumsum(self.size) - self.size, self.size))
        if not len(at):
            return np.zeros(0, np.uint64)
        value = mix(self.window_hashes(lane)[at] + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return mix(np.add.reduceat(value, np.cumsum(self.size) - self.size) + self.size.astype(np.uint64))


def partition_sketch(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """This partition's sketch of anchors, each counted once for each document."""
    held, n = [], 0
    for piece in pieces(batches, "text"):
        runs = Runs(piece.column("text"))
        order = np.lexsort((runs.anchor, runs.row))
        row, anchor = runs.row[order], runs.anchor[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (anchor[1:] != anchor[:-1])
        held.append(anchor[new])
        n += len(held[-1])
        if n >= FLUSH:
            for r in range(ROWS):
                yield countmin.partial(np.concatenate(held), r, bits)
            held, n = [], 0
    if n:
        for r in range(ROWS):
            yield countmin.partial(np.concatenate(held), r, bits)


def sketch_parts(texts: DataFrame) -> tuple[int, DataFrame]:
    """(log2 of a row's width, the partitions' sketches of anchors)."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = countmin.width_bits(size / ANCHOR_BYTES * CELLS_PER_ANCHOR, LEAST_BITS, countmin.HIGHEST_BITS)
    return bits, texts.select("text").mapInArrow(lambda b: partition_sketch(b, bits), countmin.SCHEMA)


def repeated_runs(texts: DataFrame, folder: str) -> DataFrame:
    """(id, th, start, size, anchor, r1, r2) of the runs that the sketch estimates repeated."""
    bits, parts = sketch_parts(texts)
    held = None
    if ROWS << bits <= countmin.BROADCAST_CELLS:
        held = texts.sparkSession.sparkContext.broadcast(countmin.merged(parts, ROWS << bits, (1,))[0])

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            runs = Runs(piece.column("text"))
            if held:
                hit = np.ones(len(runs.anchor), bool)
                for row in range(ROWS):
                    hit &= countmin.bit(held.value, countmin.cells_of(runs.anchor, row, bits))
                for name in ("start", "size", "anchor", "row"):
                    setattr(runs, name, getattr(runs, name)[hit])
            row = pa.array(runs.row)
            yield pa.record_batch(
                [piece.column("id").take(row), piece.column("th").take(row), pa.array((runs.start - runs.words.first[runs.row]).astype(np.int32)), pa.array(runs.size.astype(np.int32)),
                 *(pa.array(x.view(np.int64)) for x in (runs.anchor, runs.keys(0), runs.keys(1))), *(pa.nulls(len(row), pa.int64()) if held else pa.array(countmin.cells_of(runs.anchor, r, bits)) for r in range(ROWS))],
                ["id", "th", "start", "size", "anchor", "r1", "r2", *CELLS])

    long, int_ = T.LongType(), T.IntegerType()
    made = T.StructType([texts.schema["id"], T.StructField("th", long), T.StructField("start", int_), T.StructField("size", int_), *(T.StructField(c, long) for c in ("anchor", "r1", "r2", *CELLS))])
    runs = texts.mapInArrow(candidates, made)
    if not held:
        # cells of all rows of the sketch share one space; a run stays if each row has its cell
        again = written(countmin.flagged(parts, (1,)), folder, "cells").select("cell")
        for cell in CELLS:
            runs = runs.join(again.withColumnRenamed("cell", cell).hint("merge"), cell, "left_semi")
    return written(runs.drop(*CELLS), folder, "runs")


def covered_spans(texts: DataFrame, folder: str) -> DataFrame:
    """(id, th, start, size): windows start..start+size-1 of the document also start in a smaller id.

    ``texts`` has id, text and th, a hash of the text that tells rows with one id apart.
    """
    runs = repeated_runs(texts, folder)
    field, long, int_ = texts.schema["id"], T.LongType(), T.IntegerType()

    # equal runs: the earliest copy, by id, then place; a null id comes last
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "start")
    first = written(runs.groupBy("r1", "r2", "anchor", "size").agg(F.min(place).alias("f")).select("r1", "r2", "anchor", "size", "f.id", "f.th", "f.start"), folder, "first_runs")
    later = F.col("f_id").isNotNull() & (F.col("id").isNull() | (F.col("f_id") < F.col("id")))

    # anchors that different runs share: compare the windows of their earliest copies
    shared = first.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    open_runs = first.join(shared.hint("merge"), "anchor", "left_semi").groupBy("id", "th").agg(F.collect_list(F.struct("start", "size", "r1", "r2")).alias("runs"))
    open_runs = written(open_runs, folder, "open_runs")

    def window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            runs = Runs(piece.column("text"))
            of = piece.column("runs")
            held = of.flatten()
            start, size, r1, r2 = (np.asarray(held.field(c)) for c in ("start", "size", "r1", "r2"))
            row = np.repeat(np.arange(len(of)), np.asarray(of.value_lengths()))
            run = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
            index = runs.words.first[row[run]] + start[run] + place
            yield pa.record_batch(
                [piece.column("id").take(pa.array(row[run])), *(pa.array(x[run]) for x in (r1, r2)), pa.array(place.astype(np.int32)), *(pa.array(runs.window_hashes(lane)[index].view(np.int64)) for lane in (0, 1))],
                ["id", "r1", "r2", "place", "w1", "w2"])

    keys = open_runs.withColumnsRenamed({"id": "o_id", "th": "o_th"})
    same = texts["id"].eqNullSafe(keys["o_id"]) & (texts["th"] == keys["o_th"])
    needed = texts.join(keys.hint(sized_hint(keys, "runs")), same).select("id", "text", "runs")
    made = T.StructType([field, T.StructField("r1", long), T.StructField("r2", long), T.StructField("place", int_), T.StructField("w1", long), T.StructField("w2", long)])
    seen = written(needed.mapInArrow(window_rows, made), folder, "windows")
    earliest = written(seen.groupBy("w1", "w2").agg(F.min("id").alias("f_id"), F.count("*").alias("n")).where("n > 1").select("w1", "w2", "f_id"), folder, "first_windows")
    hits = seen.join(earliest.hint("merge"), ["w1", "w2"]).where(later).groupBy("r1", "r2").agg(F.collect_set("place").alias("hits"))

    # each copy of a run goes as a whole, or loses the windows that its earliest copy loses: its id is the same
    known = written(first.select("r1", "r2", F.col("id").alias("f_id")).join(hits.hint("merge"), ["r1", "r2"], "left"), folder, "known_runs")
    copies = runs.join(known.hint("merge"), ["r1", "r2"])
    spans = F.when(later, F.array(F.struct("start", "size"))).otherwise(F.transform("hits", lambda x: F.struct((F.col("start") + x).alias("start"), F.lit(1).alias("size"))))
    return copies.select("id", "th", F.explode(spans).alias("s")).select("id", "th", "s.start", "s.size")


def span_lists(texts: DataFrame, folder: str) -> DataFrame:
    """(s_id, s_th, spans): the covered spans of each id and text, each once however many rows repeat them."""
    return covered_spans(texts, folder).groupBy("id", "th").agg(F.collect_set(F.struct("start", "size")).alias("spans")).withColumnsRenamed({"id": "s_id", "th": "s_th"})


def cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (row, text, spans): (row, n_words, n_removed, text of the kept words joined by one space)."""
    for piece in pieces(batches, "text"):
        data, bounds = text_bytes(piece.column("text"))
        words = Words(data, bounds, NOT_SPACE)
        keep = np.ones(len(words.start), bool)
        for i, spans in enumerate(piece.column("spans").to_pylist()):
            for s in spans or ():
                a = words.first[i] + s["start"]
                keep[a : a + s["size"] + WINDOW - 1] = False
        count = np.add.reduceat(np.append(keep, False).astype(np.int64), words.first[:-1]) * (words.count > 0) if len(words.count) else words.count
        raw, texts = data.tobytes(), []
        for i in range(len(words.count)):
            a, b = words.first[i], words.first[i + 1]
            mine = keep[a:b]
            texts.append(b" ".join([raw[x:y] for x, y in zip(words.start[a:b][mine].tolist(), words.end[a:b][mine].tolist())]))
        yield pa.record_batch([piece.column("row"), pa.array(words.count), pa.array(words.count - count), pa.array(texts, pa.binary()).cast(pa.string())], ["row", "n_words", "n_removed", "text"])


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """The rows of docs with n_words, n_removed and the text of the words that are left.

    A null text has no words. Rows that repeat an id are one document to each other: neither loses words
    to the other. A null id is larger than any other, and two null ids take nothing from each other.
    Texts of any length are processed whole, one slice of a batch at a time. All other columns, whatever
    their names, are in the struct ``row``. An empty table gives an empty result.
    """
    folder = folder or work_folder(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    spans = span_lists(texts, folder)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns if c != text_col]).alias("row"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    both = rows.join(spans.hint("merge"), rows["id"].eqNullSafe(spans["s_id"]) & (rows["th"] == spans["s_th"]), "left").select("row", "text", "spans")
    made = T.StructType([rows.schema["row"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("text", T.StringType())])
    return both.mapInArrow(cut_words, made)


def removed_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space).

    Null, empty, repeated and very long rows and empty tables as in :func:`dedup_substrings`; other
    columns are not read.
    """
    only = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return dedup_substrings(only).select("row.doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
