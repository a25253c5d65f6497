"""Count-min sketches: built by partition, merged by Spark in blocks of cells, read as bit maps.

A sketch row has a power of two of cells; rows follow each other in one cell space, which is cut into
blocks of 2**16 cells. A partition emits, for each block that it touched, its cells as 16-bit numbers;
the merge adds them up by block. Two forms leave the merge:

* :func:`merged`: bit maps (counted more often than a limit) for sketches of a size that tasks can hold,
  cells / 8 bytes for each limit;
* :func:`flagged`: a table of the cells over a limit, which rows meet in a join. Its size follows the
  data, and no machine holds it whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chordgrid.llm.shared import shuffle_width
from chordgrid.llm.words import mix

#: Sketches up to so many cells in all (32 MB for each limit) go to the tasks; larger ones are joined.
BROADCAST_CELLS = 1 << 28
#: log2 of the largest row: blocks are numbered by 32-bit numbers.
HIGHEST_BITS = 44
BLOCK = 1 << 16
SCHEMA = "block int, cells binary, twice binary, more binary"


def width_bits(items: float, lowest: int, highest: int) -> int:
    """log2 of a row's width: at least ``items`` cells between the two bounds."""
    return int(np.clip(np.ceil(np.log2(max(1.0, items))), lowest, highest))


def cells_of(keys: np.ndarray, row: int, bits: int) -> np.ndarray:
    """The cell of each 64-bit key in a row (0 or 1), in the cell space of all rows."""
    cell = (mix(keys) >> np.uint64(32 * row)) & np.uint64((1 << bits) - 1)
    return cell.astype(np.int64) + (row << bits)


def partial(keys: np.ndarray, row: int, bits: int) -> pa.RecordBatch:
    """What some keys add to a row: by block, its cells, those hit more than once and how much more."""
    cells, counts = np.unique(cells_of(keys, row, bits), return_counts=True)
    again = counts > 1
    blocks = np.unique(cells // BLOCK)
    columns = [pa.array(blocks.astype(np.int32))]
    for some, values in ((cells, cells % BLOCK), (cells[again], cells[again] % BLOCK), (cells[again], np.minimum(counts[again], 65536) - 1)):
        offsets = np.append(np.searchsorted(some, blocks * BLOCK), len(some)).astype(np.int32) * 2
        columns.append(pa.Array.from_buffers(pa.binary(), len(blocks), [None, pa.py_buffer(offsets), pa.py_buffer(values.astype(np.uint16))]))
    return pa.record_batch(columns, ["block", "cells", "twice", "more"])


def block_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """(block, counts of its cells) from partial rows sorted by block: one block is held at a time."""
    last, held = None, np.zeros(BLOCK, np.uint16)
    for batch in batches:
        for block, once, twice, more in zip(*(batch.column(c).to_pylist() for c in ("block", "cells", "twice", "more"))):
            if block != last and last is not None:
                yield last, held
                held = np.zeros(BLOCK, np.uint16)
            last = block
            for at, add in ((np.frombuffer(once, np.uint16), 1), (np.frombuffer(twice, np.uint16), np.frombuffer(more, np.uint16))):
                held[at] = np.minimum(held[at].astype(np.int64) + add, 60000)
    if last is not None:
        yield last, held


def _by_block(parts: DataFrame) -> DataFrame:
    return parts.repartition(shuffle_width(parts.sparkSession), "block").sortWithinPartitions("block")


def flagged(parts: DataFrame, limits: tuple[int, ...]) -> DataFrame:
    """(cell, level) of the cells that were counted more often than the first limit; level is the number of
    limits that the count is above."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in block_counts(batches):
            level = sum((held > limit).astype(np.int32) for limit in limits)
            at = np.flatnonzero(level)
            yield pa.record_batch([pa.array(at + block * BLOCK), pa.array(level[at], pa.int32())], ["cell", "level"])

    return _by_block(parts).mapInArrow(over, "cell long, level int")


def merged(parts: DataFrame, cells: int, limits: tuple[int, ...]) -> list[np.ndarray]:
    """For each limit, the bits of the cells that were counted more often."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in block_counts(batches):
            for i, limit in enumerate(limits):
                yield pa.record_batch([pa.array([block], pa.int32()), pa.array([i], pa.int32()), pa.array([np.packbits(held > limit, bitorder="little").tobytes()])], ["block", "i", "bits"])

    out = [np.zeros(cells // 8, np.uint8) for _ in limits]
    for row in _by_block(parts).mapInArrow(merge, "block int, i int, bits binary").toLocalIterator():
        out[row["i"]][row["block"] * BLOCK // 8 : (row["block"] + 1) * BLOCK // 8] = np.frombuffer(row["bits"], np.uint8)
    return out


def bit(bits: np.ndarray, cell: np.ndarray) -> np.ndarray:
    return (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
