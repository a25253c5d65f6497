"""MinHash fingerprints of documents, and near classes by signature bands.

* *Fingerprints.* A document's set is its distinct five-word shingles (fewer words: the whole sequence). Each of
  ``PERMUTATIONS`` universal hashes, a x + b modulo 2**64 with a odd, takes the smallest value over the set, all in
  numpy over a slice of a batch; a mixed byte of each makes the fingerprint. Equal sets have equal
  fingerprints, and the share of equal bytes of two estimates the Jaccard similarity of their sets.
* *Edited texts.* A range of documents in order of their ids is one task, so the next document is at hand; the
  last document of a range meets the first one of the next in a second, small pass. Minima over the kept words
  serve both the text and its edited form; only what the edit brings is hashed anew.
* *Bands.* ``BANDS`` bands of ``BAND_ROWS`` minima each are index keys of the join that
  :mod:`chordgrid.llm.ngram_join` runs: documents that share a band are compared with the band's first one, with
  others of its largest component, and at last all with all behind an exact bound; links are verified on the
  whole sets. Two sets of similarity s share a band with chance 1 - (1 - s**6)**12: 0.97 at 0.8, 0.999 at 0.9.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.llm.ngram_join import SHINGLE, NgramJoin, Sets, parity_bits
from chordgrid.llm.shared import removed, shuffle_width, sized_hint, work_folder, written
from chordgrid.llm.words import LOWER, NOT_SPACE, Words, mix, pieces, text_bytes, windows

PERMUTATIONS = 128
BANDS = 12
BAND_ROWS = 6
#: Of a text, the edited form replaces the last one in so many code points.
EDIT_PART = 4
#: Bytes of text in one range, about.
RANGE_BYTES = 64 << 20
#: Windows that are hashed at once.
_CHUNK = 1 << 16
_CODEC = "zstd"

_rng = np.random.default_rng(20250712)
_A = _rng.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
_B = _rng.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
_TOP = np.uint64(2**64 - 1)


def minima(hashes: np.ndarray, first: np.ndarray, count: int = PERMUTATIONS) -> np.ndarray:
    """For each row (its hashes are first[i] to first[i + 1]) the minima of the first ``count`` permutations; all
    ones for an empty row."""
    out = np.full((len(first) - 1, count), _TOP, np.uint64)
    rows = np.flatnonzero(np.diff(first))
    for some in np.split(rows, np.flatnonzero(np.diff(first[rows] // _CHUNK)) + 1) if len(rows) else ():
        a, z = first[some[0]], first[some[-1] + 1]
        for p in range(count):
            out[some, p] = np.minimum.reduceat(hashes[a:z] * _A[p] + _B[p], first[some] - a)
    return out


def parts(least: np.ndarray) -> np.ndarray:
    """The bytes of fingerprints from their minima."""
    return (mix(least.ravel()) & np.uint64(0xFF)).astype(np.uint8).reshape(least.shape)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal bytes, less what chance makes equal: an estimate of the sets' Jaccard similarity."""
    return np.maximum(0, ((a == b).mean(1) * 256 - 1) / 255)


class Texts:
    """Shingle hashes of some texts, row by row: ``grams[first[i]:first[i + 1]]`` are those of row i, in order."""

    def __init__(self, texts: pa.Array, n: int = SHINGLE):
        data, bounds = text_bytes(texts)
        self.words = Words(LOWER[data], bounds, NOT_SPACE)
        hashes = self.words.hashes()
        count = self.words.count
        size = np.where(count >= n, count - n + 1, (count > 0).astype(np.int64))
        self.first = np.append(0, np.cumsum(size))
        self.grams = np.zeros(self.first[-1], np.uint64)
        long = np.flatnonzero(count >= n)
        at = np.repeat(self.words.first[long] - (np.cumsum(size[long]) - size[long]), size[long]) + np.arange(size[long].sum())
        place = np.repeat(self.first[long] - (np.cumsum(size[long]) - size[long]), size[long]) + np.arange(size[long].sum())
        all_grams = windows(hashes, n)
        self.grams[place] = all_grams[at]
        for i in np.flatnonzero((count > 0) & (count < n)).tolist():
            self.grams[self.first[i]] = windows(hashes[self.words.first[i] : self.words.first[i + 1]], int(count[i]))[0]
        self.bounds = bounds


def fingerprint_parts(texts: pa.Array) -> np.ndarray:
    found = Texts(texts)
    return parts(minima(found.grams, found.first))


def edited_texts(texts: list[str], following: list[str]) -> list[str]:
    """Each text with its last len // 4 code points replaced by the first as many (or all) of the following one."""
    return [t[: len(t) - len(t) // EDIT_PART] + u[: len(t) // EDIT_PART] for t, u in zip(texts, following)]


def both_parts(texts: list[str], edited: list[str], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprint parts of texts and of their edited forms.

    Words of a text that end before the edit, and so their windows, are in both forms: their minima are taken
    once, and of the edited form only the words from the fourth last of those on are read again.
    """
    own = Texts(pa.array(texts, pa.large_string()))
    words, count = own.words, own.words.count
    keep = np.array([len(t[: len(t) - len(t) // EDIT_PART].encode()) for t in texts], np.int64)
    ends = words.end - words.bounds[words.row]
    shared = np.add.reduceat(np.append(ends < keep[words.row], False).astype(np.int64), words.first[:-1]) * (count > 0) if len(texts) else count
    inside = np.where((count >= n) & (shared >= n), shared - n + 1, 0)  # windows of both forms
    bounds = np.column_stack([own.first[:-1], own.first[:-1] + inside]).ravel()
    least = minima(own.grams, np.append(bounds, own.first[-1])).reshape(len(texts), 2, PERMUTATIONS)
    # the rest of the edited form begins at the first word of the first window that is not shared
    begin = np.where(inside > 0, words.start[np.minimum(words.first[:-1] + inside, max(0, len(words.start) - 1))] - words.bounds[:-1], 0) if len(words.start) else np.zeros(len(texts), np.int64)
    rest = Texts(pa.array([e.encode()[b:] if b else e.encode() for e, b in zip(edited, begin.tolist())], pa.large_binary()).cast(pa.large_string()))
    other = minima(rest.grams, rest.first)
    other[(inside > 0) & (rest.words.count < n)] = _TOP  # nothing but shared words is left
    return parts(least.min(1)), parts(np.minimum(least[:, 0], other))


# -- in order of ids

def packed_text(text: str) -> bytes:
    raw = text.encode()
    return len(raw).to_bytes(8, "big") + pa.Codec(_CODEC).compress(raw, asbytes=True)


def unpacked(data: bytes) -> str:
    return pa.Codec(_CODEC).decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "big"), asbytes=True).decode()


def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, th, data) with the text compressed, for the way to its range."""
    for piece in pieces(batches, "text"):
        yield pa.record_batch([piece.column("id"), piece.column("th"), pa.array([packed_text(t) for t in piece.column("text").to_pylist()], pa.binary())], ["id", "th", "data"])


_ROW = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = ["id", "th", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
#: What an edge row holds: the first document of a range, or its last one.
FIRST, LAST = 1, 2


def result_columns(texts: list[str], following: list[str], chained: bool) -> list[pa.Array]:
    """The result columns of some documents. ``chained``: each is followed by the next of them."""
    edited = edited_texts(texts, following)
    own, changed = both_parts(texts, edited)
    after = fingerprint_parts(pa.array(following[-1:] if chained else following, pa.large_string()))
    after = np.concatenate([own[1:], after]) if chained else after
    binary = lambda x: pa.array([y.tobytes() for y in x], pa.binary())
    return [pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(e.encode()).digest() for e in edited], pa.binary()), binary(own), binary(changed), pa.array(likeness(own, changed)), pa.array(likeness(own, after))]


def _chunks(batches: Iterator[pa.RecordBatch], limit: int = 1 << 20) -> Iterator[tuple[pa.DataType, list, list, list[str]]]:
    """Type of the ids, ids, hashes and texts of about ``limit`` characters at a time."""
    ids, ths, texts, size = [], [], [], 0
    for batch in batches:
        kind = batch.schema.field("id").type
        for i, th, data in zip(*(batch.column(c).to_pylist() for c in ("id", "th", "data"))):
            ids.append(i)
            ths.append(th)
            texts.append(unpacked(data))
            size += len(texts[-1])
            if size >= limit:
                yield kind, ids, ths, texts
                ids, ths, texts, size = [], [], [], 0
    if ids:
        yield kind, ids, ths, texts


def range_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, th, data) in order: the result rows of all but the last one, and the range's first and last
    documents as edge rows. ``place`` is the range's number."""
    place = TaskContext.get().partitionId()

    def rows(kind: pa.DataType, ids: list, ths: list, columns: list[pa.Array], edge: int, data: list) -> pa.RecordBatch:
        n = len(ids)
        return pa.record_batch([pa.array(ids, kind), pa.array(ths, pa.int64()), *columns, pa.array([edge] * n, pa.int64()), pa.array([place] * n, pa.int64()), pa.array(data, pa.binary())], [*_NAMES, "edge", "place", "data"])

    nothing = [pa.nulls(1, t) for t in (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64())]
    kind, ids, ths, texts = None, [], [], []
    for kind, *new in _chunks(batches):
        if not ids:
            yield rows(kind, new[0][:1], new[1][:1], nothing, FIRST, [packed_text(new[2][0])])
        ids, ths, texts = ids + new[0], ths + new[1], texts + new[2]
        if len(ids) > 1:
            yield rows(kind, ids[:-1], ths[:-1], result_columns(texts[:-1], texts[1:], True), 0, [None] * (len(ids) - 1))
        ids, ths, texts = ids[-1:], ths[-1:], texts[-1:]
    if ids:
        yield rows(kind, ids, ths, nothing, LAST, [packed_text(texts[0])])


def edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (id, th, data, after): the result rows."""
    for batch in batches:
        texts, after = ([unpacked(x) for x in batch.column(c).to_pylist()] for c in ("data", "after"))
        yield pa.record_batch([batch.column("id"), batch.column("th"), *result_columns(texts, after, False)], _NAMES)


def in_order(texts: DataFrame, folder: str) -> DataFrame:
    """The result rows of (id, text, th), in order of id (null last) and th, and after the last one the first."""
    field, long = texts.schema["id"], T.LongType()
    packs = texts.mapInArrow(packed, T.StructType([field, T.StructField("th", long), T.StructField("data", T.BinaryType())]))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(shuffle_width(texts.sparkSession), -(-size // RANGE_BYTES))
    order = [F.col("id").asc_nulls_last(), F.col("th")]
    result = T.StructType([field, T.StructField("th", long), *T.StructType.fromDDL(_ROW)])
    made = T.StructType([*result, T.StructField("edge", long), T.StructField("place", long), T.StructField("data", T.BinaryType())])
    dealt = packs.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    found = written(dealt.mapInArrow(range_rows, made), folder, "ranges")
    # the last document of a range is followed by the first one of the next; there is one row for each range
    first = found.where(F.col("edge") == FIRST)
    after = first.select("place", F.coalesce(F.lead("place").over(Window.orderBy("place")), F.min("place").over(Window.partitionBy())).alias("next"))
    after = after.join(first.select(F.col("place").alias("next"), F.col("data").alias("after")).hint("merge"), "next").select("place", "after")
    last = found.where(F.col("edge") == LAST).select("id", "th", "data", "place").join(after.hint("merge"), "place").select("id", "th", "data", "after")
    return found.where("edge = 0").select(*_NAMES).union(last.mapInArrow(edge_rows, result))


# -- near classes by bands

class BandJoin(NgramJoin):
    """The join of :mod:`chordgrid.llm.ngram_join` with signature bands for index keys."""

    def _members(self) -> DataFrame:
        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, "text"):
                sets = Sets(piece.column("text"))
                least = minima(sets.tokens, sets.first, BANDS * BAND_ROWS).reshape(-1, BANDS, BAND_ROWS)
                keys = np.arange(BANDS, dtype=np.uint64)[None, :]
                for r in range(BAND_ROWS):
                    keys = mix(keys * _A[r] + least[:, :, r])
                keys = keys[sets.size > 0].ravel().view(np.int64)
                bounds = np.append(0, np.cumsum(np.where(sets.size > 0, BANDS, 0))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys))
                maps = [parity_bits(sets.row(i), 1) if n else None for i, n in enumerate(sets.size.tolist())]
                yield pa.record_batch(
                    [piece.column("id"), piece.column("th"), pa.array(sets.size), pa.array(sets.k1.view(np.int64)), pa.array(sets.k2.view(np.int64)), lists, pa.array(maps, pa.binary())],
                    ["id", "th", "n", "k1", "k2", "keys", "bits"])

        return written(self.texts.mapInArrow(keyed, self.member_schema()), self.folder, "members")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, near_id) for each row: the smallest id that links between documents which share a band lead
    to. Odd rows as in :func:`chordgrid.llm.ngram_join.near_groups`."""
    found = BandJoin(docs, id_col, text_col).components()
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("near_id"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and
    near_id, the smallest id of the near class that bands and verified links find.

    Null texts are empty; a text without a word has the fingerprint of the empty set, of likeness 1 to its like
    and 0 to others (but for chance), and is near to nothing. Texts of any length count whole. Documents follow each other by id, a null id
    last, and of one id by a hash of the text; after the last one comes the first, of a single one itself. Equal
    rows follow each other. Other columns are not read. An empty table gives an empty result.
    """
    folder = folder or work_folder(docs.sparkSession)
    join = BandJoin(docs, id_col, text_col, folder)
    near = written(join.linked_rows(), folder, "near").withColumnsRenamed({"id": "l_id", "th": "l_th"})
    for name in ("members", "classes", "star_sets", "spread_sets", "across_sets"):  # read no more
        removed(docs.sparkSession, f"{folder}/{name}")
    rows = in_order(join.texts, f"{folder}/order")
    same = rows["id"].eqNullSafe(near["l_id"]) & (rows["th"] == near["l_th"])
    rows = rows.join(near.hint(sized_hint(near)), same, "left")
    hexed = lambda c: F.lower(F.hex(c)).alias(c)
    return rows.select(F.col("id").alias("doc_id"), "n_chars", hexed("edited_sha256"), hexed("fingerprint"), hexed("edited_fingerprint"), "near_edited", "near_next", F.coalesce("component", "id").alias("near_id"))
