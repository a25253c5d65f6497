"""Line dedup with sharded cuckoo filters backed by exact reference-count tables.

State, all Parquet, kept as a log of small parts in one folder:

* ``postings`` (id, k1, k2): which document holds which line key, once per document;
* ``counts`` (k1, k2, n_docs, last_doc): exact reference counts;
* ``filters`` (shard, cells): for each shard of the line hashes, a cuckoo filter of the keys that at least
  ``min_docs`` documents hold.

An insertion adds its postings, and for the keys that it touches new counts; a deletion adds the ids that
are gone, and subtracts. Only where the document that keeps a line goes is its key looked up in the
postings again. A key enters its shard's filter when its count reaches the limit and leaves it (cuckoo
filters can delete) when the count falls below, so a deletion restores the lines it had cost others.
Of a key or a shard the newest part holds; :meth:`LineDedup.compact` folds the parts into one.

Lookups are co-partitioned: postings and filters are dealt by shard, a shard with very many postings in
several splits, and every task reads a filter, then the postings that belong to it. A filter has no false
negatives: lines that miss it stay without a look at the counts, and lines that hit it are confirmed.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.llm.shared import removed, shuffle_width, sized_hint, work_folder, written
from chordgrid.llm.words import mix, pieces

MIN_CHARS = 20
MIN_DOCS = 3
#: Keys of one shard's filter, about; the number of shards follows the number of repeated keys.
SHARD_KEYS = 1 << 16
LEAST_SHARDS = 32
#: A shard with more postings is looked up in several splits.
SPLIT_ROWS = 1 << 16
#: Parts of a table before they are folded into one.
MOST_PARTS = 8
SLOTS = 4
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_STRIP = b" \t\n\x0b\f\r"
_PAIR = struct.Struct("<qq")


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; 0 marks a free cell. Adding the same key twice stores it
    twice, and removing takes one away."""

    def __init__(self, buckets: int, cells: np.ndarray | None = None):
        self.buckets = buckets  # a power of two
        self.cells = np.zeros((buckets, SLOTS), np.uint16) if cells is None else cells

    @classmethod
    def sized(cls, keys: int) -> "CuckooFilter":
        return cls(1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8))))))

    @classmethod
    def load(cls, data: bytes) -> "CuckooFilter":
        cells = np.frombuffer(data, np.uint16).reshape(-1, SLOTS).copy()
        return cls(len(cells), cells)

    def dump(self) -> bytes:
        return self.cells.tobytes()

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and the two buckets of each 64-bit key; each bucket leads to the other."""
        print_ = ((keys >> np.uint64(48)) | np.uint64(1)).astype(np.uint16)
        a = (keys & np.uint64(self.buckets - 1)).astype(np.int64)
        return print_, a, a ^ self.jump(print_)

    def jump(self, print_: np.ndarray) -> np.ndarray:
        return (mix(np.asarray(print_, np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        print_, a, b = self.places(keys)
        return (self.cells[a] == print_[:, None]).any(1) | (self.cells[b] == print_[:, None]).any(1)

    def add(self, keys: np.ndarray) -> bool:
        """False if the filter is too full; it must then be built anew, larger."""
        print_, a, b = self.places(keys)
        left = np.arange(len(keys))
        for bucket in (a, b):  # what finds a free cell at once
            left = left[np.argsort(bucket[left], kind="stable")]
            at = bucket[left]
            rank = np.arange(len(at)) - np.searchsorted(at, at)
            free = self.cells[at] == 0
            fits = rank < free.sum(1)
            slot = np.argsort(~free, axis=1, kind="stable")[np.arange(len(at)), np.minimum(rank, SLOTS - 1)]
            self.cells[at[fits], slot[fits]] = print_[left[fits]]
            left = left[~fits]
        for p, at in zip(print_[left], a[left]):  # the rest makes room for itself
            for turn in range(500):
                slots = np.flatnonzero(self.cells[at] == 0)
                if len(slots):
                    self.cells[at, slots[0]] = p
                    break
                slot = turn % SLOTS
                p, self.cells[at, slot] = self.cells[at, slot], p
                at = at ^ int(self.jump(np.array([p]))[0])
            else:
                return False
        return True

    def remove(self, keys: np.ndarray) -> None:
        for print_, a, b in zip(*self.places(keys)):
            for at in (a, b):
                slot = np.flatnonzero(self.cells[at] == print_)
                if len(slot):
                    self.cells[at, slot[0]] = 0
                    break


def build_filter(keys: np.ndarray) -> CuckooFilter:
    size = max(1, len(keys))
    while True:
        made = CuckooFilter.sized(size)
        if made.add(keys):
            return made
        size *= 2


def line_keys(text: bytes | None) -> list[bytes]:
    """The key of each line of a UTF-8 text: stripped of ASCII white space, A-Z lower-cased."""
    return [line.strip(_STRIP) for line in (text or b"").translate(_LOWER).split(b"\n")]


def long_enough(key: bytes, chars: int) -> bool:
    """Does the key have at least ``chars`` code points?"""
    return len(key) >= 4 * chars or len(key) >= chars and len(key.decode("utf-8", "replace")) >= chars


def key_hash(key: bytes) -> tuple[int, int]:
    """A 128-bit hash as two signed 64-bit numbers."""
    return _PAIR.unpack(hashlib.blake2b(key, digest_size=16).digest())


def key_rows(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(id, k1, k2): each document's distinct keys of at least ``min_chars`` code points."""
    for piece in pieces(batches, "text"):
        rows, hashes = [], []
        for i, text in enumerate(piece.column("text").cast(pa.binary()).to_pylist()):
            found = {key_hash(k) for k in set(line_keys(text)) if long_enough(k, min_chars)}
            rows += [i] * len(found)
            hashes += found
        a, b = zip(*hashes) if hashes else ((), ())
        yield pa.record_batch([piece.column("id").take(pa.array(rows, pa.int64())), pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["id", "k1", "k2"])


def without_lines(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Of (.., text, gone) rows: (.., n_lines, n_dropped, text) with the lines whose keys are in gone left out."""
    for piece in pieces(batches, "text"):
        lines_, dropped, texts = [], [], []
        for text, gone in zip(piece.column("text").cast(pa.binary()).to_pylist(), piece.column("gone").to_pylist()):
            lines = (text or b"").split(b"\n")
            kept = lines
            if gone:
                gone = {(g["k1"], g["k2"]) for g in gone}
                kept = [x for x, k in zip(lines, line_keys(text)) if not (long_enough(k, min_chars) and key_hash(k) in gone)]
            lines_.append(len(lines))
            dropped.append(len(lines) - len(kept))
            texts.append(b"\n".join(kept) if gone else text or b"")
        names = [n for n in piece.schema.names if n not in ("text", "gone")]
        yield pa.record_batch([*(piece.column(n) for n in names), pa.array(lines_, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())], [*names, "n_lines", "n_dropped", "text"])


def filter_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (shard, split, cells, id, k1, k2) rows sorted by shard and split, filters (cells not null) first: the
    (id, k1, k2) rows that their filter may hold."""
    place, made = None, None
    for batch in batches:
        shard, split = (np.asarray(batch.column(c)) for c in ("shard", "split"))
        cells = batch.column("cells")
        head = np.asarray(cells.is_valid())
        k2 = np.asarray(batch.column("k2").fill_null(0)).view(np.uint64)
        cut = head.copy()
        cut[1:] |= (shard[1:] != shard[:-1]) | (split[1:] != split[:-1])
        cut[:1] = True
        hit, bounds = np.zeros(len(shard), bool), [*np.flatnonzero(cut).tolist(), len(shard)]
        for a, b in zip(bounds, bounds[1:]):
            if head[a]:
                place, made = (shard[a], split[a]), CuckooFilter.load(cells[a].as_py())
            elif place == (shard[a], split[a]):
                hit[a:b] = made.contains(k2[a:b])
            if head[a] and b > a + 1:
                hit[a + 1 : b] = made.contains(k2[a + 1 : b])
        yield batch.filter(pa.array(hit)).select(["id", "k1", "k2"])


class LineDedup:
    """An incremental line dedup over one folder of state tables."""

    def __init__(self, spark, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None):
        self.spark, self.min_docs, self.min_chars = spark, min_docs, min_chars
        self.id_col, self.text_col, self.folder = id_col, text_col, folder or work_folder(spark)
        self.version = self.shards = self.n_over = 0
        self.parts: dict[str, list[tuple[str, DataFrame]]] = {n: [] for n in ("postings", "gone", "counts", "filters")}

    @classmethod
    def open(cls, spark, folder: str) -> "LineDedup":
        """The state that an earlier session left in ``folder``, as of its last finished step."""
        steps = spark.read.json(f"{folder}/state/*")
        last = steps.orderBy(F.desc("version")).first()
        self = cls(spark, last["min_docs"], last["min_chars"], last["id_col"], last["text_col"], folder)
        self.version, self.shards, self.n_over = last["version"], last["shards"], last["n_over"]
        for part in last["parts"]:
            table, path = part.split(" ")
            self.parts[table].append((f"{folder}/{path}", spark.read.parquet(f"{folder}/{path}")))
        return self

    def _finished(self) -> "LineDedup":
        """Writes down which tables the state has: a step counts when this is there."""
        parts = [f"{table} {path.removeprefix(self.folder + '/')}" for table, found in self.parts.items() for path, _ in found]
        row = (self.version, self.shards, self.n_over, self.min_docs, self.min_chars, self.id_col, self.text_col, parts)
        made = "version long, shards long, n_over long, min_docs long, min_chars long, id_col string, text_col string, parts array<string>"
        self.spark.createDataFrame([row], made).coalesce(1).write.mode("overwrite").json(f"{self.folder}/state/{self.version:09d}")
        return self

    def _keys(self, docs: DataFrame) -> DataFrame:
        rows = docs.select(F.col(self.id_col).alias("id"), F.col(self.text_col).alias("text"))
        limit = self.min_chars
        return rows.mapInArrow(lambda batches: key_rows(batches, limit), f"id {rows.schema['id'].dataType.simpleString()}, k1 long, k2 long")

    def _save(self, df: DataFrame, name: str) -> DataFrame:
        return written(df, self.folder, f"v{self.version}/{name}")

    def _add(self, df: DataFrame, table: str) -> DataFrame:
        """A new part of a table, with the version it came with."""
        part = self._save(df.withColumn("v", F.lit(self.version)), table)
        self.parts[table].append((f"{self.folder}/v{self.version}/{table}", part))
        return part

    def _all(self, table: str) -> DataFrame:
        out = None
        for _, part in self.parts[table]:
            out = part if out is None else out.unionByName(part)
        return out

    def _newest(self, table: str, key: list[str], only: DataFrame | None = None) -> DataFrame:
        """Of each key the row of its newest part; ``only``: of these keys."""
        rows = self._all(table)
        if only is not None:
            rows = rows.join(only.select(*key).hint(sized_hint(only)), key, "left_semi")
        if len(self.parts[table]) == 1:
            return rows.drop("v")
        rest = [c for c in rows.columns if c not in (*key, "v")]
        return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "v").alias("r")).select(*key, *[F.col(f"r.{c}") for c in rest])

    @property
    def counts(self) -> DataFrame:
        """(k1, k2, n_docs, last_doc) of all keys that a document holds."""
        return self._newest("counts", ["k1", "k2"]).where("n_docs > 0")

    @property
    def filters(self) -> DataFrame:
        return self._newest("filters", ["shard"])

    def postings(self) -> DataFrame:
        """(id, k1, k2) of the documents that are there."""
        rows = self._all("postings")
        if self.parts["gone"]:
            gone = self._all("gone").groupBy(F.col("id").alias("g_id")).agg(F.max("v").alias("gv"))
            rows = rows.join(gone.hint("merge"), F.col("id").eqNullSafe(F.col("g_id")), "left").where("gv is null or gv < v")
        return rows.select("id", "k1", "k2")

    def insert(self, docs: DataFrame) -> "LineDedup":
        """Count in documents. Rows that repeat an id count as one document, also one that is there already."""
        self.version += 1
        new = self._keys(docs).distinct()
        if self.parts["postings"]:
            new = self._save(new, "new")
            ids = self._save(new.select(F.col("id").alias("n_id")).distinct(), "ids")
            here = self.postings().join(ids.hint(sized_hint(ids)), F.col("id").eqNullSafe(F.col("n_id")), "left_semi").withColumnsRenamed({"id": "h_id", "k1": "h1", "k2": "h2"})
            new = new.join(here.hint("merge"), F.col("id").eqNullSafe(F.col("h_id")) & (F.col("k1") == F.col("h1")) & (F.col("k2") == F.col("h2")), "left_anti")
        new = self._add(new, "postings")
        change = new.groupBy("k1", "k2").agg(F.count("*").alias("dn"), F.max("id").alias("top"))
        if not self.parts["counts"]:
            self._add(change.select("k1", "k2", F.col("dn").alias("n_docs"), F.col("top").alias("last_doc")), "counts")
            self.n_over = self.counts.where(F.col("n_docs") >= self.min_docs).count()
            return self._build_filters()._finished()
        change = self._save(change, "change")
        old = self._newest("counts", ["k1", "k2"], change)
        both = change.join(old.hint("merge"), ["k1", "k2"], "left").select("k1", "k2", F.coalesce("n_docs", F.lit(0)).alias("was"), (F.coalesce("n_docs", F.lit(0)) + F.col("dn")).alias("n_docs"), F.greatest("last_doc", "top").alias("last_doc"))
        return self._counted(both)

    def delete(self, ids: DataFrame) -> "LineDedup":
        """Take documents out again: ``ids`` has their ids in its first column."""
        self.version += 1
        gone = self._save(ids.select(F.col(ids.columns[0]).alias("g_id")).distinct(), "ids")
        mine = self.postings().join(gone.hint(sized_hint(gone)), F.col("id").eqNullSafe(F.col("g_id")), "left_semi")
        change = self._save(mine.groupBy("k1", "k2").agg(F.count("*").alias("dn"), F.max("id").alias("top")), "change")
        self._add(gone.select(F.col("g_id").alias("id")), "gone")
        old = self._newest("counts", ["k1", "k2"], change)
        both = self._save(change.join(old.hint("merge"), ["k1", "k2"]).select("k1", "k2", F.col("n_docs").alias("was"), (F.col("n_docs") - F.col("dn")).alias("n_docs"), "last_doc", F.col("last_doc").eqNullSafe(F.col("top")).alias("lost")), "both")
        # only keys whose last holder went look for another one
        lost = self._save(both.where("lost and n_docs > 0").select("k1", "k2"), "lost")
        next_ = self.postings().join(lost.hint(sized_hint(lost)), ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.max("id").alias("next"))
        both = both.join(next_.hint("merge"), ["k1", "k2"], "left").select("k1", "k2", "was", "n_docs", F.when(F.col("lost"), F.col("next")).otherwise(F.col("last_doc")).alias("last_doc"))
        return self._counted(both)

    def _counted(self, both: DataFrame) -> "LineDedup":
        """Counts and filters brought in line with (k1, k2, was, n_docs, last_doc) of the keys that changed."""
        both = self._save(both, "changed")
        self._add(both.drop("was"), "counts")
        least = self.min_docs
        flips = both.where((F.col("was") >= least) != (F.col("n_docs") >= least)).select(self._shard(), "k2", (F.col("n_docs") >= least).alias("now"))
        flips = self._save(flips, "flips")
        more = flips.agg(F.sum(F.when(F.col("now"), 1).otherwise(-1))).first()[0]
        self.n_over += more or 0
        if self.n_over > 2 * self.shards * SHARD_KEYS:
            return self._build_filters()._finished()
        if more is not None:
            self._update_filters(flips)
        self._finished()
        if max(map(len, self.parts.values())) > MOST_PARTS:
            self.compact()
        return self

    def _shard(self):
        return F.pmod("k1", F.lit(self.shards)).cast("int").alias("shard")

    def _build_filters(self) -> "LineDedup":
        self.shards = max(LEAST_SHARDS, 1 << int(np.ceil(np.log2(max(1, self.n_over) / SHARD_KEYS))) if self.n_over > SHARD_KEYS else 1)
        self._fold_filters()
        return self

    def _fold_filters(self) -> None:
        over = self.counts.where(F.col("n_docs") >= self.min_docs).select(self._shard(), "k2")
        build = lambda pdf: pd.DataFrame({"shard": pdf["shard"][:1], "cells": [build_filter(pdf["k2"].to_numpy(np.int64).view(np.uint64)).dump()]})
        self.parts["filters"] = []
        self._add(over.groupBy("shard").applyInPandas(build, "shard int, cells binary"), "filters")

    def _update_filters(self, flips: DataFrame) -> None:
        """Keys that reached the limit are added, keys that fell below are removed, in their shards alone."""
        touched = flips.select("shard").distinct()
        old = self._newest("filters", ["shard"], self._save(touched, "shards"))

        def update(filters: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            key, now = keys["k2"].to_numpy(np.int64).view(np.uint64), keys["now"].to_numpy(bool)
            made = CuckooFilter.load(filters["cells"].iloc[0]) if len(filters) else CuckooFilter.sized(len(keys))
            made.remove(key[~now])
            full = not made.add(key[now])
            return pd.DataFrame({"shard": keys["shard"][:1], "cells": [None if full else made.dump()]})

        made = self._save(old.groupBy("shard").cogroup(flips.groupBy("shard")).applyInPandas(update, "shard int, cells binary"), "made")
        if made.where("cells is null").isEmpty():
            self._add(made, "filters")
        else:  # a filter is full: all are built anew for their keys
            self._fold_filters()

    def compact(self) -> None:
        """Folds the parts of each table into one and deletes the old ones. Tables read before must not be
        used any more."""
        self.version += 1
        old = [path for parts in self.parts.values() for path, _ in parts]
        postings, counts, filters = self.postings(), self.counts, self.filters
        made = {name: self._save(df.withColumn("v", F.lit(self.version)), name) for name, df in (("postings", postings), ("counts", counts), ("filters", filters))}
        self.parts = {"gone": []} | {name: [(f"{self.folder}/v{self.version}/{name}", df)] for name, df in made.items()}
        self._finished()
        for path in old:
            removed(self.spark, path)

    def repeated(self) -> DataFrame:
        """(id, k1, k2): the lines that documents lose: keys of at least min_docs documents, in all of
        them but the one with the largest id. Filters drop most postings before the exact join."""
        rows = self.postings().withColumn("shard", self._shard())
        # shards with very many postings, as one line of a third of all documents makes them, are split
        hot = self.counts.groupBy(self._shard()).agg(F.ceil(F.sum("n_docs") / SPLIT_ROWS).alias("splits")).where("splits > 1")
        hot = written(hot, work_folder(self.spark), "hot_shards")
        hint = sized_hint(hot)
        rows = rows.join(hot.hint(hint), "shard", "left").withColumn("split", F.pmod(F.xxhash64("id", "k2"), F.coalesce("splits", F.lit(1))))
        filters = self.filters.join(hot.hint(hint), "shard", "left").withColumn("split", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("splits", F.lit(1)) - 1)))
        both = filters.select("shard", "split", "cells").unionByName(rows.select("shard", "split", "id", "k1", "k2"), allowMissingColumns=True)
        both = both.withColumn("kind", F.col("cells").isNull()).repartition(shuffle_width(self.spark), "shard", "split").sortWithinPartitions("shard", "split", "kind")
        id_type = rows.schema["id"].dataType.simpleString()
        candidates = both.mapInArrow(filter_hits, f"id {id_type}, k1 long, k2 long")
        exact = self.counts.where(F.col("n_docs") >= self.min_docs).select("k1", "k2", "last_doc")
        return candidates.join(exact.hint("merge"), ["k1", "k2"]).where(~F.col("id").eqNullSafe(F.col("last_doc"))).select("id", "k1", "k2")

    def apply(self, docs: DataFrame) -> DataFrame:
        """(row, n_lines, n_dropped, text): the other columns of docs, whatever their names, in ``row``, and the
        text that is left (a null text becomes ""), of any length. A row that stands twice comes twice."""
        rows = docs.select(F.col(self.id_col).alias("id"), F.struct(*[F.col(c) for c in docs.columns if c != self.text_col]).alias("row"), F.col(self.text_col).alias("text"))
        repeated = self.repeated()
        # texts that share an id (or lack one) get only the keys of their own lines
        text_hash = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
        several = rows.groupBy("id").agg(F.min(text_hash).alias("a"), F.max(text_hash).alias("b")).where("a < b")
        several = written(several.select(F.col("id").alias("m_id"), F.lit(True).alias("many")), work_folder(self.spark), "several")
        limit = self.min_chars
        made = T.StructType([rows.schema["row"], T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("text", T.StringType())])
        if several.isEmpty():
            gone = repeated.groupBy("id").agg(F.collect_list(F.struct("k1", "k2")).alias("gone")).withColumnRenamed("id", "gone_id")
            both = rows.join(gone.hint("merge"), rows["id"].eqNullSafe(gone["gone_id"]), "left")
        else:
            marked = rows.join(several.hint(sized_hint(several)), F.col("id").eqNullSafe(F.col("m_id")), "left")
            marked = marked.select("row", "text", F.struct("id", F.when(F.col("many"), text_hash).alias("th")).alias("of"))
            gone = self._own_keys(marked, repeated)
            both = marked.join(gone.hint("merge"), F.col("of.id").eqNullSafe(F.col("gone_id")) & F.col("of.th").eqNullSafe(F.col("gone_th")), "left")
        return both.select("row", "text", "gone").mapInArrow(lambda batches: without_lines(batches, limit), made)


    def _own_keys(self, marked: DataFrame, repeated: DataFrame) -> DataFrame:
        """(gone_id, gone_th, gone): of each text (``of`` has its id and hash) the repeated keys that its own lines have."""
        limit = self.min_chars
        keys = marked.select(F.col("of").alias("id"), "text").mapInArrow(lambda batches: key_rows(batches, limit), f"id {marked.schema['of'].dataType.simpleString()}, k1 long, k2 long").distinct()
        lost = repeated.withColumnsRenamed({"id": "r_id", "k1": "r1", "k2": "r2"})
        same = F.col("id.id").eqNullSafe(F.col("r_id")) & (F.col("k1") == F.col("r1")) & (F.col("k2") == F.col("r2"))
        gone = keys.join(lost.hint("merge"), same, "left_semi").groupBy("id").agg(F.collect_list(F.struct("k1", "k2")).alias("gone"))
        return gone.select(F.col("id.id").alias("gone_id"), F.col("id.th").alias("gone_th"), "gone")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per row of docs: doc_id, n_lines, n_dropped, kept_sha256.

    A null or empty text is one empty line; texts of any length are processed whole. Rows that repeat an
    id, and all rows without one, count as one document; a null id is smaller than any other. Other
    columns are not read. An empty table gives an empty result.
    """
    only = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    state = LineDedup(docs.sparkSession, min_docs, min_chars).insert(only)
    return state.apply(only).select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
