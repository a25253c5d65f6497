"""N-gram Jaccard join by token-combination prefixes.

A document's set is its distinct five-word shingles; two documents link at a Jaccard similarity of
0.8. Documents with equal sets form one class, and only classes are compared.

* *Token classes.* A count-min sketch over all documents tells unique tokens (counted once; an
  overestimate of 1 is exact) from rare and frequent ones. The global token order is unique, rare,
  frequent, and by hash within each; any such order is right, it only decides the work.
* *Prefixes.* A pair that links shares at least c tokens, c >= 4/9 of both sizes together, so its first
  common token in the order is among the first n - ceil(0.8 n) + 1 of both. Unique tokens of the
  prefix need no index: for most documents they fill it. Rare ones are indexed singly.
* *Combinations.* If a pair's first common token is frequent, all its common tokens are. Then the
  prefix is extended: among the first L frequent tokens of both there are more common neighbours than
  tokens of either that the other lacks, so two neighbouring tokens of one are neighbours in the other
  too. These 2-token combinations are indexed, L - 1 instead of all pairs. (Sets below 8 tokens may be
  too small for that; sets up to 20 tokens, which may meet such, index frequent tokens singly too.)
* *Verification.* Classes that share a key are first compared with one of them, then with members of the
  key's largest component, and what is still in different components all with all within a bucket,
  behind an exact bound: the bits in which two parity bit maps differ cannot outnumber the tokens in
  which the sets differ. What passes is verified on the sets.
* *Large buckets.* A bucket above ``BUCKET`` members is not compared all with all. Its members get keys of
  many tokens instead: the tokens are dealt by hash to m segments, m one more than the tokens in which
  two linked sets of such sizes can differ, so linked sets agree in one whole segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chordgrid.llm import countmin
from chordgrid.llm.components import components
from chordgrid.llm.shared import files_for, fresh, shuffle_width, sized_hint, work_folder, written
from chordgrid.llm.words import LOWER, NOT_SPACE, Words, mix, pieces, text_bytes, whole, windows

SHINGLE = 5
#: Links at 100 * common >= PERCENT * union.
PERCENT = 80
#: A token that more documents hold is frequent.
RARE = 24
#: log2 of the sketch's cells, at least.
LEAST_BITS = 16
#: Text bytes for each token, about.
TOKEN_BYTES = 7
FLUSH = 3_000_000
#: A bucket with more members is compared by segments, and a segment's bucket in blocks of about so many.
BUCKET = 4096
#: Sizes of one band differ by this factor at most; a link spans two neighbouring bands.
BAND = 1.25
#: Members of a key's largest component that others of the key are compared with.
SPREAD = 64
_COMBINE = np.uint64(0xC2B2AE3D27D4EB4F)


class Sets:
    """The sets of some texts: ``tokens`` (sorted within a row), ``first`` bounds, ``k1``/``k2`` set hashes."""

    def __init__(self, texts: pa.Array, n: int = SHINGLE):
        data, bounds = text_bytes(texts)
        words = Words(LOWER[data], bounds, NOT_SPACE)
        hashes = words.hashes()
        grams = windows(hashes, n)
        parts = []
        for a, count in zip(words.first[:-1].tolist(), words.count.tolist()):
            if count >= n:
                t = np.sort(grams[a : a + count - n + 1])
                keep = np.ones(len(t), bool)
                keep[1:] = t[1:] != t[:-1]
                parts.append(t[keep])
            else:
                parts.append(windows(hashes[a : a + count], count) if count else hashes[:0])
        self.size = np.array([len(p) for p in parts], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.size)])
        self.tokens = np.concatenate(parts) if parts else hashes[:0]
        self.k1, self.k2 = (self._sum(mix(self.tokens ^ np.uint64(salt))) for salt in (0x51ED270B, 0xA5A5A5A51))

    def _sum(self, values: np.ndarray) -> np.ndarray:
        total = np.add.reduceat(np.append(values, np.uint64(0)), self.first[:-1]) if len(self.size) else values[:0]
        total[self.size == 0] = 0
        return mix(total + self.size.astype(np.uint64) * _COMBINE)

    def row(self, i: int) -> np.ndarray:
        return self.tokens[self.first[i] : self.first[i + 1]]


def parity_bits(tokens: np.ndarray, wide: int = 4) -> bytes:
    """A bit map of ``wide`` to twice as many bits a token: each token flips one bit."""
    size = 1 << int(np.clip(np.ceil(np.log2(max(1, wide * len(tokens)))), 8, 17))
    return np.packbits(np.bincount((mix(tokens) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1, bitorder="little").tobytes()


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two parity maps folded to the shorter one's size."""
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return a, b


def may_link(n_a: int, bits_a: bytes, n_b: int, bits_b: bytes, percent: int = PERCENT) -> bool:
    """False only if the pair cannot link: by sizes, or by the bits that differ."""
    if 100 * min(n_a, n_b) < percent * max(n_a, n_b):
        return False
    a, b = same_width(np.frombuffer(bits_a, np.uint8), np.frombuffer(bits_b, np.uint8))
    return int(np.bitwise_count(a ^ b).sum()) * (100 + percent) <= (100 - percent) * (n_a + n_b)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def index_keys(tokens: np.ndarray, kind: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Index keys of a set; ``kind``: 0 unique, 1 rare, 2 frequent for each of its tokens (by hash)."""
    n = len(tokens)
    prefix = n - -(-percent * n // 100) + 1
    unique = int((kind == 0).sum())
    if unique >= prefix:
        return tokens[:0]
    rare = tokens[kind == 1]
    keys = rare[: prefix - unique]
    lacks = n - -(-percent * n // 100) - unique - len(rare)  # frequent tokens that a partner may lack
    if lacks < 0:
        return keys
    frequent = tokens[kind == 2]
    out = [keys]
    if n <= 20:
        out.append(frequent[: lacks + 1])
    if n >= 8:
        # a partner of m tokens lacks at most m - c of its own: c >= p/(1+p) (n+m) and m <= n/p
        theirs = int((100 * n / percent) - (100 * n / percent + n) * percent / (100 + percent)) + 1
        some = frequent[: 2 * lacks + theirs + 2]
        out.append(mix(some[:-1] * _COMBINE + mix(some[1:])))
    return np.concatenate(out)


def row_kinds(cells: np.ndarray, levels: list[dict] | None) -> np.ndarray:
    """The level of each cell by a list of (cell, level); 0 for cells that are not in it."""
    out = np.zeros(len(cells), np.int8)
    if levels:
        at, level = np.array(sorted((x["cell"], x["level"]) for x in levels)).T
        place = np.minimum(np.searchsorted(at, cells), len(at) - 1)
        out[:] = np.where(at[place] == cells, level[place], 0)
    return out


def sketch_tokens(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    held, n, seen = [], 0, set()
    for piece in pieces(batches, "text"):
        sets = Sets(piece.column("text"))
        for i, key in enumerate(sets.k1.tolist()):
            if key not in seen:  # copies that meet here count once
                seen.add(key)
                held.append(sets.row(i))
                n += len(held[-1])
        if n >= FLUSH:
            yield countmin.partial(np.concatenate(held), 0, bits)
            held, n, seen = [], 0, set()
    if n:
        yield countmin.partial(np.concatenate(held), 0, bits)


def band_of(n: int) -> int:
    return int(np.floor(np.log(n) / np.log(BAND) + 1e-9))


def segment_keys(tokens: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of a set at the two levels that its size is in: level b holds the sizes of bands b and b + 1, so two
    sets that link share a level. At it their sizes are at most u, they differ in at most
    d = 2u (100 - p) / (100 + p) tokens, and each of these spoils one segment of half as many again.

    Where more than d segments of a set hold tokens, one of those is whole in any partner. Where fewer do (few
    sets, by chance), the empty segments are keys too: two such sets share one segment of all.
    """
    out, band = [], band_of(len(tokens))
    for level in (band - 1, band):
        most = int(np.floor(BAND ** (level + 2) + 1e-6)) + 1
        d = 2 * most * (100 - percent) // (100 + percent)
        m = d + d // 2 + 1
        segment = (mix(tokens ^ np.uint64(0x5E67A3)) % np.uint64(m)).astype(np.int64)
        total = np.zeros(m, np.uint64)
        np.add.at(total, segment, mix(tokens))
        place = mix(np.arange(m, dtype=np.uint64) * _COMBINE + np.uint64(level + 2))
        full = np.unique(segment)
        if len(full) <= d:
            full = np.arange(m)
        out.append(mix(total[full] ^ place[full]))
    return np.concatenate(out)


def pairs_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs) if pairs else ((), ())
    return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def bucket_pairs(sorted_rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (key, i, j, node, comp, n, bits, side) rows sorted by key, i, j: pairs of nodes of two
    components that may link; of a block pair i <> j only pairs across the two blocks."""

    def compare(rows: list[tuple]) -> tuple[list[int], list[int]]:
        a_out, b_out = [], []
        if len({r[1] for r in rows}) < 2:
            return a_out, b_out
        rows.sort(key=lambda r: r[2])
        node, comp, n = (np.array([r[k] for r in rows]) for k in (0, 1, 2))
        side = np.array([r[4] for r in rows])
        cross = len(set(side.tolist())) > 1
        width = min(len(r[3]) for r in rows)
        narrow = np.zeros((len(rows), width), np.uint8)
        for k, r in enumerate(rows):
            m = np.frombuffer(r[3], np.uint8)
            while len(m) > width:
                m = m[: len(m) // 2] ^ m[len(m) // 2 :]
            narrow[k] = m
        words = narrow.view(np.uint64)
        reach = np.searchsorted(n, n * 100 // PERCENT, "right")
        for k in range(len(rows) - 1):
            z = int(reach[k])
            if z <= k + 1:
                continue
            ok = comp[k + 1 : z] != comp[k]
            if cross:
                ok &= side[k + 1 : z] != side[k]
            some = np.flatnonzero(ok) + k + 1
            if len(some):
                differ = np.bitwise_count(words[some] ^ words[k]).sum(1).astype(np.int64)
                some = some[differ * (100 + PERCENT) <= (100 - PERCENT) * (n[some] + n[k])]
                for m in some.tolist():
                    if may_link(int(n[k]), rows[k][3], int(n[m]), rows[m][3]):
                        a_out.append(min(node[k], node[m]))
                        b_out.append(max(node[k], node[m]))
        return a_out, b_out

    seen: set[tuple[int, int]] = set()

    def once(a: list[int], b: list[int]) -> list[tuple[int, int]]:
        """Pairs that this task has not given yet (it forgets when it has given very many)."""
        new = set(zip(a, b)) - seen
        if len(seen) > 500_000:
            seen.clear()
        seen.update(new)
        return list(new)

    held, last = [], None
    for batch in sorted_rows:
        out_a, out_b = [], []
        for key, i, j, *row in zip(*(batch.column(c).to_pylist() for c in ("key", "i", "j", "node", "comp", "n", "bits", "side"))):
            if (key, i, j) != last:
                if held:
                    a, b = compare(held)
                    out_a += a
                    out_b += b
                held, last = [], (key, i, j)
            held.append(tuple(row))
        yield pairs_batch(once(out_a, out_b))
    if held:
        yield pairs_batch(once(*compare(held)))


def check_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The (a, b) rows whose bit maps let them link."""
    for batch in batches:
        ok = [may_link(*x) for x in zip(*(batch.column(c).to_pylist() for c in ("n_a", "bits_a", "n_b", "bits_b")))]
        yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])


def verify_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for x, y in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())]
        yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])


class NgramJoin:
    """The join of one table. ``members`` has (id, th, n, node) of each row, ``links`` the verified pairs
    (a, b) of class nodes that connect the components, ``labels`` (node, comp)."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None):
        self.folder = folder or work_folder(docs.sparkSession)
        self.width = shuffle_width(docs.sparkSession)
        self.texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
        self.members = self._named(self._members())
        classes = self.members.groupBy("node", "k2", "n").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("r"), F.max("keys").alias("keys"), F.max("bits").alias("bits"))
        classes = classes.where("n > 0").select("node", "n", "r.id", "r.th", "keys", "bits")
        self.classes = written(classes, self.folder, "classes")
        # narrow tables have as many files as the index keys are worth
        self.files = files_for(self.classes.agg(F.sum(F.size("keys"))).first()[0] or 0)
        keyed = self.classes.where(F.size("keys") > 0)
        self.nodes = keyed.select("node", "n", "id", "th", "bits")
        # a hot key's rows are reduced by partial aggregation and meet their center in a join that AQE splits
        rows = keyed.select("node", F.explode(F.array_distinct("keys")).alias("key"))
        least = rows.groupBy("key").agg(F.min("node").alias("center"), F.max("node").alias("most")).where("center < most").select("key", "center")
        least = written(least, self.folder, "centers", self.files)
        self.rows = written(rows.join(least.hint("merge"), "key").select("key", "node", "center"), self.folder, "stars", self.files)
        tested = self.rows.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b")).distinct()
        first = self._verified(self._checked(tested, "star"), "star")
        self.links, self.labels = first, components(first, self.folder, "star_cc")
        # what the first comparison left apart meets other nodes of its keys' largest components
        rows, mixed = self._mixed("star")
        if mixed.isEmpty():
            return
        spread = written(self._spread(rows).join(tested.hint("merge"), ["a", "b"], "left_anti"), self.folder, "spread_new", self.files)
        second = self._verified(self._checked(spread, "spread"), "spread")
        if not second.isEmpty():
            self.links = first.union(second)
            self.labels = components(self.links, self.folder, "spread_cc")
            rows, mixed = self._mixed("spread")
            if mixed.isEmpty():
                return
        # and what is still apart is compared all with all
        third = self._verified(self._across(rows, mixed).join(tested.union(spread).hint("merge"), ["a", "b"], "left_anti"), "across")
        if not third.isEmpty():
            self.links = self.links.union(third)
            self.labels = components(self.links, self.folder, "cc")

    def _members(self) -> DataFrame:
        size = self.texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        bits = countmin.width_bits(size / TOKEN_BYTES, LEAST_BITS, countmin.HIGHEST_BITS)
        parts = self.texts.select("text").mapInArrow(lambda b: sketch_tokens(b, bits), countmin.SCHEMA)
        texts, held = self.texts, None
        if 1 << bits <= countmin.BROADCAST_CELLS:
            held = texts.sparkSession.sparkContext.broadcast(countmin.merged(parts, 1 << bits, (1, RARE)))
        else:
            texts = self._with_levels(parts, bits)

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, "text"):
                sets = Sets(piece.column("text"))
                cell = countmin.cells_of(sets.tokens, 0, bits)
                if held:
                    kind = sum(countmin.bit(bitmap, cell).astype(np.int8) for bitmap in held.value)
                else:
                    kind = np.concatenate([row_kinds(cell[a:b], x) for a, b, x in zip(sets.first, sets.first[1:], piece.column("levels").to_pylist())] or [np.zeros(0, np.int8)])
                keys = [index_keys(sets.row(i), kind[sets.first[i] : sets.first[i + 1]]) if sets.size[i] else sets.tokens[:0] for i in range(len(sets.size))]
                maps = [parity_bits(sets.row(i)) if len(k) else None for i, k in enumerate(keys)]
                bounds = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(keys).view(np.int64)))
                yield pa.record_batch(
                    [piece.column("id"), piece.column("th"), pa.array(sets.size), pa.array(sets.k1.view(np.int64)), pa.array(sets.k2.view(np.int64)), lists, pa.array(maps, pa.binary())],
                    ["id", "th", "n", "k1", "k2", "keys", "bits"])

        return written(texts.mapInArrow(keyed, self.member_schema()), self.folder, "members")

    def member_schema(self) -> T.StructType:
        long = T.LongType()
        return T.StructType([self.texts.schema["id"], *(T.StructField(c, long) for c in ("th", "n", "k1", "k2")), T.StructField("keys", T.ArrayType(long)), T.StructField("bits", T.BinaryType())])

    def _named(self, members: DataFrame) -> DataFrame:
        """The members with ``node``, the number of their class: k1, or another hash where several sets share it."""
        twice = members.groupBy("k1", "k2", "n").agg(F.lit(1).alias("one")).groupBy("k1").agg(F.count("*").alias("sets")).where("sets > 1")
        twice = written(twice, self.folder, "shared_k1")
        if twice.isEmpty():
            return members.withColumn("node", F.col("k1"))
        own = members.join(twice.hint(sized_hint(twice)), "k1", "left")
        return own.withColumn("node", F.when(F.col("sets").isNull(), F.col("k1")).otherwise(F.xxhash64("k1", "k2", "n"))).drop("sets")

    def _with_levels(self, parts: DataFrame, bits: int) -> DataFrame:
        """The texts with ``levels``, a list of (cell, level) of their tokens that are not unique: tokens meet
        the sketch's cells in a join, as the sketch is too large to be held."""
        cells = written(countmin.flagged(parts, (1, RARE)), self.folder, "cells")

        def token_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, "text"):
                sets = Sets(piece.column("text"))
                row = pa.array(np.repeat(np.arange(len(sets.size)), sets.size))
                yield pa.record_batch([piece.column("id").take(row), piece.column("th").take(row), pa.array(countmin.cells_of(sets.tokens, 0, bits))], ["id", "th", "cell"])

        made = T.StructType([self.texts.schema["id"], T.StructField("th", T.LongType()), T.StructField("cell", T.LongType())])
        found = self.texts.mapInArrow(token_cells, made).join(cells.hint("merge"), "cell").groupBy("id", "th").agg(F.collect_set(F.struct("cell", "level")).alias("levels"))
        found = written(found.withColumnsRenamed({"id": "l_id", "th": "l_th"}), self.folder, "levels")
        same = self.texts["id"].eqNullSafe(found["l_id"]) & (self.texts["th"] == found["l_th"])
        return self.texts.join(found.hint("merge"), same, "left").select("id", "text", "th", "levels")

    def _checked(self, pairs: DataFrame, name: str) -> DataFrame:
        for side in "ab":
            own = self.nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}"))
            pairs = pairs.join(own.hint("merge"), side)
        return written(pairs.mapInArrow(check_pairs, "a long, b long"), self.folder, f"{name}_checked", self.files)

    def _verified(self, pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that link, by their whole sets."""
        if name == "across":
            pairs = written(pairs.select("a", "b"), self.folder, f"{name}_pairs", self.files)
        if pairs.isEmpty():
            return pairs.select("a", "b")
        sets = self._sets(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), name, files_for(2 * pairs.count()))
        for side in "ab":
            pairs = pairs.join(sets.select(F.col("node").alias(side), F.col("set").alias(f"set_{side}")).hint("merge"), side)
        return written(pairs.mapInArrow(verify_pairs, "a long, b long"), self.folder, f"{name}_links", self.files)

    def _sets(self, needed: DataFrame, name: str, files: int | None = None) -> DataFrame:
        """(node, set) of some nodes: their sets as bytes, made anew from the texts."""
        needed = written(self.nodes.join(needed.hint("merge"), "node", "left_semi").select("node", F.col("id").alias("n_id"), F.col("th").alias("n_th")), self.folder, f"{name}_needed", files)
        same = self.texts["id"].eqNullSafe(needed["n_id"]) & (self.texts["th"] == needed["n_th"])
        texts = self.texts.join(needed.hint(sized_hint(needed)), same).select("node", "text")

        def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, "text"):
                sets = Sets(piece.column("text"))
                yield pa.record_batch([piece.column("node"), pa.array([sets.row(i).tobytes() for i in range(len(sets.size))], pa.binary())], ["node", "set"])

        return written(texts.mapInArrow(whole_sets, "node long, set binary").dropDuplicates(["node"]), self.folder, f"{name}_sets")

    def _mixed(self, name: str) -> tuple[DataFrame, DataFrame]:
        """(key, node, comp) of the keys that several components share, and those keys with their numbers of rows."""
        member = self.rows.select("key", "node").join(self.labels.hint("merge"), "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
        member = written(member, self.folder, f"{name}_members", self.files)
        mixed = member.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size")).where("low < high")
        mixed = written(mixed.select("key", "size"), self.folder, f"{name}_keys", self.files)
        return member.join(mixed.hint("merge"), "key", "left_semi"), mixed

    def _spread(self, rows: DataFrame) -> DataFrame:
        """Pairs (a, b): for each key's largest component (two nodes at least) and each other component of the
        key, a node of both. Up to SPREAD members, one for each hash, stand for the largest one."""
        groups = written(rows.groupBy("key", "comp").agg(F.count("*").alias("n"), F.min("node").alias("node")), self.folder, "spread_groups", self.files)
        main = groups.groupBy("key").agg(F.max(F.struct("n", "comp")).alias("m")).where("m.n > 1").select("key", F.col("m.comp").alias("main"))
        main = written(main, self.folder, "spread_main", self.files)
        turn = lambda c: F.pmod(F.xxhash64("key", c), F.lit(SPREAD))
        stand = rows.join(main.hint("merge"), "key").where("comp = main").groupBy("key", turn("node").alias("turn")).agg(F.min("node").alias("stand"))
        others = groups.join(main.hint("merge"), "key").where("comp <> main").select("key", "node", turn("comp").alias("turn"))
        both = others.join(stand.hint("merge"), ["key", "turn"])
        return both.select(F.least("node", "stand").alias("a"), F.greatest("node", "stand").alias("b")).distinct()

    def _across(self, rows: DataFrame, mixed: DataFrame) -> DataFrame:
        """Pairs of nodes that share a key but no component yet, and that may link."""
        small = rows.join(mixed.where(F.col("size") <= BUCKET).hint("merge"), "key").select("key", F.lit(0).cast("long").alias("i"), F.lit(0).cast("long").alias("j"), "node", "comp", F.lit(0).cast("long").alias("side"))
        hot = rows.join(mixed.where(F.col("size") > BUCKET).hint("merge"), "key", "left_semi").select("node", "comp").distinct()
        hot = written(hot, self.folder, "hot_nodes", self.files)
        if not hot.isEmpty():
            small = small.unionByName(self._segments(hot))
        rows = small.join(self.nodes.select("node", "n", "bits").hint("merge"), "node").select("key", "i", "j", "node", "comp", "n", "bits", "side")
        by_key = rows.repartition(self.width, "key", "i", "j").sortWithinPartitions("key", "i", "j")
        return by_key.mapInArrow(bucket_pairs, "a long, b long").distinct()

    def _segments(self, hot: DataFrame) -> DataFrame:
        """(key, i, j, node, comp, side) of the nodes of large buckets by their segment keys. A segment that still
        holds very many nodes of several components meets itself block by block: each member goes to the
        pairs its block is in."""
        keys = hot.join(self._sets(hot.select("node"), "hot").hint("merge"), "node")

        def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for node, comp, data in zip(*(batch.column(c).to_pylist() for c in ("node", "comp", "set"))):
                    key = segment_keys(np.frombuffer(data, np.uint64))
                    yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(np.full(len(key), node)), pa.array(np.full(len(key), comp))], ["key", "node", "comp"])

        rows = written(keys.mapInArrow(segments, "key long, node long, comp long"), self.folder, "segments")
        mixed = rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size")).where("low < high").select("key", F.ceil(F.col("size") / BUCKET).alias("blocks"))
        rows = rows.join(written(mixed, self.folder, "segment_keys").hint("merge"), "key").withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")))
        rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        return rows.select("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "node", "comp", "side")

    def class_components(self) -> DataFrame:
        """(node, id, th, comp) of each class: its first row, and the node that names its component."""
        of = self.classes.select("node", "id", "th").join(self.labels.hint("merge"), "node", "left")
        return of.select("node", "id", "th", F.coalesce("comp", "node").alias("comp"))

    def components(self) -> DataFrame:
        """(id, th, n, component) of each row: the smallest id that links lead to."""
        of = written(self.class_components(), self.folder, "class_comp")
        least = of.groupBy("comp").agg(F.min("id").alias("component"))
        of = written(of.join(least.hint("merge"), "comp").select("node", "component"), self.folder, "class_component")
        return self.members.join(of.hint("merge"), "node", "left").select("id", "th", "n", F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component")).alias("component"))

    def linked_rows(self) -> DataFrame:
        """(id, th, component) of the rows whose component has another id than their own, once for each id and text."""
        of = written(self.class_components(), self.folder, "class_comp")
        least = of.groupBy("comp").agg(F.min("id").alias("component"))
        of = of.join(least.hint("merge"), "comp").select("node", "component")
        rows = self.members.where("n > 0").select("id", "th", "node").join(of.hint("merge"), "node")
        return rows.where(~F.col("id").eqNullSafe(F.col("component"))).select("id", "th", "component").distinct()

    def first_rows(self) -> DataFrame:
        """(id, th) of the row with the smallest id of each component, a null id last, and of all rows
        without a shingle."""
        first = self.class_components().groupBy("comp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("r"))
        bare = self.members.where("n = 0").select("id", "th").distinct()
        return written(first.select("r.id", "r.th").unionByName(bare), self.folder, "stay")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Texts below five words are one shingle; null and empty ones have none and link with nothing. Texts of
    any length count whole. Rows that repeat an id take part each with its own text. A null id takes part
    in links but names no component unless all its members lack an id. Other columns are not read. An
    empty table gives an empty result.
    """
    found = NgramJoin(docs, id_col, text_col).components()
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, unchanged: of each component the row with the smallest id (a null id
    is larger than any other), and all rows without a shingle. Rows with one id and one text stay or go
    together; rows that only repeat an id, or lack one, stay or go each with its own component. Extra columns
    keep their names and values; texts of any length count whole; an empty table stays empty."""
    a, b, own = fresh(docs, "_near_id", "_near_th", "_own_th")
    keep = NgramJoin(docs, id_col, text_col).first_rows().select(F.col("id").alias(a), F.col("th").alias(b))
    rows = docs.withColumn(own, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    same = rows[id_col].eqNullSafe(keep[a]) & (rows[own] == keep[b])
    return rows.join(keep.hint("merge"), same, "left_semi").select(*docs.columns)
