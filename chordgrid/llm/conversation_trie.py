"""A prefix trie of conversations, as balanced parentheses in shards.

A conversation is a path: for each turn 16 bytes of md5 over role and text and 4 bytes of the text's length, so
the byte order of paths is the preorder of the trie and the first d turns are the first 20 d bytes.

* Equal conversations are one row with their ids, in lists of at most 2**ID_BITS neighbouring ids; their paths
  are dealt in ranges to shards, each of them sorted.
* *A shard* writes its trie as a sequence of parentheses, an opening one for each node. Blocks of the running
  excess, with a tree of their minima and maxima, find the close of each opening, which delimits its subtree.
  Sums over a subtree are differences of cumulative arrays: members, pairs "()" (leaves), savings.
* *Spines.* Only nodes on a shard's first or last path can also be in other shards. Their part of the sums, what
  lies below no other spine node, goes to the next level as at most two rows for each shard, where the same
  pass merges them; levels go on until one shard holds all spines. Children of spine nodes get their
  parent's name in a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chordgrid.llm.shared import shuffle_width, sized_hint, work_folder, written

UNIT = 20
#: Of one path, ids that agree but for so many lowest bits are one row.
ID_BITS = 16
#: A shard has about so many rows, or so many bytes of paths, at most (a longer path stands alone).
SHARD_ROWS = 50_000
SHARD_BYTES = 32 << 20
#: So many rows of spines are merged in one task.
SPINE_ROWS = 4096
BLOCK = 64
NO_ENDS = hashlib.sha256(b"").hexdigest()
_NONE = np.iinfo(np.int64).max

_SUMS = "n array<bigint>, least array<bigint>, children array<bigint>, leaves array<bigint>, saved array<bigint>, ends array<string>"
ROW = f"conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, key binary, parent_key binary, path binary, {_SUMS}"
_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
     ("ends_sha256", pa.string()), ("key", pa.binary()), ("parent_key", pa.binary()), ("path", pa.binary()),
     *((c, pa.list_(pa.int64())) for c in ("n", "least", "children", "leaves", "saved")), ("ends", pa.list_(pa.string()))]
)


# -- parentheses

class Excess:
    """The running excess of a sequence of parentheses (1 opens, 0 closes) with blocks of minima and maxima."""

    def __init__(self, bits: np.ndarray):
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        pad = -len(bits) % BLOCK
        rows = np.append(self.excess, np.full(pad, self.excess[-1])).reshape(-1, BLOCK)
        self.low, self.high = [rows.min(1)], [rows.max(1)]
        while len(self.low[-1]) > 1:
            for tree, both in ((self.low, np.minimum), (self.high, np.maximum)):
                level = tree[-1] if len(tree[-1]) % 2 == 0 else np.append(tree[-1], tree[-1][-1])
                tree.append(both(level[::2], level[1::2]))

    def _scan(self, at: np.ndarray, goal: np.ndarray) -> np.ndarray:
        """The first place from ``at`` on, within its block, with the excess ``goal``; -1 for none."""
        out = np.full(len(at), -1)
        left = np.arange(len(at))
        at = at.copy()
        while len(left):
            hit = self.excess[at[left]] == goal[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[(at[left] % BLOCK != 0) & (at[left] < len(self.excess))]
        return out

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The matching close of each opening: the first later place whose excess is one less."""
        goal = self.excess[at] - 1
        out = np.full(len(at), -1)
        inside = np.flatnonzero((at + 1) % BLOCK != 0)
        out[inside] = self._scan(at[inside] + 1, goal[inside])
        open_ = np.flatnonzero(out < 0)
        node, level, goal = at[open_] // BLOCK, np.full(len(open_), -1), goal[open_]
        for k in range(len(self.low)):  # up, to the first later block or group of blocks that has the goal
            up = np.flatnonzero(level < 0)
            right = node[up] + 1
            has = (node[up] % 2 == 0) & (right < len(self.low[k]))
            safe = np.minimum(right, len(self.low[k]) - 1)
            has &= (self.low[k][safe] <= goal[up]) & (goal[up] <= self.high[k][safe])
            level[up[has]] = k
            node[up] = np.where(has, right, node[up] // 2)
        for k in range(len(self.low) - 1, 0, -1):  # and down, to its first block
            down = np.flatnonzero(level == k)
            child = 2 * node[down]
            node[down] = child + ~((self.low[k - 1][child] <= goal[down]) & (goal[down] <= self.high[k - 1][child]))
            level[down] = k - 1
        out[open_] = self._scan(node * BLOCK, goal)
        return out


class Shard:
    """The trie of some sorted, distinct paths. Nodes are numbered in preorder, the root is 0."""

    def __init__(self, paths: list[bytes]):
        size = np.array([len(p) // UNIT for p in paths], np.int64)
        first = np.cumsum(size) - size
        units = np.frombuffer(b"".join(paths), np.uint8).reshape(-1, UNIT)
        lcp = np.zeros(len(paths), np.int64)
        both = np.minimum(size[:-1], size[1:])
        some = np.flatnonzero(both)
        if len(some):
            n, start = both[some], np.cumsum(both[some]) - both[some]
            place = np.arange(n.sum()) - np.repeat(start, n)
            words = units.view(np.uint32)
            same = (words[np.repeat(first[some], n) + place] == words[np.repeat(first[some + 1], n) + place]).all(1)
            lcp[some + 1] = np.minimum.reduceat(np.where(same, np.repeat(n, n), place), start)
        opens, closes = size - lcp, np.zeros(len(paths), np.int64)
        opens[0] += 1  # the root
        closes[1:] = size[:-1] - lcp[1:]
        bits = np.repeat(np.tile([0, 1], len(paths)), np.column_stack([closes, opens]).ravel())
        bits = np.append(bits, np.zeros(size[-1] + 1, np.int64))
        at = np.flatnonzero(bits)
        excess = Excess(bits)
        self.lcp, self.count = lcp, len(at)
        self.depth = excess.excess[at] - 1
        self.stop = np.arange(len(at)) + (excess.find_close(at) - at + 1) // 2
        self.pair = self.stop == np.arange(len(at)) + 1
        self.end = np.cumsum(opens) - 1  # the node where each path ends
        self.size = size
        item = np.repeat(np.arange(len(paths)), opens)
        self.tokens = np.zeros(len(at), np.int64)
        deep = self.depth > 0
        last = units[first[item[deep]] + self.depth[deep] - 1, 16:]
        self.tokens[deep] = last.copy().view(">u4").ravel()
        # the parent is the last node before that is one less deep
        order = np.argsort(self.depth, kind="stable")
        keys = self.depth[order] * len(at) + order
        self.parent = order[np.searchsorted(keys, (self.depth - 1) * len(at) + np.arange(len(at))) - 1]
        self.parent[0] = -1
        self.levels = np.split(order, np.flatnonzero(np.diff(self.depth[order])) + 1)

    def below(self, own: np.ndarray) -> np.ndarray:
        """Sum over each node's subtree."""
        total = np.append(0, np.cumsum(own))
        return total[self.stop] - total[: self.count]

    def least_below(self, own: np.ndarray) -> np.ndarray:
        out = own.copy()
        for nodes in reversed(self.levels[1:]):
            np.minimum.at(out, self.parent[nodes], out[nodes])
        return out

    def nodes_of(self, i: int) -> np.ndarray:
        """The nodes on the way to the end of path i, the root first."""
        out, v = [], int(self.end[i])
        while v >= 0:
            out.append(v)
            v = int(self.parent[v])
        return np.array(out[::-1])


def prefix_keys(path: bytes) -> list[bytes]:
    """A name for each prefix of a path, the empty one first."""
    h = hashlib.md5()
    out = [h.digest()]
    for k in range(0, len(path), UNIT):
        h.update(path[k : k + UNIT])
        out.append(h.digest())
    return out


def shard_rows(paths: list[bytes], sums: list[dict], level: int, last: bool) -> Iterator[pa.RecordBatch]:
    """The rows of one shard. ``sums``: for each path the arrays of its last nodes, as ROW has them."""
    trie = Shard(paths)
    n, children, leaves, saved = (np.zeros(trie.count, np.int64) for _ in range(4))
    least, ends = np.full(trie.count, _NONE), np.full(trie.count, None, object)
    if level == 0:  # whole conversations: each counts where it ends
        n[trie.end], least[trie.end], ends[trie.end] = ([x[c][0] for x in sums] for c in ("n", "least", "ends"))
    stack = np.zeros(int(trie.size.max()) + 1, np.int64)
    for i, x in enumerate(sums if level else ()):
        new = int(trie.size[i] - trie.lcp[i]) + (i == 0)
        stack[trie.size[i] + 1 - new : trie.size[i] + 1] = np.arange(trie.end[i] + 1 - new, trie.end[i] + 1)
        at = stack[trie.size[i] + 1 - len(x["n"]) : trie.size[i] + 1]
        for total, name in ((n, "n"), (children, "children"), (leaves, "leaves"), (saved, "saved")):
            total[at] += np.asarray(x[name], np.int64)
        least[at] = np.minimum(least[at], np.asarray(x["least"], np.int64))
        for v, e in zip(at.tolist(), x["ends"]):
            if e is not None:
                ends[v] = e

    spine = np.zeros(trie.count, bool)
    ways = [] if last else [trie.nodes_of(0), trie.nodes_of(len(paths) - 1)]
    for way in ways:
        spine[way] = True
    leaf = trie.pair & (children == 0) & ~spine
    np.add.at(children, trie.parent[1:][~(spine[1:])], 1)
    members, lowest = trie.below(n), trie.least_below(least)
    own = np.where(spine, 0, (members - 1) * trie.tokens)
    n_leaves, n_saved = trie.below(leaves + leaf), trie.below(saved + own)

    # what is final
    names: dict[int, bytes] = {}
    for k, way in enumerate(ways):
        names |= zip(way.tolist(), prefix_keys(paths[-k]))
    rows = np.flatnonzero(~spine)
    parent = trie.parent[rows]
    known = (parent >= 0) & ~spine[parent]
    keys = [None] * trie.count
    for i, path in enumerate(paths if level else ()):
        named = prefix_keys(path)
        for v in range(int(trie.end[i - 1]) + 1 if i else 0, int(trie.end[i]) + 1):
            keys[v] = named[int(trie.depth[v])]
    final = [
        pa.array(lowest[rows]), pa.array(trie.depth[rows]), pa.array(lowest[parent], mask=~known), pa.array(members[rows]), pa.array(children[rows]), pa.array(n_leaves[rows]), pa.array(n_saved[rows]),
        pa.array([NO_ENDS if e is None else e for e in ends[rows]], pa.string()), pa.array([keys[v] for v in rows.tolist()], pa.binary()),
        pa.array([names.get(int(p)) if p >= 0 and not k else None for p, k in zip(parent, known)], pa.binary())]
    yield pa.record_batch([*final, *(pa.nulls(len(rows), f.type) for f in _ARROW if f.name in _ARROW.names[10:])], schema=_ARROW)

    # of spine nodes, what lies below no other spine node
    if ways:
        inner = np.flatnonzero(spine)
        inner = inner[inner > 0]
        parts = {"n": members.copy(), "leaves": n_leaves.copy(), "saved": n_saved.copy()}
        for name, total in (("n", members), ("leaves", n_leaves), ("saved", n_saved)):
            np.subtract.at(parts[name], trie.parent[inner], total[inner])
        parts |= {"least": lowest, "children": children, "ends": ends}
        ways[1] = ways[1][~np.isin(ways[1], ways[0])]
        out = [(paths[-k], way) for k, way in enumerate(ways) if len(way)]
        lists = [pa.array([parts[f.name][way].tolist() for _, way in out], f.type) for f in _ARROW if f.name in _ARROW.names[11:]]
        yield pa.record_batch([*(pa.nulls(len(out), _ARROW.field(c).type) for c in _ARROW.names[:10]), pa.array([p for p, _ in out], pa.binary()), *lists], schema=_ARROW)


def first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (path, part, n, least, ids) sorted by path and part: a shard's rows. The ids of one path are hashed as they come."""
    paths: list[bytes] = []
    sums: list[dict] = []
    h = None
    for batch in batches:
        for path, n, least, ids in zip(*(batch.column(c).to_pylist() for c in ("path", "n", "least", "ids"))):
            if paths and paths[-1] == path:
                h.update(b"," + ids.encode())
                sums[-1]["n"][0] += n
                sums[-1]["least"][0] = min(sums[-1]["least"][0], least)
            else:
                if h:
                    sums[-1]["ends"] = [h.hexdigest()]
                h = hashlib.sha256(ids.encode())
                paths.append(path)
                sums.append({"n": [n], "least": [least], "children": [0], "leaves": [0], "saved": [0]})
    if paths:
        sums[-1]["ends"] = [h.hexdigest()]
        yield from shard_rows(paths, sums, 0, False)


def next_level(batches: Iterator[pa.RecordBatch], level: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Of spines sorted by path: merged, what is final and the spines of this shard. Of one path the parts of
    several shards are added up."""
    paths: list[bytes] = []
    sums: list[dict] = []
    names = ("n", "children", "leaves", "saved", "least", "ends")
    for batch in batches:
        for path, *values in zip(*(batch.column(c).to_pylist() for c in ("path", *names))):
            new = dict(zip(names, values))
            if paths and paths[-1] == path:
                sums[-1] = _merged(sums[-1], new)
            else:
                paths.append(path)
                sums.append(new)
    if paths:
        yield from shard_rows(paths, sums, level, last)


def _merged(a: dict, b: dict) -> dict:
    """Two parts of one path; both end at its last node."""
    if len(a["n"]) < len(b["n"]):
        a, b = b, a
    pad = len(a["n"]) - len(b["n"])
    out = {c: a[c][:pad] + [x + y for x, y in zip(a[c][pad:], b[c])] for c in ("n", "children", "leaves", "saved")}
    out["least"] = a["least"][:pad] + [min(x, y) for x, y in zip(a["least"][pad:], b["least"])]
    out["ends"] = a["ends"][:pad] + [x if y is None else y for x, y in zip(a["ends"][pad:], b["ends"])]
    return out


# -- paths

def turn_unit(role: Column, text: Column) -> Column:
    """40 hex digits of a turn: md5 over role and text (null: empty), and the text's length."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)), F.lpad(F.lower(F.hex(F.length(text))), 8, "0"))


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): the units of each conversation's turns, by turn (null first), of one turn number by unit."""
    rows = conversations.where("conv_id is not null").select("conv_id", F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"), turn_unit(F.col("role"), F.col("text")).alias("unit")).alias("t"))
    return rows.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["unit"]).alias("turns"))


def with_shared_openings(turns: DataFrame, folder: str, block: int = 100, kinds: int = 6) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation c - c % block, h = crc32(c) % kinds,
    and goes on with its own after its first h."""
    turns = written(turns, folder, "turns")
    base = F.col("conv_id") - F.col("conv_id") % block
    lead = turns.where(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.slice("turns", 1, kinds - 1).alias("lead"))
    own = turns.withColumn("base", base).withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % kinds).cast("int"))
    own = own.join(lead.hint("merge"), "base", "left")
    mine = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.select("conv_id", F.concat(F.slice(F.coalesce("lead", F.array().cast("array<string>")), F.lit(1), F.col("h")), mine).alias("turns"))


def prefix_trie(turns: DataFrame, folder: str | None = None, shards: int | None = None) -> DataFrame:
    """The trie of (conv_id, turns), turns as :func:`conversation_turns` makes them: a row for each node with conv_id
    (its smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    An id has one row. Conversations without a turn end at the root; an empty table has no node, not even a
    root. ``shards``: how many ranges of paths, by default as many as keep each small.
    """
    spark = turns.sparkSession
    folder = folder or work_folder(spark)
    path = F.unhex(F.array_join("turns", ""))
    part = F.shiftright("conv_id", ID_BITS)
    lists = turns.select("conv_id", path.alias("path"), part.alias("part")).groupBy("path", "part").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))
    lists = written(lists, folder, "paths")
    rows, size = lists.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("path")), F.lit(0))).first()
    count = shards or max(shuffle_width(spark), -(-rows // SHARD_ROWS), -(-size // SHARD_BYTES))
    dealt = lists.repartitionByRange(count, "path").sortWithinPartitions("path", "part")
    found = written(dealt.mapInArrow(first_level, ROW), folder, "level0")
    done, named, level = [found.where("path is null")], [], 0
    while True:
        spines = found.where("path is not null").select("path", "n", "children", "leaves", "saved", "least", "ends")
        level, left = level + 1, spines.count()
        count = -(-left // SPINE_ROWS)
        last = count <= 1
        dealt = (spines.repartition(1) if last else spines.repartitionByRange(count, "path")).sortWithinPartitions("path")
        found = written(dealt.mapInArrow(lambda b, level=level, last=last: next_level(b, level, last), ROW), folder, f"level{level}")
        done.append(found.where("path is null"))
        named.append(found.where("path is null").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("named")))
        if last:
            break
    nodes, names = done[0], named[0]
    for more in done[1:]:
        nodes = nodes.union(more)
    for more in named[1:]:
        names = names.union(more)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    names = written(names, folder, "spine_names")
    of_spines = nodes.where("parent_key is not null").join(names.hint(sized_hint(names)), "parent_key").withColumn("parent_conv_id", F.col("named"))
    return nodes.where("parent_key is null").select(*columns).union(of_spines.select(*columns))


def conversation_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """The trie of conversations that share openings (:func:`with_shared_openings`): one row for each node.

    Null roles and texts are empty; a null turn number comes before all others; turns of one number follow
    their md5; rows that repeat are turns of their own. Rows without a conv_id belong to no conversation. A
    turn's text goes no further than its md5 and length, so very long texts cost nothing more; a
    conversation is a row of 20 bytes for each turn. Other columns are not read. An empty table gives an
    empty result.
    """
    folder = work_folder(conversations.sparkSession)
    return prefix_trie(with_shared_openings(conversation_turns(conversations), folder), folder, shards)
