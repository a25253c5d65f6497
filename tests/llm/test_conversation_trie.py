"""The conversation trie against a plain one, and its parentheses against a stack."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chordgrid.llm import conversation_trie as C

SCHEMA = "conv_id long, turn long, role string, text string"


def turn_order(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    return turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def plain_nodes(rows, share=True):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node."""
    own = defaultdict(list)
    for row in rows:
        if row[0] is not None:
            own[row[0]].append(row)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(x, key=turn_order)] for c, x in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if share else 0
        base = c - int(np.fmod(c, 100))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = []
    for node, inside in members.items():
        below = [x for x in members if x[: len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1]) for x in below if x)
        ends = ",".join(map(str, sorted(c for c in inside if len(built[c]) == len(node))))
        out.append((min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def conversations(seed, n=150):
    """Few texts, so that prefixes are shared; odd ids, turns and texts."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.choice([rng.randrange(-250, 400), rng.randrange(0, 3) * 100])
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([t, t, t, None, 1]), rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "a", "bé", "\U0001f600c", None, "", "x y\nz"])))
    rows += [(1000 + k, t, "user", "hot" * t) for k in range(60) for t in range(6)]  # copies
    rows += [(5000, t, "user", "deep") for t in range(300)] + [(5001, t, "user", "deep") for t in range(200)]
    rows += [(None, 0, "user", "no id"), (7000, 0, "user", "long " * 50_000)]
    rng.shuffle(rows)
    return rows


def nodes(df):
    return Counter(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


@pytest.mark.parametrize("shards", [1, 3, 25])
def test_trie_equals_a_plain_one(spark, shards):
    rows = conversations(shards)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("path", F.lit("x")).withColumn("turns", F.lit(1)).repartition(3)
    assert nodes(C.conversation_trie(df, shards)) == plain_nodes(rows)


def test_spines_merge_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(C, "SPINE_ROWS", 12)
    monkeypatch.setattr(C, "ID_BITS", 2)  # ids of one path in many lists
    rows = conversations(9)
    assert nodes(C.conversation_trie(spark.createDataFrame(rows, SCHEMA), 60)) == plain_nodes(rows)


def test_trie_without_shared_openings(spark):
    rows = [r for r in conversations(4) if r[0] != 7000]
    turns = C.conversation_turns(spark.createDataFrame(rows, SCHEMA))
    assert nodes(C.prefix_trie(turns, shards=5)) == plain_nodes(rows, share=False)


def test_one_turn_and_empty_tables(spark):
    assert nodes(C.conversation_trie(spark.createDataFrame([], SCHEMA))) == Counter()
    for rows in ([(7, None, None, None)], [(100, 0, "user", "a"), (104, 5, "user", "b")], [(None, 1, "user", "x")]):
        assert nodes(C.conversation_trie(spark.createDataFrame(rows, SCHEMA))) == plain_nodes(rows)


def test_find_close_over_blocks():
    rng = random.Random(5)
    for size in (1, 3, 63, 64, 65, 700, 5000):
        bits, depth = [], 0
        for k in range(2 * size):  # a random balanced sequence below one root
            opens = depth == 0 or (rng.random() < 0.55 and depth < 2 * size - k)
            bits.append(int(opens))
            depth += 1 if opens else -1
        bits = [1, *bits, *[0] * (depth + 1)]
        stack, close = [], {}
        for k, b in enumerate(bits):
            if b:
                stack.append(k)
            else:
                close[stack.pop()] = k
        at = np.flatnonzero(bits)
        assert C.Excess(np.array(bits)).find_close(at).tolist() == [close[k] for k in at.tolist()]
