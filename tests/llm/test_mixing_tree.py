"""The mix against a plain one, and the splitting tree's part in it."""

import math
import random
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402

from chordgrid.llm import mixing  # noqa: E402


def sources(seed, n=400):
    rng = random.Random(seed)
    names = ["big"] * 12 + ["small", None, "été", "tiny"]
    rows = [(i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 20, 60]))), "en", "tiny" if i == 3 else rng.choice(names[:-1]), 0) for i in range(n)]
    return rows + [rows[7]] * 3 + [(7, "w w", "en", "big", 0), (None, "w w w", "en", "big", 0)]


def plain_taken(spark, rows, per_block):
    """(id, source, size) -> times taken, from the same hashes and nothing else of the library."""
    items = Counter((i, s, len(corpus.words(t))) for i, t, _, s, _ in rows)
    ids = spark.createDataFrame([(i,) for i in {k[0] for k in items}], "id long")
    hashes = {r[0]: (r[1], r[2]) for r in ids.select("id", F.xxhash64(F.lit(0), "id"), F.xxhash64(F.lit(0), F.lit("in"), "id")).collect()}
    names = sorted({k[1] for k in items}, key=lambda s: (s is None, s or ""))
    size = {s: sum(k[2] * m for k, m in items.items() if k[1] == s) for s in names}
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(size.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 3 * size[s]}
        if not full:
            target |= {s: level * weight[s] for s in free}
            break
        for s in full:
            target[s] = 3.0 * size[s]
            left -= target[s]
        free -= full
    taken = Counter()
    for sno, s in enumerate(names, 1):
        mine = {k: m for k, m in items.items() if k[1] == s}
        blocks = math.ceil(sum(mine.values()) / per_block)
        of = defaultdict(list)
        for k in mine:
            of[hashes[k[0]][0] % blocks].append(k)
        order = spark.createDataFrame([(sno, b) for b in of], "sno int, block long").select("block", F.xxhash64(F.lit(0), "sno", "block").alias("h")).orderBy("h", "block").collect()
        passes = math.floor(target[s] / size[s]) if size[s] else 0
        rest, upto = target[s] - passes * size[s], 0
        for k in mine:
            taken[k] += passes if k[2] else 0
        for r in order:
            words = sum(k[2] * mine[k] for k in of[r["block"]])
            if upto + words <= rest:
                for k in of[r["block"]]:
                    taken[k] += 1 if k[2] else 0
            elif upto < rest:
                lack = rest - upto
                key = lambda k: (hashes[k[0]][1], k[0] is not None, k[0] or 0, k[2] * mine[k], k[2])
                for k in sorted(of[r["block"]], key=key):
                    if k[2] * mine[k] <= lack:
                        lack -= k[2] * mine[k]
                        taken[k] += 1 if k[2] else 0
            upto += words
    return items, taken


@pytest.mark.parametrize("seed", [1, 2])
def test_taken_equals_a_plain_mix(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "DOCS_PER_BLOCK", 8)
    rows = sources(seed)
    items, taken = plain_taken(spark, rows, 8)
    rows_of = {k: m for k, m in items.items()}
    source = Counter()
    for i, t, _, s, _ in rows:
        source[i, len(corpus.words(t)), s] += 1
    want = Counter()
    for (i, s, n), m in rows_of.items():
        want[i, n, n * taken[i, s, n]] += m
    out = mixing.mix_words(corpus.frame(spark, rows).repartition(3)).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in out) == want
    assert all(len([x for x in r["shards"].split(",") if x]) * r["size"] == r["taken"] for r in out)


def test_documents_go_where_the_tree_sends_them(spark, monkeypatch):
    """Without the tree there would be one shard, or shards of uneven size."""
    monkeypatch.setattr(mixing, "DOCS_PER_BLOCK", 4)
    monkeypatch.setattr(mixing, "BLOCKS_PER_SHARD", 8)
    df = corpus.frame(spark, sources(5, 900))
    mix = mixing.Mix(df)
    draws = mix.draws.collect()
    assert mix.shards == 1 << math.ceil(math.log2(len(draws) / 8)) >= 16
    sizes = Counter(r["shard"] for r in draws)
    assert set(sizes) == set(range(mix.shards)) and max(sizes.values()) - min(sizes.values()) <= 2
    # no block of a pass is drawn twice, and big sources are in every shard, in about their share
    assert len({(r["sno"], r["block"], r["pass"]) for r in draws}) == len(draws)
    per = Counter((r["shard"], r["sno"]) for r in draws)
    top = Counter(r["sno"] for r in draws).most_common(1)[0]
    share = [per[s, top[0]] for s in range(mix.shards)]
    assert min(share) > 0 and abs(sum(share) / len(share) - top[1] / mix.shards) < 1e-9 and len(set(share)) > 1
    # the rows say where they go, and lie there together
    of = {(r["doc_id"], r["size"]): r["shards"] for r in mixing.mix_words(df).collect() if r["doc_id"] not in (7, None)}
    laid = mixing.mixed(df, shard_col="shard").withColumn("at", F.spark_partition_id())
    assert laid.groupBy("shard").agg(F.countDistinct("at").alias("n")).where("n > 1").isEmpty()
    found = defaultdict(list)
    for r in laid.where("doc_id is not null and doc_id <> 7").collect():
        found[r["doc_id"], len(corpus.words(r["text"]))].append(r["shard"])
    assert {k: ",".join(map(str, sorted(v))) for k, v in found.items()} == {k: v for k, v in of.items() if v}
    # each shard is shuffled: sources do not follow one another in blocks
    first = [r["source"] for r in laid.where("shard = 0").collect()]
    assert sum(a != b for a, b in zip(first, first[1:])) > len(set(first))


def test_deeper_trees_split_the_same_quotas(spark, tmp_path):
    quotas = spark.createDataFrame([(1, 100), (2, 7), (3, 0)], "sno int, quota long")
    for levels in (0, 1, 7):
        rows = mixing.shard_quotas(quotas, levels, 3, f"file://{tmp_path}/{levels}").collect()
        total = Counter()
        for r in rows:
            total[r["sno"]] += r["quota"]
        assert len({r["shard"] for r in rows}) == 1 << levels and +total == Counter({1: 100, 2: 7})
