"""Each operator against a plain version, and on odd rows, empty tables and clashing columns."""

import hashlib
import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402

from chordgrid.llm import exact_dedup, license_scan, line_dedup, mixing, ngram_join, pii_surrogates, quality_classifier, quality_rules, sentencepiece_codec, substring_dedup, words as W  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
one_space = lambda t: re.sub(corpus.SPACE, " ", t or "")


@pytest.fixture(scope="module")
def data():
    return corpus.rows()


@pytest.fixture(scope="module")
def docs(spark, data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    corpus.clashing(corpus.frame(spark, data)).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return corpus.frame(spark, [])


def table(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


# -- words

def test_word_bounds_and_hashes_are_of_each_row():
    texts = pa.array(["ab c", None, "", " x\ty ", "c ab"])
    w = W.Words(*W.text_bytes(texts), W.NOT_SPACE)
    assert w.count.tolist() == [2, 0, 0, 2, 2]
    h = w.hashes()
    assert h[0] == h[5] and h[1] == h[4] and len(set(h.tolist())) == 4
    assert W.whole(w.first, 2, 6).tolist() == [True, False, True, False, True]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 25, 50])
def test_windows_depend_on_their_words_only(n):
    rng = np.random.default_rng(n)
    x = rng.integers(0, 3, 300).astype(np.uint64)
    hashes = W.windows(W.mix(x + np.uint64(1)), n)
    seen = {}
    for i in range(300 - n + 1):
        assert seen.setdefault(tuple(x[i : i + n].tolist()), hashes[i]) == hashes[i]
    assert len(set(seen.values())) == len(seen) and len(hashes) == 300 - n + 1


# -- 10 exact dedup

def test_exact_groups(docs, data):
    groups = defaultdict(list)
    for r in data:
        groups[one_space(r[1])].append(r[0])
    want, left = Counter(), Counter()
    for r in data:
        t = one_space(r[1])
        keep = min(groups[t])
        kept = r[0] == keep and not left[(r[0], t)]
        left[(r[0], t)] += 1
        want[(r[0], keep, len(groups[t]), kept, sha(t))] += 1
    assert table(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == want


def test_chunks_join_to_the_text_and_follow_content():
    rng = random.Random(4)
    body = "".join(rng.choice("abcdefgh ijk") for _ in range(40_000))
    data, bounds = W.text_bytes(pa.array([body, "", "xyz" + body]))
    ends = exact_dedup.cut_places(data, bounds)
    assert ends[-1] == len(data) and set(bounds[1:].tolist()) <= set(ends.tolist())
    a = {e for e in ends.tolist() if e <= bounds[1]}
    b = {e - 3 - int(bounds[2]) for e in ends.tolist() if e > bounds[2]}
    assert len(a) > 8 and len(a ^ b) <= 2


def test_dropping_copies_keeps_one_row_each(docs, data):
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    texts = [one_space(r["text"]) for r in out.collect()]
    assert Counter(texts) == Counter(set(one_space(r[1]) for r in data))


def test_ties_are_settled_by_the_other_columns(spark):
    data = [(1, "a  b", "en", "s", k) for k in (9, 3, 7)] + [(1, "a b", "de", "s", 5)]
    docs = corpus.frame(spark, data).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    for n in (1, 3):
        row, = exact_dedup.drop_copies(docs.repartition(n)).collect()
        assert (row["lang"], row["n_chars"], row["text"]) == ("de", 5, "a b")


# -- 3 line dedup

def plain_lines(data, least=3, chars=20):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\v\f\r").translate(LOWER)
    for r in data:
        for line in (r[1] or "").split("\n"):
            if len(key(line)) >= chars:
                holders[key(line)].add(r[0])
    gone = {k: max(v) for k, v in holders.items() if len(v) >= least}
    out = Counter()
    for r in data:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if gone.get(key(x), r[0]) == r[0]]
        out[(r[0], len(lines), len(lines) - len(kept), sha("\n".join(kept)))] += 1
    return out


def test_line_dedup(docs, data):
    want = plain_lines(data)
    assert sum(n * k[2] for k, n in want.items()) > 5
    assert table(line_dedup.dedup_lines(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == want


def test_line_dedup_is_reversible(spark, data):
    first, more = data[:40], data[40:70]
    state = line_dedup.LineDedup(spark).insert(corpus.frame(spark, first)).insert(corpus.frame(spark, more))
    gone = [r[0] for r in first[:30]]
    state.delete(spark.createDataFrame([(g,) for g in gone], "doc_id long"))
    left = [r for r in first + more if r[0] not in gone]
    out = state.apply(corpus.frame(spark, left)).select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("s"))
    assert table(out, "doc_id", "n_lines", "n_dropped", "s") == plain_lines(left)
    check_filters(state)


def check_filters(state):
    keys = {(r["k1"], r["k2"]) for r in state.counts.where("n_docs >= 3").collect()}
    filters = {r["shard"]: line_dedup.CuckooFilter.load(bytes(r["cells"])) for r in state.filters.collect()}
    for k1, k2 in keys:
        assert filters[k1 % state.shards].contains(np.array([k2]).view(np.uint64))[0]
    assert len(keys) == state.n_over


def test_line_dedup_updates_touch_what_changed(spark, data, monkeypatch):
    """Many shards and splits; batches of one document; a deletion writes no postings."""
    for name, value in (("SHARD_KEYS", 1), ("LEAST_SHARDS", 2), ("SPLIT_ROWS", 3), ("MOST_PARTS", 4)):
        monkeypatch.setattr(line_dedup, name, value)
    state = line_dedup.LineDedup(spark).insert(corpus.frame(spark, data[:50])).insert(corpus.frame(spark, data[:52]))
    assert state.shards > 2 and state.postings().count() == state._all("postings").count()
    left = data[:52]
    for gone in (51, 40, 3):
        before = [p for p, _ in state.parts["postings"]]
        state.delete(spark.createDataFrame([(gone,)], "doc_id long"))
        left = [r for r in left if r[0] != gone]
        if len(state.parts["postings"]) > 1:
            assert [p for p, _ in state.parts["postings"]] == before
        out = state.apply(corpus.frame(spark, left)).select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("s"))
        assert table(out, "doc_id", "n_lines", "n_dropped", "s") == plain_lines(left)
        check_filters(state)
    state.compact()
    state.insert(corpus.frame(spark, data[51:54]))
    left = left + data[51:54]
    out = state.apply(corpus.frame(spark, left)).select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("s"))
    assert table(out, "doc_id", "n_lines", "n_dropped", "s") == plain_lines(left)


def test_cuckoo_filter_adds_and_removes():
    keys = np.random.default_rng(1).integers(0, 2**64, 5000, dtype=np.uint64)
    made = line_dedup.build_filter(keys[:4000])
    assert made.contains(keys[:4000]).all() and made.contains(keys[4000:]).mean() < 0.01
    made.remove(keys[:2000])
    assert made.contains(keys[2000:4000]).all() and made.contains(keys[:2000]).mean() < 0.05
    assert line_dedup.CuckooFilter.load(made.dump()).contains(keys[2000:4000]).all()


# -- 6 quality rules

def plain_rules(data, most, share, percent=30, copies_once=False):
    lines, docs = defaultdict(dict), defaultdict(set)
    hold = lambda r: r[3] if r[3] is not None else "\0"
    full = lambda t: [x for x in (t or "").split("\n") if corpus.words(x)]
    norm = lambda x: x.strip(" \t\n\v\f\r").lower()
    one = lambda r: r[1] or "" if copies_once else (r[0], r[1] or "")
    for r in data:
        docs[hold(r)].add(one(r))
        for x in full(r[1]):
            per = lines[(hold(r), norm(x))]
            per[one(r)] = min(per.get(one(r), r[0]), r[0])
    keeper = {k: min(v.values()) for k, v in lines.items() if len(v) > most and 100 * len(v) > share * len(docs[k[0]])}
    out = Counter()
    for r in data:
        ws, t = corpus.words(r[1]), r[1] or ""
        grams = [tuple(ws[i : i + 8]) for i in range(len(ws) - 7)]
        often = Counter(grams)
        covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(8)}
        own = full(t)
        lost = sum(len(corpus.words(x)) for x in own if keeper.get((hold(r), norm(x)), r[0]) != r[0])
        failed = len(ws) < 20 or 100 * len(covered) > 30 * len(ws)
        kept = not failed and 100 * (len(ws) - lost) >= percent * len(ws)
        out[(r[0], len(ws), sum(map(len, ws)), sum(t.count(c) for c in "#*$%&|<>"), len(own) - len(set(own)), len(covered), failed, kept)] += 1
    return out


@pytest.mark.parametrize("most, share, once", [(10, 10, False), (2, 1, False), (1, 4, True)])
def test_quality_rules(docs, data, most, share, once):
    cols = "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
    assert table(quality_rules.quality_rules(docs, max_docs=most, max_share_percent=share, copies_once=once), *cols) == plain_rules(data, most, share, copies_once=once)


def test_depleted_documents_go_and_one_holder_stays(spark):
    text = "the same boilerplate line that many pages of one host repeat again and again for no good reason at all here"
    line = lambda i: f"{text}\nown {i}"
    other = lambda i: " ".join(f"w{i}x{k}" for k in range(30))
    data = [(i, line(i), "en", "small", 0) for i in range(12)]
    # the same dozen documents are a small share of a large host, and stay
    data += [(100 + i, line(i), "en", "large", 0) for i in range(12)] + [(200 + i, other(i), "en", "large", 0) for i in range(150)]
    out = quality_rules.quality_rules(corpus.frame(spark, data))
    kept = {r["doc_id"] for r in out.where("kept").collect()}
    assert kept == {0, *range(100, 112), *range(200, 350)}


# -- 7 n-gram join

def plain_components(data):
    sets = []
    for r in data:
        ws = corpus.words((r[1] or "").translate(LOWER))
        sets.append({tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set())
    up = list(range(len(data)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                up[top(i)] = top(j)
    least = {}
    for i, r in enumerate(data):
        least[top(i)] = min(least.get(top(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), least[top(i)] if sets[i] else r[0]) for i, r in enumerate(data))


def test_near_groups(docs, data):
    want = plain_components(data)
    assert sum(k[0] != k[2] for k in want) > 5
    assert table(ngram_join.near_groups(docs), "doc_id", "n_shingles", "component_id") == want


def family(seed):
    """Chains and clouds of near copies at all similarities, of short and long texts, in a common vocabulary."""
    rng = random.Random(seed)
    out = []
    for size in (4, 6, 9, 15, 24, 40, 150):
        base = [f"w{rng.randrange(50)}" for _ in range(size)]
        for _ in range(45):
            t = list(base)
            for _ in range(rng.randrange(0, max(2, size // 12))):
                t[rng.randrange(len(t))] = f"v{rng.randrange(9)}"
            if rng.random() < 0.3:
                base = t
            if rng.random() < 0.2:
                t = t + [f"w{rng.randrange(50)}" for _ in range(rng.randrange(1, 4))]
            out.append((len(out), " ".join(t), "en", "s", 0))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_near_copies(spark, seed):
    data = family(seed)
    assert table(ngram_join.near_groups(corpus.frame(spark, data)), "doc_id", "n_shingles", "component_id") == plain_components(data)


def test_index_keys_of_any_linked_pair_meet():
    rng = np.random.default_rng(7)
    universe = np.unique(rng.integers(0, 2**63, 4000, dtype=np.uint64))
    kinds = dict(zip(universe.tolist(), rng.choice(3, len(universe), p=[0.2, 0.3, 0.5])))
    tried = 0
    for _ in range(6000):
        n = int(rng.integers(1, 60))
        frequent_only = rng.random() < 0.5
        pool = [u for u in universe[:400].tolist() if kinds[u] == 2] if frequent_only else universe[:400].tolist()
        if len(pool) < n + 15:
            continue
        picked = rng.choice(np.array(pool, np.uint64), n + 15, replace=False)
        drop = int(rng.integers(0, 1 + n // 4))
        a, b = np.sort(picked[:n]), np.sort(np.concatenate([picked[drop:n], picked[n : n + int(rng.integers(0, 1 + n // 4))]]))
        if not len(b) or not ngram_join.linked(a, b):
            continue
        # a token that both hold cannot be unique
        kind = lambda s: np.array([1 if kinds[t] == 0 and t in both else kinds[t] for t in s.tolist()])
        both = set(a.tolist()) & set(b.tolist())
        keys = [set(ngram_join.index_keys(s, kind(s)).tolist()) for s in (a, b)]
        tried += 1
        assert keys[0] & keys[1], (a, b)
        assert ngram_join.may_link(len(a), ngram_join.parity_bits(a), len(b), ngram_join.parity_bits(b))
    assert tried > 500


def clouds(seed, n=150):
    """Texts made of few words in many orders: they share two-token combinations without linking."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        blocks = [f"p{b} q{b} r{b} s{b} t{b} u{b}" for b in range(12)]
        rng.shuffle(blocks)
        t = " ".join(blocks[: rng.randrange(5, 12)])
        out.append((i, t, "en", "s", 0))
        if rng.random() < 0.4:
            out.append((1000 + i, t + f" x{i}", "en", "s", 0))
    return out


@pytest.mark.parametrize("bucket", [4, 20])
def test_buckets_beyond_the_bound_are_compared_by_segments(spark, monkeypatch, bucket):
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)  # keys with many times as many members
    monkeypatch.setattr(ngram_join, "RARE", 2)
    for data in (clouds(3), family(5)):
        assert table(ngram_join.near_groups(corpus.frame(spark, data)), "doc_id", "n_shingles", "component_id") == plain_components(data)


def test_linked_sets_share_a_segment():
    rng = np.random.default_rng(11)
    tried = 0
    for _ in range(8000):
        n = int(rng.integers(1, 90))
        picked = np.unique(rng.integers(0, 2**63, n + 30, dtype=np.uint64))
        drop = int(rng.integers(0, 1 + n // 4))
        a, b = np.sort(picked[:n]), np.sort(np.concatenate([picked[drop:n], picked[n : n + int(rng.integers(0, 1 + n // 4))]]))
        if len(b) and ngram_join.linked(a, b):
            tried += 1
            assert set(ngram_join.segment_keys(a).tolist()) & set(ngram_join.segment_keys(b).tolist())
    assert tried > 2000


def test_near_groups_with_a_sketch_that_is_joined(spark, docs, data, monkeypatch):
    monkeypatch.setattr(ngram_join.countmin, "BROADCAST_CELLS", 0)
    assert table(ngram_join.near_groups(docs), "doc_id", "n_shingles", "component_id") == plain_components(data)


def test_dropping_near_copies(docs, data):
    out = ngram_join.drop_near_copies(docs)
    assert out.columns == docs.columns
    want = {k[0] for k in plain_components(data) if k[0] == k[2]}
    assert {r["doc_id"] for r in out.collect()} == want


def test_unlinked_rows_under_one_id_all_stay(spark):
    rng = random.Random(8)
    some = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    near = some(100)
    linked = [(4, near), (9, near + " tail"), (None, near + " other tail")]
    lone = [(None, some(30)), (None, some(40)), (None, some(50)), (7, some(30)), (7, some(40)), (None, ""), (7, None), (7, " ")]
    nameless = [(None, x) for x in ("a b c d e " + some(80),)]
    docs = corpus.frame(spark, [(i, x, "en", "s", 0) for i, x in linked + lone + nameless])
    out = table(ngram_join.drop_near_copies(docs), "doc_id", "text")
    assert out == Counter([linked[0], *lone, *nameless])


# -- 9 substring dedup

def plain_substrings(data):
    at = defaultdict(set)
    for r in data:
        ws = corpus.words(r[1])
        for i in range(len(ws) - 49):
            at[tuple(ws[i : i + 50])].add(r[0])
    out = Counter()
    for r in data:
        ws = corpus.words(r[1])
        gone = {i + j for i in range(len(ws) - 49) if min(at[tuple(ws[i : i + 50])]) < r[0] for j in range(50)}
        out[(r[0], len(ws), len(gone), sha(" ".join(w for i, w in enumerate(ws) if i not in gone)))] += 1
    return out


def test_substring_dedup(docs, data):
    want = plain_substrings(data)
    assert sum(k[2] > 0 for k in want) > 5
    assert table(substring_dedup.removed_words(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_substrings_with_a_full_sketch(spark, data, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CELLS_PER_ANCHOR", 1e-9)  # everything looks repeated
    assert table(substring_dedup.removed_words(corpus.frame(spark, data)), "doc_id", "n_words", "n_removed", "kept_sha256") == plain_substrings(data)


def test_substrings_with_a_sketch_that_is_joined(spark, data, monkeypatch):
    monkeypatch.setattr(substring_dedup.countmin, "BROADCAST_CELLS", 0)
    assert table(substring_dedup.removed_words(corpus.frame(spark, data)), "doc_id", "n_words", "n_removed", "kept_sha256") == plain_substrings(data)


def test_all_copies_of_a_run_lose_windows(spark):
    rng = random.Random(4)
    some = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    t, passage, around, left, right = some(60), some(60), some(40), some(70), some(70)
    last = 10**6  # stands for a null id: rows without an id take nothing from each other
    data = [(5, t), (10, " ".join([t] * 4)), (11, " ".join([around, passage, around])), (12, " ".join([left, passage, right, left, passage, right]))]
    data += [(20, some(60) + " " + t + " " + some(60)), (last, f"{left} {t} {right} {some(9)}"), (last, f"{some(9)} {left} {t} {right}"), (last, f"{left} {t} {right}")]
    data = [(i, x, "en", "s", 0) for i, x in data]
    want = plain_substrings(data)
    assert {k[0]: k[2] for k in want}[10] == 240 and {k[0]: k[2] for k in want}[12] > 100
    docs = corpus.frame(spark, [(None if r[0] == last else r[0], *r[1:]) for r in data])
    assert table(substring_dedup.removed_words(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == Counter({(None if k[0] == last else k[0], *k[1:]): n for k, n in want.items()})


# -- 8 mixing

def test_targets_share_all_words(spark):
    sources = spark.createDataFrame([("b", 10), ("a", 1000), (None, 300), ("c", 0), ("d", 5)], "source string, size long")
    rows = {r["source"]: r for r in mixing.targets(sources).collect()}
    assert [rows[s]["weight"] for s in ("a", "b", "c", "d", None)] == [1, 2, 3, 1, 2]
    assert abs(sum(r["target"] for r in rows.values()) - 1315) < 1e-6 and rows["c"]["target"] == 0
    assert rows["b"]["target"] == 30 and rows["d"]["target"] == 15 and abs(rows[None]["target"] - 846.6666) < 0.01


def test_mix_comes_near_its_targets(docs, data):
    out = [r.asDict() for r in mixing.mix_words(docs).collect()]
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((r[0], len(corpus.words(r[1]))) for r in data)
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] % max(r["size"], 1) == 0 for r in out)
    again = Counter(tuple(r.values()) for r in out)
    assert again == Counter(tuple(r.asDict().values()) for r in mixing.mix_words(docs).collect())
    source = defaultdict(list)
    by = {(r[0], len(corpus.words(r[1]))): r[3] for r in data}
    for r in out:
        source[by[(r["doc_id"], r["size"])]].append(r)
    for some in source.values():
        target, sizes = some[0]["target"], [r["size"] for r in some if r["size"]]
        assert target <= 3 * some[0]["source_size"] + 1e-6 and sum(r["size"] for r in some) == some[0]["source_size"]
        assert abs(sum(r["taken"] for r in some) - target) <= max(sizes, default=0)


def test_quotas_are_exact_and_hypergeometric(spark):
    quotas = spark.createDataFrame([(1, 40), (2, 160), (3, 0), (4, 7)], "sno int, quota long")
    means = []
    for seed in range(12):
        rows = mixing.shard_quotas(quotas, 3, seed).collect()
        by, shard = defaultdict(int), defaultdict(int)
        for r in rows:
            by[r["sno"]] += r["quota"]
            shard[r["shard"]] += r["quota"]
        assert by == {1: 40, 2: 160, 3: 0, 4: 7} and len(shard) == 8
        assert max(shard.values()) - min(shard.values()) <= 3
        means += [r["quota"] for r in rows if r["sno"] == 1]
    assert abs(np.mean(means) - 5) < 1e-9
    # the law's spread: n K/N (1 - K/N) (N - n)/(N - 1) for n = 26 of N = 207, K = 40
    assert 1.9 < np.var(means) < 5.5


def test_hypergeometric_draw_has_its_law(spark):
    sql = mixing.hypergeometric("30L", "12L", "10L", "(id + 0.5D) / 4000D")
    got = Counter(r[0] for r in spark.range(4000).selectExpr(f"{sql} AS x").collect())
    from math import comb

    for k in range(11):
        assert abs(got[k] / 4000 - comb(12, k) * comb(18, 10 - k) / comb(30, 10)) < 0.001


def test_mixed_rows_follow_the_plan(docs, data):
    docs = docs.withColumn("_draws", F.lit("own")).withColumn("_draw", F.lit(2))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns and out.where("_draws <> 'own' or _draw <> 2").isEmpty()
    times = Counter()
    for r in mixing.mix_words(docs).collect():
        if r["size"]:
            times[(r["doc_id"], r["size"])] += r["taken"] // r["size"]
    assert Counter((r["doc_id"], len(corpus.words(r["text"]))) for r in out.collect()) == +times


# -- 1 SentencePiece

MODEL = sentencepiece_codec.MODEL
needs_model = pytest.mark.skipif(not Path(MODEL).exists(), reason="needs the public tokenizer files")


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.Codec(sentencepiece_codec.Vocabulary.read(MODEL))


@needs_model
def test_every_text_comes_back(docs, data):
    out = sentencepiece_codec.encoded(docs)
    rows = out.collect()
    assert len(rows) == len(data) and all(r["same"] for r in rows)
    assert Counter((r["doc_id"], r["text_sha256"]) for r in rows) == Counter((r[0], sha(r[1] or "")) for r in data)
    assert all((r["n_pieces"] == 0) == (not t) for r, t in ((r, None) for r in rows if r["n_pieces"]) if t)


@needs_model
@pytest.mark.parametrize("text", ["", " ", "  ", "a  b ", "\n", "▁", " ▁ ", "x" * 500, "日本語 \U0001f600‍", "a\x00b\tc", "word" * 400 + " tail"])
def test_odd_texts_come_back(codec, text):
    ids = np.frombuffer(codec.encode([text])[0], np.int32).tolist()
    assert codec.decode(ids).decode() == text


@needs_model
def test_viterbi_finds_the_best_path(codec):
    scores = {codec.v.pieces[i]: float(codec.v.scores[i]) for i in np.flatnonzero(codec.v.matches)}
    rng = random.Random(2)
    raw = [codec.raw("".join(rng.choice("theandré ßx0\n") for _ in range(rng.randrange(1, 14))).strip(" ")) for _ in range(300)]

    def best(r):
        chars = [c.encode() for c in r.decode()]
        ends = np.cumsum([0] + [len(c) for c in chars]).tolist()
        top = [0.0] + [-1e18] * len(chars)
        for j in range(1, len(chars) + 1):
            for i in range(max(0, j - 50), j):
                piece = r[ends[i] : ends[j]]
                s = scores.get(piece, codec.unknown if j == i + 1 else -1e18)
                top[j] = max(top[j], top[i] + s)
        return top[-1]

    for r, ids in zip(raw, codec._together(raw)):
        ids = np.frombuffer(ids, np.int32)
        assert ids.tobytes() == codec._alone(r)
        byte = codec.is_byte[ids]
        lead = [b for b in (codec.texts[i] for i in ids[byte]) if b[0] & 0xC0 != 0x80]
        assert abs(codec.v.scores[ids[~byte]].sum() + codec.unknown * len(lead) - best(r)) < 1e-6


@needs_model
def test_the_trie_holds_the_pieces_and_no_more(codec):
    t = codec.trie
    for i in np.flatnonzero(codec.v.matches)[::37]:
        state = 0
        for b in codec.v.pieces[i]:
            child = t.base[state] + b + 1
            assert t.check[child] == state
            state = child
        assert t.value[state] == i
    assert (t.value >= 0).sum() == codec.v.matches.sum()


@needs_model
def test_stored_log_scores_are_kept():
    own = np.array([0.0, -3.5, -4.25, -9.1])
    assert sentencepiece_codec.log_scores(own, np.array([False, True, True, True])).tolist() == [0.0, -3.5, -4.25, -9.1]


@needs_model
def test_long_segments_are_cut_where_no_piece_crosses(codec):
    rng = random.Random(9)
    texts = ["".join(rng.choice("日本語中文字汉학교ก่กaé▁ \U0001f600") for _ in range(3000)), "".join(rng.choice("abcdefABCDEF0123456789+/") for _ in range(2000)), "東京" * 900]
    def score(ids):  # equal paths may differ where their sums tie
        ids = np.frombuffer(ids, np.int32)
        byte = codec.is_byte[ids]
        leads = sum(codec.texts[i][0] & 0xC0 != 0x80 for i in ids[byte])
        return codec.v.scores[ids[~byte]].sum() + codec.unknown * leads

    for text in texts:
        ids = codec.encode([text])[0]
        whole = b"".join(codec._alone(codec.raw(x)) for x in codec.segments(text))
        assert abs(score(ids) - score(whole)) < 1e-6 and codec.decode(np.frombuffer(ids, np.int32).tolist()).decode() == text
    assert max(len(u) for u in codec.units(texts[0])) < 200


@needs_model
def test_the_cache_is_bounded_by_bytes(codec, monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "CACHE_BYTES", 20_000)
    rng = random.Random(10)
    held = []
    for _ in range(40):
        codec.encode([" ".join("".join(rng.choice("abcdefghij") for _ in range(12)) for _ in range(30)) + " " + "".join(rng.choice("abcdefghij") for _ in range(5000))])
        held.append(codec.cached)
        assert codec.cached == sum(sentencepiece_codec.ENTRY_BYTES + len(k) + len(v) for k, v in codec.cache.items())
    assert max(held) < 20_000 + 120_000 and all(len(k) <= sentencepiece_codec.LONG_SEGMENT for k in codec.cache)


@needs_model
def test_pieces_beside_a_column_of_that_name(docs):
    own = docs.withColumn("piece_ids", F.lit("own"))
    out = sentencepiece_codec.with_pieces(own)
    assert out.columns == [*own.columns, "_piece_ids"] and out.where("piece_ids <> 'own'").isEmpty()


@needs_model
def test_decoding_a_table(spark, docs, codec):
    out = sentencepiece_codec.decode_table(sentencepiece_codec.with_pieces(docs.select("doc_id", "text")), codec)
    assert out.where("decoded <> coalesce(text, '')").count() == 0


# -- 2 licence scan

def plain_licenses(data):
    out = Counter()
    for r in data:
        ws = corpus.words((r[1] or "").translate(LOWER), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
        places = [(i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(ws)) if ws[i : i + len(phrase.split())] == phrase.split()]
        at = [p for p, _ in places]
        out[(r[0], len(ws), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))] += 1
    return out


def test_license_base(docs, data):
    assert table(license_scan.licenses(docs), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == plain_licenses(data)


def plain_spans(text):
    """(label, share) of the templates that a text holds, by plain loops over words."""
    pattern, k, out = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", license_scan.K, set()
    ws = corpus.words((text or "").translate(LOWER), pattern)
    for label, template in license_scan.TEMPLATES:
        own = corpus.words(template.translate(LOWER), pattern)
        grams, wide = len(own) - k + 1, len(own) + license_scan.GAP
        hits = [(i, j) for i in range(len(ws) - k + 1) for j in range(grams) if ws[i : i + k] == own[j : j + k]]
        for row in (0, 1):
            bands = defaultdict(list)
            for i, j in hits:
                bands[(i - j + row * wide) // (2 * wide)].append((i - j, i, j))
            for band in bands.values():
                parts, last = [], None
                for d, i, j in sorted(band):
                    if last is None or d - last > license_scan.GAP:
                        parts.append([])
                    parts[-1].append((i, j))
                    last = d
                for part in parts:
                    if len({j for _, j in part}) < license_scan.MIN_VOTES * grams:
                        continue
                    start, stop = min(i for i, _ in part), max(i for i, _ in part) + k
                    a = max(0, start - min(j for _, j in part) - license_scan.GAP)
                    b = stop + len(own) - max(j for _, j in part) - k + license_scan.GAP
                    table = [[0] * (len(own) + 1)]
                    for w in ws[a:b]:
                        up, now = table[-1], [0]
                        for n, x in enumerate(own):
                            now.append(up[n] + 1 if w == x else max(up[n + 1], now[n]))
                        table.append(now)
                    if table[-1][-1] / len(own) >= license_scan.MIN_MATCH:
                        out.add((label, table[-1][-1] / len(own)))
    return out


def notices(seed=5):
    rng = random.Random(seed)
    out = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            ws = rng.choice(license_scan.TEMPLATES)[1].split()
            for _ in range(rng.randrange(0, 1 + len(ws) // 4)):
                at = rng.randrange(len(ws))
                ws[at : at + 1] = rng.choice([[], ["other"], [ws[at], "more"]])
            parts += [f"w{rng.randrange(30)}" for _ in range(rng.randrange(0, 40))] + ws
        out.append((i, " ".join(parts), "", "", 0))
    repeated = " ".join(f"the terms of x{i}" for i in range(300))
    return out + [(60, repeated, "", "", 0), (61, (license_scan.TEMPLATES[1][1] + " ") * 50, "", "", 0), (62, None, "", "", 0)]


def test_license_labels_and_scores(spark, data):
    rows = notices() + [(100 + i, *r[1:]) for i, r in enumerate(data)]
    got = {r["doc_id"]: r for r in license_scan.licenses(corpus.frame(spark, rows)).collect()}
    labelled = 0
    for i, text, *_ in rows:
        spans = plain_spans(text)
        labelled += bool(spans)
        base = {x for x in got[i]["base_labels"].split(",") if x}
        assert got[i]["labels"] == ",".join(sorted(base | {x for x, _ in spans})), i
        assert abs(got[i]["score"] - max((m for _, m in spans), default=0.0)) < 1e-12
    assert labelled > 30


def test_license_spans_survive_edits(spark):
    mit = license_scan.TEMPLATES[2][1]
    changed = mit.replace("obtaining a copy of this software", "obtaining one single copy of this software").replace("without limitation", "")
    filler = "some other words " * 30
    data = [(1, filler + mit + ". " + filler, "", "", 0), (2, filler + changed, "", "", 0), (3, filler + mit[: len(mit) // 4], "", "", 0), (4, "x\nLicensed under the Apache License,\nVersion 2.0.", "", "", 0), (5, None, "", "", 0)]
    rows = {r["doc_id"]: r for r in license_scan.licenses(corpus.frame(spark, data)).collect()}
    assert [rows[i]["labels"] for i in range(1, 6)] == ["mit", "mit", "", "apache-2.0", ""]
    assert rows[1]["score"] == 1.0 and 0.8 <= rows[2]["score"] < 1 and rows[5]["score"] == 0.0


# -- 4 surrogates

def test_surrogates_replace_consistently(docs, data):
    rows = pii_surrogates.surrogate_texts(docs, key="k").collect()
    assert len(rows) == len(data)
    texts = " ".join(r["text"] for r in rows)
    for gone in ("Anna.Smith@mail.example.com", "201-7788", "4111111111111111", "10.2.3.4 "):
        assert gone not in texts
    held = {m for r in rows for m in re.findall(r"\S+@\S+", r["text"])}
    assert len(held) == 1 and all(r["n_entities"] == 4 for r in rows if "@" in r["text"])
    cards = set(re.findall(r"card (\d{16})", texts))
    assert len(cards) == 1 and all(pii_surrogates.luhn(c) and c[0] == "4" for c in cards)
    clean = Counter((r[0], r[1] or "") for r in data if "@" not in (r[1] or ""))
    assert clean == Counter((r["doc_id"], r["text"]) for r in rows if not r["n_entities"])


def test_names_keep_gender_script_and_coreference(spark):
    data = [(1, "Mrs. Anna Keller met Mr. Tom Keller. Then Mrs. KELLER left; Г-жа Анна Иванова stayed.", "", "", 0)]
    text = pii_surrogates.surrogate_texts(corpus.frame(spark, data), key="k").first()["text"]
    m = re.match(r"Mrs\. (\w+) (\w+) met Mr\. (\w+) (\w+)\. Then Mrs\. (\w+) left; Г-жа ([а-яА-Я]+) ([а-яА-Я]+) stayed\.", text)
    assert m and m[2] == m[4] and m[5] == m[2].upper() and m[1] != m[3] and "Keller" not in text
    assert re.search("(a|elle)$", m[1]) and not m[3].endswith("a")


def test_collisions_are_settled(spark, tmp_path, monkeypatch):
    real = pii_surrogates.surrogate

    def colliding_draws(batches, key):
        for batch in batches:
            made = [f"{(int(v) * 7 + a * 13) % 12 + a:04d}" for v, a in zip(batch.column("value").to_pylist(), batch.column("attempt").to_pylist())]
            yield pa.record_batch([*(batch.column(c) for c in ("kind", "value", "attempt")), pa.array(made)], ["kind", "value", "attempt", "made"])

    # a generator that nearly always collides at first, and may hit real entities
    monkeypatch.setattr(pii_surrogates, "draws", colliding_draws)
    entities = spark.createDataFrame([("phone", f"{i:04d}") for i in range(16)], "kind string, value string")
    out = [r.asDict() for r in pii_surrogates.assign(entities, str(tmp_path), "k", rounds=400).collect()]
    made = [r["made"] for r in out]
    assert len(out) == 16 and len(set(made)) == 16 and not set(made) & {f"{i:04d}" for i in range(16)}
    assert real("card", "4111111111111111", 0, "k") == real("card", "4111111111111111", 0, "k") != real("card", "4111111111111111", 0, "other")


def people(seed=6):
    rng = random.Random(seed)
    given, family = ["Anna", "Peter", "Kim", "Irina", "Luis"], ["Keller", "Smith", "Okafor", "Novak"]
    out = []
    for i in range(60):
        a, b = rng.choice(given), rng.choice(family)
        parts = [f"{rng.choice(['Mr.', 'Mrs.', 'Dr'])} {a} {b} wrote.", f"Then {a} said so, and {b.upper()} too.", f"mail {a}.{b}@example.com", f"call {rng.randrange(200, 209)}-555-0{rng.randrange(100, 109)}",
                 f"from 192.168.{rng.randrange(3)}.{rng.randrange(1, 9)}", f"ssn {rng.randrange(100, 103)}-12-{rng.randrange(1000, 1003)}", "nothing here"]
        out.append((i, " ".join(rng.sample(parts, rng.randrange(1, 6))), "", "", 0))
    return out + [(99, None, "", "", 0), (98, "Anna and Keller are words here", "", "", 0)]


def plain_surrogates(data, key):
    """The same rules one entity after the other: detection, rounds of draws, layout."""
    import xxhash

    def order(kind, value):  # as the engine's own hash of two strings
        h = xxhash.xxh64_intdigest(value.encode(), seed=xxhash.xxh64_intdigest(kind.encode(), seed=42))
        return h - 2**64 if h >= 2**63 else h

    space = lambda kind: "given" if kind.startswith("given_") else kind
    found = {r: pii_surrogates.detect(r[1] or "") for r in data}
    said = defaultdict(Counter)
    for some in found.values():
        for *_, kind, value, gender in some:
            said[kind, value][gender] += 1

    def of(kind, value):  # the name's gender over all documents
        if kind != "given":
            return kind, value
        votes = said[kind, value]
        known = "f" if value.capitalize() in pii_surrogates.FEMALE else "m" if value.capitalize() in pii_surrogates.MALE else "n"
        return "given_" + ("f" if votes["f"] > votes["m"] else "m" if votes["m"] > votes["f"] else known), value

    open_ = sorted({of(kind, value) for kind, value in said}, key=lambda e: order(*e))
    taken, made, turn = {(space(k), v) for k, v in open_}, {}, 0
    while open_:
        drawn = [(e, (space(e[0]), pii_surrogates.surrogate(*e, turn, key))) for e in open_]
        for e, s in drawn:
            if s not in taken:
                taken.add(s)
                made[e] = s[1]
        open_, turn = [e for e in open_ if e not in made], turn + 1
    out = Counter()
    for r, some in found.items():
        text = r[1] or ""
        for start, stop, kind, value, _ in reversed(some):
            text = text[:start] + pii_surrogates.in_layout(kind, made[of(kind, value)], text[start:stop]) + text[stop:]
        out[(r[0], len(some), text)] += 1
    return out


def test_surrogates_against_a_plain_version(spark):
    data = people()
    want = plain_surrogates(data, "another key")
    assert table(pii_surrogates.surrogate_texts(corpus.frame(spark, data), key="another key"), "doc_id", "n_entities", "text") == want
    assert sum(k[1] for k in want) > 150 and want[(98, 0, "Anna and Keller are words here")] == 1


def test_later_mentions_of_a_name_follow_it(spark):
    text = "Mrs. Anna Keller came. Anna said that KELLER and Annabel stay; anna too."
    made = pii_surrogates.surrogate_texts(corpus.frame(spark, [(1, text, "", "", 0)]), key="k").first()["text"]
    m = re.fullmatch(r"Mrs\. (\w+) (\w+) came\. (\w+) said that (\w+) and Annabel stay; anna too\.", made)
    assert m and m[1] == m[3] != "Anna" and m[4] == m[2].upper() != "KELLER"


def test_surrogates_need_a_key_and_keep_columns(spark):
    docs = corpus.frame(spark, [(1, "x a@b.com", "", "", 0)]).withColumn("n_entities", F.lit("own"))
    with pytest.raises(ValueError):
        pii_surrogates.Surrogates(docs)
    out = pii_surrogates.Surrogates(docs, key="k").apply()
    assert out.columns == [*docs.columns, "_n_entities"] and out.first()["n_entities"] == "own" and out.first()["_n_entities"] == 1


# -- 5 classifier

def test_masked_secrets_settle(spark):
    text = 'password = "********" then token: "--------"'
    out = pii_surrogates.surrogate_texts(corpus.frame(spark, [(1, text, "", "", 0)]), key="k").first()
    m = re.fullmatch(r'password = "([a-z]{8})" then token: "([a-z]{8})"', out["text"])
    assert out["n_entities"] == 2 and m and m[1] != m[2]


def test_more_entities_than_half_their_space(spark, tmp_path):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [("email", f"{a}@{b}.com") for a in letters for b in letters]
    rows += [("ip", f"192.168.{a}.{b}") for a in range(1, 161) for b in range(1, 255)]
    rows += [("secret", f"*****{a}") for a in letters] + [("ssn", f"{a:02d}") for a in range(100)]
    entities = spark.createDataFrame(rows, "kind string, value string")
    out = [(r["kind"], r["made"]) for r in pii_surrogates.assign(entities, str(tmp_path), "k", rounds=20).collect()]
    assert len(out) == len(rows) == len(set(out)) and not set(out) & set(rows)


def test_longer_surrogates_in_their_layout():
    for kind, mention, value in (("phone", "(201) 555-7788", "2015557788"), ("card", "4111 1111 1111 1111", "4111111111111111"), ("account", "DE44 5001 0517 54", "DE445001051754")):
        made = pii_surrogates.surrogate(kind, value, 7, "k")
        assert len(made) == len(value) + 2 and re.sub(r"[^0-9A-Z]", "", pii_surrogates.in_layout(kind, made, mention)) == made
    assert pii_surrogates.luhn(pii_surrogates.surrogate("card", "4111111111111111", 7, "k"))
    assert pii_surrogates.surrogate("ip", "192.168.1.1", 3, "k").startswith("10.") and pii_surrogates.surrogate("ip", "192.168.1.1", 6, "k").startswith("fd00:")


def graded(n=600, seed=3):
    rng = random.Random(seed)
    data, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        ws = ["".join(rng.choice("aeilnorst") for _ in range(rng.randrange(2, 9))) for _ in range(rng.randrange(30, 120))]
        text = " ".join(ws) + "." if good else rng.choice([" | ".join(ws), " ".join(w + "%%%" for w in ws), " ".join(w.upper() + "!!" for w in ws), " ".join(w for w in ws[:6] for _ in range(20))])
        data.append((i, text, "en", f"s{i % 4}", 0))
        labels.append((i, int(good)))
    return data, labels


def test_classifier_tells_held_out_rows_apart(spark):
    data, labels = graded()
    seen = spark.createDataFrame(labels[:300], "doc_id long, quality int")
    out = {r["doc_id"]: r for r in quality_classifier.quality_scores(corpus.frame(spark, data), seen).collect()}
    hits = sum((out[i]["score"] >= 0.5) == bool(q) for i, q in labels[300:])
    assert hits / 300 > 0.95
    assert sum(out[i]["kept"] for i, q in labels if q) / sum(q for _, q in labels) > 0.97


def test_words_count_as_evidence(spark):
    """Only their words tell good from bad documents here; held-out rows are ranked by area under the curve."""
    rng = random.Random(12)
    common, good, bad = ([f"{x}{i}" for i in range(80)] for x in ("c", "g", "b"))
    data, labels = [], []
    for i in range(500):
        q = rng.random() < 0.5
        data.append((i, " ".join(rng.choice(common if rng.random() < 0.8 else good if q else bad) for _ in range(60)), "en", f"s{i % 3}", 0))
        labels.append((i, int(q)))
    out = {r["doc_id"]: r["evidence"] for r in quality_classifier.quality_scores(corpus.frame(spark, data), spark.createDataFrame(labels[:300], "doc_id long, quality int")).collect()}
    high, low = ([out[i] for i, q in labels[300:] if q == side] for side in (1, 0))
    assert np.mean([(a > b) + 0.5 * (a == b) for a in high for b in low]) > 0.97


def plain_posteriors(rows):
    """rows (id, host, path, evidence, vote) -> (id, host_rate, path_rate, score)."""
    votes = lambda some: np.array([r[4] for r in some])
    by = lambda k, some=rows: {x: [r for r in some if r[k] == x] for x in {r[k] for r in some}}
    hosts, paths, rate = by(1), by(2), votes(rows).mean()

    def prior(groups, above):
        spread = chance = within = n = 0.0
        for g, some in groups.items():
            if len(some) > 1:
                v = votes(some)
                spread += len(v) * (v.mean() - above[g]) ** 2
                chance += v.var(ddof=1)
                within += len(v) * v.var(ddof=1)
                n += len(v)
        return np.clip(within / n / max((spread - chance) / n, 1e-9), *quality_classifier.PRIOR) if n else quality_classifier.PRIOR[1]

    k_host = prior(hosts, dict.fromkeys(hosts, rate))
    host_rate = {h: (votes(some).sum() + k_host * rate) / (len(some) + k_host) for h, some in hosts.items()}
    k_path = prior(paths, {p: host_rate[some[0][1]] for p, some in paths.items()})
    odds, out = lambda p: np.log(p / (1 - p)), {}
    for i, host, path, e, v in rows:
        h = (votes(hosts[host]).sum() - v + k_host * rate) / (len(hosts[host]) - 1 + k_host)
        p = (votes(paths[path]).sum() - v + k_path * h) / (len(paths[path]) - 1 + k_path)
        e, p = (min(max(x, 1e-6), 1 - 1e-6) for x in (e, p))
        out[i] = (h, p, 1 / (1 + np.exp(-(odds(e) + odds(p) - odds(rate)))))
    return out


def test_posteriors_against_a_plain_version(spark):
    rng = random.Random(13)
    data, labels = graded(300)
    data = [(i, text, rng.choice(["en", "de", "fr"]), rng.choice(["a", "a", "a", "b", "c"]), 0) for i, text, *_ in data] + [(900, "lone text", None, None, 0)]
    seen = labels[:150]
    out = {r["doc_id"]: r for r in quality_classifier.quality_scores(corpus.frame(spark, data), spark.createDataFrame(seen, "doc_id long, quality int")).collect()}
    mark = dict(seen)
    want = plain_posteriors([(i, host, (host, lang), out[i]["evidence"], mark.get(i, out[i]["evidence"])) for i, _, lang, host, _ in data])
    for i, (h, p, score) in want.items():
        r = out[i]
        assert max(abs(r["host_rate"] - h), abs(r["path_rate"] - p), abs(r["score"] - score)) < 2e-6 and r["kept"] == (r["score"] >= 0.25)


def test_prior_weight_finds_the_spread_of_sites(spark):
    """Sites whose rates are drawn from Beta(6, 4) are worth about 10 documents."""
    rng = np.random.default_rng(14)
    rows = []
    for _ in range(4000):
        v = (rng.random(20) < rng.beta(6, 4)).astype(float)
        rows.append((20, float(v.sum()), float((v * v).sum()), 0.6))
    k = quality_classifier.prior_weight(spark.createDataFrame(rows, "n long, s double, q double, above double"), "above")
    assert 8 < k < 12


def test_sparse_sites_shrink_toward_their_host(spark):
    data, labels = graded()
    bad = [(1000 + i, " | ".join(["abc", "defg"] * 40), "zz", "s9", 0) for i in range(40)]
    lone = [(2000, data[0][1], "only", "s9", 0), (2001, data[0][1], "only", "new", 0)]
    rows = {r["doc_id"]: r for r in quality_classifier.quality_scores(corpus.frame(spark, data + bad + lone), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    assert rows[2000]["path_rate"] < rows[2001]["path_rate"] and rows[2000]["evidence"] == rows[2001]["evidence"]
    assert rows[1000]["path_rate"] < rows[0]["path_rate"] and not rows[1000]["kept"]


def test_classifier_on_odd_rows(spark, docs, data):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality_classifier.quality_scores(docs, none).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in data) and all(r["evidence"] == 0.5 for r in rows)


# -- all of them

CALLS = {
    "op1": lambda d: sentencepiece_codec.encoded(d), "op2": license_scan.licenses, "op3": line_dedup.dedup_lines, "op4": lambda d: pii_surrogates.surrogate_texts(d, key="k"),
    "op5": lambda d: quality_classifier.quality_scores(d, d.sparkSession.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")),
    "op6": quality_rules.quality_rules, "op7": ngram_join.near_groups, "op8": mixing.mix_words, "op9": substring_dedup.removed_words, "op10": exact_dedup.exact_groups,
}


@pytest.mark.parametrize("name", sorted(CALLS))
def test_empty_tables_give_empty_results(empty, name):
    assert CALLS[name](empty).count() == 0


@pytest.mark.parametrize("name", sorted(CALLS))
def test_null_ids_are_rows_like_others(spark, name):
    data = [(None, "a b c d e f", None, None, None), (None, None, None, None, None), (3, "a b c d e f", "en", "s", 1), (None, "a b c d e f", "en", "s", 1)]
    rows = CALLS[name](corpus.frame(spark, data)).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter([None, None, None, 3])


def long_texts():
    """Texts of some MB: without spaces, of one line, of very many lines, of one word, and a copy."""
    rng = random.Random(15)
    words = [f"w{rng.randrange(10**5)}" for _ in range(300_000)]
    lines = "\n".join(" ".join(words[i : i + 9]) for i in range(0, 180_000, 9))
    return [(1, "x" * 2_000_000, "en", "s", 0), (2, " ".join(words), "en", "s", 0), (3, lines, "en", "s", 0), (4, "日本" * 200_000, "ja", "s", 0), (5, " ".join(words), "en", "t", 0), (6, "word " * 200_000, "en", "t", 0)]


@pytest.mark.parametrize("name", sorted(CALLS))
def test_very_long_texts(spark, name):
    data = long_texts()
    rows = {r["doc_id"]: r for r in CALLS[name](corpus.frame(spark, data)).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6]
    plain = {
        "op3": lambda: Counter((i, r["n_lines"], r["n_dropped"], r["kept_sha256"]) for i, r in rows.items()) == plain_lines(data),
        "op10": lambda: all(r["text_sha256"] == sha(one_space(t)) for (i, t, *_), r in zip(data, (rows[k] for k in range(1, 7)))) and rows[5]["keep_id"] == 2,
        "op7": lambda: rows[5]["component_id"] == 2 and rows[2]["n_shingles"] > 290_000 and rows[3]["component_id"] == 3,
        "op9": lambda: rows[5]["n_removed"] == 300_000 and rows[2]["n_removed"] == 0 and rows[3]["n_removed"] > 170_000,
        "op1": lambda: all(r["same"] for r in rows.values()),
        "op6": lambda: [rows[i]["n_words"] for i in range(1, 7)] == [1, 300_000, 180_000, 1, 300_000, 200_000] and rows[6]["n_repeat_words"] == 200_000,
        "op8": lambda: all(r["taken"] <= 3 * r["size"] for r in rows.values()),
    }
    assert plain.get(name, lambda: True)()
