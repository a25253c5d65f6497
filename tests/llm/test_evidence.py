"""The classifier's evidence against measures and word weights in plain Python."""

import math
import random
import re
import struct
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import xxhash

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402

from chordgrid.llm import quality_classifier as Q  # noqa: E402


def signed(h):
    return h - 2**64 if h >= 2**63 else h


def string_hash(*words):
    seed = 42
    for w in words:
        if w is not None:
            seed = xxhash.xxh64_intdigest(w.encode(), seed=seed)
    return signed(seed)


def id_hash(i):
    return signed(xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42)) % (1 << 40)


def buckets(text):
    words = corpus.words((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    out = []
    for i, w in enumerate(words):
        after = words[i + 1] if i + 1 < len(words) else None
        out += [string_hash(w) % Q.BUCKETS, string_hash(after, w) % Q.BUCKETS]
    return out


def plain_measures(text, weights):
    text = text or ""
    words, chars = corpus.words(text), max(len(text), 1)
    n, found = max(len(words), 1), buckets(text)
    count = lambda pattern: len(re.findall(pattern, text, re.ASCII)) / chars
    return [
        count(r"[#*$%&|<>]+") * 10, count(r"[!?]{2,}") * 10, count("[A-Z]"), count("[0-9]") * 4, count("[.,;:]") * 10, count(r" \| ") * 10, min(chars / n / 20, 1.0),
        1 - len(set(words)) / n if words else 0.0, math.log1p(len(words)) / 10, count("\n") * 20, len(re.findall(r"\b(\w+)[ \t\n\v\f\r]+\1\b", text, re.ASCII)) / n,
        sum(weights[b] for b in found) / len(found) if found else 0.0]


def test_evidence_equals_a_plain_one(spark, tmp_path):
    rng = random.Random(12)
    good, bad = ["river", "stone", "above", "garden", "light"], ["click", "BUY", "now!!", "###", "win", "win"]
    rows = [(i, " ".join(rng.choice(good if i % 3 else bad) for _ in range(rng.randrange(0, 60))) + rng.choice(["", ".", " | x", "\n7"]), "en", f"h{i % 5}", 0) for i in range(200)]
    rows += [(900, None, "en", "h1", 0), (901, "word " * 40_000, "de", "h1", 0)]
    labels = [(i, 1 if i % 3 else 0) for i in range(0, 200, 2)] + [(7, 1), (7, 0), (9, None), (5000, 1)]
    got = {r["doc_id"]: r["evidence"] for r in Q.quality_scores(corpus.frame(spark, rows).repartition(3), spark.createDataFrame(labels, "doc_id long, quality int"), folder=f"file://{tmp_path}/q").collect()}

    votes = defaultdict(list)
    for i, y in labels:
        if y is not None:
            votes[i].append(y)
    text_of = {r[0]: r[1] or "" for r in rows}
    marked = {i: sum(v) / len(v) for i, v in votes.items() if i in text_of}
    halves = [{i: y for i, y in marked.items() if id_hash(i) % 2 == k} for k in (0, 1)]
    up, down = [0.0] * Q.BUCKETS, [0.0] * Q.BUCKETS
    for i, y in halves[0].items():
        for b in set(buckets(text_of[i])):
            up[b] += y
            down[b] += 1 - y
    total = sum(halves[0].values())
    seen = {b for i in halves[0] for b in buckets(text_of[i])}
    weights = [round(math.log((u + 1) / (total + 2)) - math.log((d + 1) / (len(halves[0]) - total + 2)), 6) if b in seen else 0.0 for b, (u, d) in enumerate(zip(up, down))]
    train = sorted(halves[1], key=id_hash)
    model = Q.Regression.fit(np.array([plain_measures(text_of[i], weights) for i in train]), np.array([halves[1][i] for i in train]), [str(k) for k in range(12)])
    for i, text, *_ in rows:
        x = np.array(plain_measures(text, weights))
        z = model.weights[0] + ((np.concatenate([x, x**2]) - model.mean) / model.scale) @ model.weights[1:]
        assert abs(got[i] - 1 / (1 + math.exp(-max(-12, min(12, z))))) < 2e-5, i
