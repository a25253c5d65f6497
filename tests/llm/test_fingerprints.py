"""Fingerprints against plain sets, near classes against brute force."""

import hashlib
import random
import re
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402

from chordgrid.llm import fingerprints as M  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_order(rows):
    """(id, text) of each distinct row with what its next one may be (rows that repeat an id are in an order of their own)."""
    ids = sorted({r[0] for r in rows if r[0] is not None}) + [None] * any(r[0] is None for r in rows)
    of = defaultdict(list)
    for i, t, *_ in rows:
        of[i].append(t or "")
    return ids, of


@pytest.mark.parametrize("parts", [1, 5])
def test_rows_equal_plain_ones(spark, parts):
    rows = [r for r in corpus.rows(3, 80) if r[0] != 7] + [(-5, "Größe \U0001f600 x y z w v u t s", "de", "s1", 3), (900, "m " * 60_000, None, None, 1), (None, "no id at all here", None, None, 1), (901, "a b c", None, None, 1)]
    rows = list(dict.fromkeys(rows))
    df = corpus.clashing(corpus.frame(spark, rows)).repartition(parts)
    found = {r["doc_id"]: r.asDict() for r in M.fingerprints(df).collect()}
    ids, of = plain_order(rows)
    assert set(found) == set(ids) and all(len(x) == 1 for x in of.values())
    for i, after in zip(ids, ids[1:] + ids[:1]):
        text, following, r = of[i][0], of[after][0], found[i]
        k = len(text) // 4
        edited = text[: len(text) - k] + following[:k]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        for t, name in ((text, "fingerprint"), (edited, "edited_fingerprint")):
            assert r[name] == M.fingerprint_parts(pa.array([t]))[0].tobytes().hex()
        for a, b, name in ((text, edited, "near_edited"), (text, following, "near_next")):
            true = jaccard(a, b)
            assert abs(r[name] - true) <= 5 * (true * (1 - true) / M.PERMUTATIONS) ** 0.5 + 0.03, (i, name)
            assert r[name] == 1 or shingles(a) != shingles(b)


def test_minima_are_those_of_each_set():
    texts = ["a b c d e f g a b c d e", "", None, "One two", "x " * 300, "one TWO"]
    found = M.Texts(pa.array(texts))
    assert np.diff(found.first).tolist() == [8, 0, 0, 1, 296, 1]
    least = M.minima(found.grams, found.first)
    for i in range(len(texts)):
        grams = found.grams[found.first[i] : found.first[i + 1]]
        want = [(grams * a + b).min() if len(grams) else 2**64 - 1 for a, b in zip(M._A, M._B)]
        assert least[i].tolist() == want
    assert (least[3] == least[5]).all() and (least[1] == least[2]).all()


def test_edited_minima_share_the_kept_words():
    rng = random.Random(8)
    for _ in range(300):
        piece = lambda: rng.choice(["", " ", "\n"]) + rng.choice([" ", "  ", "\n"]).join(rng.choice(["a", "Bb", "é", "\U0001f600c", "dd"]) for _ in range(rng.randrange(0, 30))) + rng.choice(["", " "])
        texts = [piece() for _ in range(rng.randrange(1, 6))]
        edited = M.edited_texts(texts, texts[1:] + texts[:1])
        own, changed = M.both_parts(texts, edited)
        assert (own == M.fingerprint_parts(pa.array(texts))).all()
        assert (changed == M.fingerprint_parts(pa.array(edited))).all()


def test_near_classes_recall(spark):
    """Every class that bands find is right; nine tenths of the links at least are in one class (all of them but one
    in forty at 0.8, almost all above)."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(3000)]
    rows = []
    for g in range(60):
        base = [rng.choice(words) for _ in range(rng.choice([40, 120, 300]))]
        rows.append(" ".join(base))
        for _ in range(4):
            copy = list(base)
            for _ in range(rng.randrange(1, 2 + len(base) // 50)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy))
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(rows)]
    found = {r["doc_id"]: r["near_id"] for r in M.near_classes(corpus.frame(spark, rows)).collect()}
    links = [(a, b) for k in range(0, len(rows), 5) for a in range(k, k + 5) for b in range(a + 1, k + 5) if jaccard(rows[a][1], rows[b][1]) >= 0.8]
    assert len(links) > 150
    assert sum(found[a] == found[b] for a, b in links) >= 0.97 * len(links)
    comp = {i: i for i in found}
    for _ in range(6):
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    assert all(comp[i] <= found[i] for i in found)
    whole = {r["doc_id"]: r["near_id"] for r in M.fingerprints(corpus.frame(spark, rows)).collect()}
    assert whole == found


def test_repeated_rows_and_small_tables(spark):
    assert M.fingerprints(corpus.frame(spark, [])).count() == 0
    one = M.fingerprints(corpus.frame(spark, [(4, "a b c d e f g h", "en", "s", 0)])).collect()
    assert [(r["doc_id"], r["n_chars"], r["near_next"], r["near_id"]) for r in one] == [(4, 15, 1.0, 4)]
    rows = [(1, "same text of one id here", "en", "s", 0)] * 40 + [(1, None, "en", "s", 0), (None, "", None, None, 0), (None, "", None, None, 0), (2, "other", None, None, 0)]
    found = M.fingerprints(corpus.frame(spark, rows)).collect()
    assert len(found) == len(rows)
    assert len({r["fingerprint"] for r in found if r["n_chars"] == 0}) == 1
