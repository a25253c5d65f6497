"""Spelling groups against a plain version."""

import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402

from chordgrid.llm import spelling as S  # noqa: E402

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_groups(rows, spoil):
    n = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if spoil and h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                n[run] += 1
    n = {w: c for w, c in n.items() if c >= 3}
    of = defaultdict(list)
    for w in n:
        of[w] = [v for v in n if abs(len(v) - len(w)) < 2 and near(w, v)]
    form = {}
    for w in n:
        best = min(of[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(of[w]), n[form[w]] if form[w] else None))
    return Counter(out)


def variant_texts(seed):
    """Words of few stems with edits, accents, capitals and long runs."""
    rng = random.Random(seed)
    letters = "abcdeéÿ×zs"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randrange(4, 12))) for _ in range(25)]
    texts = []
    for _ in range(70):
        out = []
        for _ in range(rng.randrange(0, 90)):
            w = rng.choice(stems)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice(letters) + w[k:], w[:k] + rng.choice(letters) + w[k + 1 :]])
            out.append(rng.choice([w, w.upper(), w.capitalize()]))
        texts.append(rng.choice([" ", ", ", "1", "Ā", "\n"]).join(out))
    long = "ab" * 60_000  # a run of very many letters, and one edit of it
    return [*texts, None, "", long, long + " " + long, *[long[:9] + "z" + long[9:]] * 3, "abcde" * 15 + " " + "abcde" * 14 + "abcdf", *["x" * 5] * 4, *["x" * 6] * 9]


@pytest.mark.parametrize("spoil", [0, 5, 97])
def test_groups_equal_a_plain_version(spark, monkeypatch, spoil):
    monkeypatch.setattr(S, "TILE", 7)  # many tiles in a block
    rows = [(rng_id, t, "en", "s", 0) for rng_id, t in enumerate(variant_texts(spoil), -3)]
    rows += [(None, "hallo hallo hellö", "en", None, 0)] * 3 + [rows[4]] * 2
    df = corpus.clashing(corpus.frame(spark, rows)).repartition(3)
    found = Counter(tuple(r) for r in S.spelling_groups(df, spoil=spoil).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert found == plain_groups(rows, spoil)
    assert any(f for _, f, *_ in found) and any(f and r != f for _, f, r, *_ in found) | (spoil != 5)


def test_words_with_another_root(spark):
    df = corpus.frame(spark, [(1, "Colour colour colour", "en", "s", 0), (2, "color color color color color color color", "en", "s", 0), (3, None, "en", "s", 0), (4, "Colour color", None, None, 0)])
    groups = S.spelling_groups(df)
    found = {r["doc_id"]: [tuple(x) for x in r["variants"]] for r in S.with_spelling_groups(df, groups=groups).collect()}
    assert found == {1: [("colour", "color")], 2: [], 3: [], 4: [("colour", "color")]}
    assert S.spelling_groups(corpus.frame(spark, [])).count() == 0


def test_crc_and_gram_matrices_by_hand():
    texts = pa.array(["Hallo wörld", None, "x" * 70 + " Ãß"])
    runs = S.letter_runs(texts)
    words = [runs.data[a:b].tobytes().decode() for a, b in zip(runs.start, runs.end)]
    assert words == ["hallo", "wörld", "x" * 70, "Ãß"]
    assert S.crc_of(runs, [5, 6, None]).tolist() == [zlib.crc32(f"{i}:{w}".encode()) for i, w in zip(["5", "5", "", ""], words)]
    rng = random.Random(3)
    for n, m in ((5, 5), (5, 6), (1, 2)):
        a, b = (sorted({"".join(rng.choice("abcé") for _ in range(k)) for _ in range(60)}) for k in (n, m))
        i, j = S.near_pairs(S.letters_of("".join(a), len(a)), S.letters_of("".join(b), len(b)), False)
        assert set(zip(i.tolist(), j.tolist())) == {(x, y) for x in range(len(a)) for y in range(len(b)) if near(a[x], b[y])}
    assert np.array_equal(S._USED, np.array([ord(c) for c in S.LETTERS]))
