"""Templates as a table of whole texts, broadcast or joined."""

import random
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402

from chordgrid.llm import license_scan as L, shared  # noqa: E402


def test_whole_licences_are_found_under_small_changes(spark):
    rng, rows, want = random.Random(3), [], {}
    for i in range(60):
        label, text = rng.choice(L.WHOLE_TEXTS)
        words = text.split(" ")
        for _ in range(rng.randrange(0, 1 + len(words) // 25)):  # a few words changed, put in, or left out
            k = rng.randrange(len(words))
            words[k : k + 1] = rng.choice([[], ["other"], [words[k], "more"]])
        if i % 4 == 3:
            words, label = words[: len(words) // 2], None  # half a licence is not the licence
        noise = " ".join(rng.choice("abcdefgh") * 3 for _ in range(rng.randrange(0, 300)))
        rows.append((i, f"{noise}\n// {' '.join(words)}\n{noise}", "en", "s", 0))
        want[i] = (label, text)
    whole = spark.createDataFrame(L.WHOLE_TEXTS, "label string, text string")
    found = {r["doc_id"]: r for r in L.licenses(corpus.frame(spark, rows).repartition(3), templates=whole).collect()}
    for i, (label, text) in want.items():
        labels = set(found[i]["labels"].split(",")) - {"", "gpl"}
        if label:
            assert label in labels and found[i]["score"] >= 0.8
        else:
            assert found[i]["score"] < 0.8 or text not in [t for _, t in L.WHOLE_TEXTS if _ in labels]


@pytest.mark.parametrize("bound", [0, 1_000_000])
def test_a_large_table_is_joined_with_the_same_result(spark, monkeypatch, bound):
    monkeypatch.setattr(shared, "BROADCAST_ROWS", bound)
    rng = random.Random(8)
    own = [(f"t{k}", " ".join("".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(rng.choice([2, 3, 30, 400])))) for k in range(80)] + [("t1", None)]
    rows = [(i, " ".join(rng.choice(own)[1] or "" for _ in range(rng.randrange(0, 4))) + " all rights reserved", "en", "s", 0) for i in range(40)] + [(98, None, "en", "s", 0), (99, "", "en", "s", 0)]
    df = corpus.clashing(corpus.frame(spark, rows))
    found = L.licenses(df, templates=spark.createDataFrame(own, "label string, text string")).collect()
    want = Counter()
    for i, text, *_ in rows:
        words = corpus.words(text)
        inside = {label for label, t in own if t and len(t.split()) >= L.K and f" {t} " in f" {text} "}
        want[i, len(words), ",".join(sorted(inside | ({"reserved"} if words else set())))] += 1
    assert Counter((r["doc_id"], r["n_words"], r["labels"]) for r in found) == want
