"""Very long texts and rows without an id through the scans and the pipeline's stages."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402

import corpus_pipeline  # noqa: E402
from chordgrid.llm import conversation_trie, fingerprints, license_scan, pii_surrogates, sentencepiece_codec, spelling  # noqa: E402


def words(seed, n):
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randrange(3, 9))) for _ in range(5000)]
    return [rng.choice(made) for _ in range(n)]


def test_notices_at_the_ends_of_very_long_texts(spark):
    body = " ".join(words(1, 250_000))
    mit = license_scan.WHOLE_TEXTS[0][1]
    rows = [(1, f"{mit} {body} All rights reserved", "en", "s", 0), (2, body, "en", "s", 0), (3, f"{body}\n{mit}", "en", "s", 0), (4, "x" * 1_000_000, "en", "s", 0)]
    found = {r["doc_id"]: r for r in license_scan.licenses(corpus.frame(spark, rows)).collect()}
    length = len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", mit.lower()))
    assert [(found[i]["n_words"], found[i]["n_base"], found[i]["labels"]) for i in (1, 2, 3, 4)] == [(length + 250_003, 1, "mit,reserved"), (250_000, 0, ""), (250_000 + length, 0, "mit"), (1, 0, "")]
    assert found[1]["first_word"] == found[1]["last_word"] == length + 250_000 and found[3]["score"] == 1


def test_entities_at_the_ends_of_very_long_texts(spark):
    body = " ".join(words(2, 200_000))
    rows = [(1, f"mail a.b@c-d.org {body} and Mrs. Anna Keller from 10.1.2.3", "en", "s", 0), (2, body, "en", "s", 0), (3, f"{body} a.b@c-d.org", "en", "s", 0)]
    found = {r["doc_id"]: r for r in pii_surrogates.surrogate_texts(corpus.frame(spark, rows), key="k").collect()}
    m = re.fullmatch(rf"mail (\S+@\S+) {body} and Mrs\. (\w+) (\w+) from (10\.\d+\.\d+\.\d+)", found[1]["text"])
    assert m and "Keller" not in m[3] and m[1] != "a.b@c-d.org" and found[1]["n_entities"] == 4
    assert found[2]["text"] == body and found[3]["text"] == f"{body} {m[1]}"


def test_new_operators_on_very_long_texts(spark):
    body = words(3, 200_000)
    rows = [(1, " ".join(body), "en", "s", 0), (2, " ".join(body[:100_000] + ["other"] + body[100_001:]), "en", "s", 0), (3, "é" * 700_000, "fr", "s", 0), (4, None, None, None, None)]
    df = corpus.frame(spark, rows)
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(df).collect()}
    assert [found[i]["n_chars"] for i in (1, 2, 3, 4)] == [len(r[1] or "") for r in rows] and found[1]["near_next"] > 0.95 and found[2]["near_id"] == 1 and found[3]["near_id"] == 3
    n = Counter(w for r in rows[:2] for w in r[1].split(" ") if len(w) >= 5)
    got = {r["word"]: r["n"] for r in spelling.spelling_groups(df).collect()}
    assert got == {w: k for w, k in n.items() if k >= 3}
    turns = spark.createDataFrame([(1, 0, "user", "t" * 3_000_000), (2, 0, "user", "t" * 3_000_000), (2, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    trie = conversation_trie.prefix_trie(conversation_trie.conversation_turns(turns)).collect()
    assert sorted((r["depth"], r["n_convs"], r["saved_tokens"]) for r in trie) == [(0, 2, 3_000_000), (1, 2, 3_000_000), (2, 1, 0)]


@pytest.mark.skipif(not Path(sentencepiece_codec.MODEL).exists(), reason="needs the public tokenizer files")
def test_stages_on_rows_without_an_id_and_very_long_texts(spark, tmp_path):
    long, other, third = words(4, 120_000), words(5, 400), words(6, 300)
    near = list(long)
    near[5000], near[70_000] = "changed", "words"
    rows = [
        (None, " ".join(other), "en", "s1", 0), (None, "  ".join(other), "en", "s1", 0), (None, " ".join(third), "en", None, 0), (None, "too short", "en", None, 0), (None, None, None, None, None),
        (2, " ".join(long), "en", "s2", 0), (7, "\n".join(long[:60_000]) + "\n" + " ".join(long[60_000:]), "en", "s2", 0), (8, " ".join(near), "en", "s2", 0), (9, "x" * 500_000, "en", "s2", 0)]
    docs, seen = corpus.frame(spark, rows), []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, "").write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        seen.append(Counter((r["doc_id"], len(corpus.words(r["text"]))) for r in docs.collect()))
    quality, exact, once, mixed, last = seen
    assert quality == Counter([(None, 400), (None, 400), (None, 300), (2, 120_000), (7, 120_000), (8, 120_000)])
    assert exact == Counter([(None, 400), (None, 300), (2, 120_000), (8, 120_000)])
    assert once == Counter([(None, 400), (None, 300), (2, 120_000)])
    assert set(mixed) <= set(once) and max(mixed.values()) <= 3 and mixed[None, 400] and last == mixed
