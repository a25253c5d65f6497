"""Very many rows under one id, or under none: right results at a cost in proportion to the rows."""

import hashlib
import random
import re
import sys
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402

from chordgrid.llm import line_dedup, quality_classifier, substring_dedup  # noqa: E402


def rows_without_id(n):
    """Equal texts and different ones, mostly without an id, that share lines with each other and with documents."""
    rng = random.Random(n)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(5))
    lines = [" ".join(word() for _ in range(6)) for _ in range(60)]
    rows = [(None, "\n".join([lines[i % 60], "only here number %d of the rows" % i, lines[(7 * i + 1) % 60]]), "en", None, 0) for i in range(n)]
    rows += [(i, "\n".join(rng.sample(lines, 4)), "en", "s", 0) for i in range(30)]
    rows += [(5, "another text of id five\n" + lines[3], "en", "s", 0)] * 3
    return rows


def plain_lines(rows):
    key = lambda line: line.strip(" \t\n\v\f\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    docs = {}
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                docs.setdefault(key(line), set()).add(i)
    last = {k: max(v, key=lambda i: (i is not None, i or 0)) for k, v in docs.items() if len(v) >= 3}
    out = Counter()
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key(x) not in last or last[key(x)] == i]
        out[i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()] += 1
    return out


def test_lines_of_many_rows_without_an_id(spark):
    rows = rows_without_id(600)
    df = corpus.frame(spark, rows).repartition(4)
    found = Counter(tuple(r) for r in line_dedup.dedup_lines(df).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect())
    assert found == plain_lines(rows)
    state = line_dedup.LineDedup(spark).insert(df)
    marked = df.select(F.struct(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th")).alias("of"), "text")
    held = state._own_keys(marked, state.repeated()).agg(F.sum(F.size("gone")), F.max(F.size("gone"))).first()
    assert held[0] <= sum(len(r[1].split("\n")) for r in rows) and held[1] <= 4


def test_spans_of_many_equal_rows(spark, tmp_path):
    rng = random.Random(1)
    # repeats 50 words inside, so that runs and windows of it are open ones
    passage = [rng.choice("abcdefghijklmnop") * 2 for _ in range(90)]
    text = " ".join(passage + ["middle"] + passage[:70])
    earlier = (0, " ".join(passage), "en", "s", 0)
    counts = {}
    for n in (1, 500):
        df = corpus.frame(spark, [earlier] + [(None, text, "en", None, 0)] * n)
        texts = df.select(F.col("doc_id").alias("id"), "text").withColumn("th", F.xxhash64("text"))
        lists = substring_dedup.span_lists(texts, f"file://{tmp_path}/{n}")
        counts[n] = {r["s_id"]: len(r["spans"]) for r in lists.collect()}
        found = Counter(tuple(r) for r in substring_dedup.removed_words(df).select("doc_id", "n_words", "n_removed").collect())
        assert found == {(0, 90, 0): 1, (None, 161, 160): n}
    assert counts[1] == counts[500]


def test_sample_of_labelled_ids_is_bounded_in_rows(spark, tmp_path):
    rows = [(i % 5, f"text {i} " * (i % 7 + 1), "en", "s", 0) for i in range(400)]
    marks = spark.createDataFrame([(i, float(i % 2)) for i in range(5)], "l_id long, target double")
    quality_classifier.fitted(corpus.frame(spark, rows), marks, "doc_id", "text", 5, f"file://{tmp_path}/q")
    assert spark.read.parquet(f"file://{tmp_path}/q/train").count() == 5


def test_line_state_goes_on_in_another_session(spark, tmp_path):
    folder = f"file://{tmp_path}/lines"
    rows = [r for r in corpus.rows(6, 60) if r[0] is not None]
    first, more = rows[:35], rows[35:]
    line_dedup.LineDedup(spark, folder=folder).insert(corpus.frame(spark, first)).delete(corpus.frame(spark, first[:4]).select("doc_id"))
    state = line_dedup.LineDedup.open(spark, folder)  # nothing but the folder is known
    state.insert(corpus.frame(spark, more)).insert(corpus.frame(spark, first[:4])).compact()
    again = line_dedup.LineDedup.open(spark, folder)
    df = corpus.frame(spark, rows)
    got = Counter(tuple(r) for r in again.apply(df).select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256)).collect())
    assert got == plain_lines(rows)
    assert re.search(r"/state/0*\d+", spark.read.json(f"{folder}/state/*").inputFiles()[0])


def test_joined_sketch_lets_no_more_through_than_a_held_one(spark, tmp_path, monkeypatch):
    """Both rows of the sketch count, however it meets the runs."""
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefghijkl") * 2 for _ in range(220)), "en", "s", 0) for i in range(60)]
    rows += [(100 + i, rows[i][1], "en", "s", 0) for i in range(5)]
    texts = corpus.frame(spark, rows).select(F.col("doc_id").alias("id"), "text").withColumn("th", F.xxhash64("text"))
    held = substring_dedup.repeated_runs(texts, f"file://{tmp_path}/a").collect()
    monkeypatch.setattr(substring_dedup.countmin, "BROADCAST_CELLS", 0)
    joined = substring_dedup.repeated_runs(texts, f"file://{tmp_path}/b").collect()
    assert Counter(held) == Counter(joined) and len(held) > 50
