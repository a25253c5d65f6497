"""The pipeline's stages one by one against plain versions."""

import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402
from test_operators import plain_components, plain_rules  # noqa: E402

import corpus_pipeline  # noqa: E402
from chordgrid.llm import sentencepiece_codec  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(sentencepiece_codec.MODEL).exists(), reason="needs the public tokenizer files")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The rows that each stage returns, and the last stage's columns."""
    base = tmp_path_factory.mktemp("sf")
    corpus.frame(spark).write.parquet(str(base / "documents.parquet"))
    docs, out = spark.read.parquet(str(base / "documents.parquet")), [corpus.rows()]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(base)).write.parquet(str(base / name))
        docs = spark.read.parquet(str(base / name))
        out.append([tuple(r) for r in docs.collect()])
    return out, docs.columns, str(base)


def test_rejected_documents_go(stages):
    before, after = stages[0][0], stages[0][1]
    # a kept verdict for each (id, words, ..) of the plain rules
    kept = Counter()
    for key, n in plain_rules(before, 10, 10).items():
        if key[-1]:
            kept[(key[0], key[1])] += n
    assert Counter((r[0], len(corpus.words(r[1]))) for r in after) == kept


def test_one_document_of_each_text_stays(stages):
    before, after = stages[0][1], stages[0][2]
    text = lambda r: re.sub(corpus.SPACE, " ", r[1] or "")
    first = {}
    for r in before:
        first[text(r)] = min(first.get(text(r), r[0]), r[0])
    assert Counter((r[0], text(r)) for r in after) == Counter((i, t) for t, i in first.items())


def test_one_document_of_each_component_stays(stages):
    before, after = stages[0][2], stages[0][3]
    assert {r[0] for r in after} == {k[0] for k in plain_components(before) if k[0] == k[2]} and set(after) <= set(before)


def test_the_mix_takes_what_its_sources_owe(stages):
    before, after = stages[0][3], stages[0][4]
    times, sizes = Counter(after), defaultdict(int)
    assert set(times) <= set(before) and max(times.values()) <= 3
    for r in before:
        sizes[r[3]] += len(corpus.words(r[1]))
    taken = defaultdict(int)
    for r, n in times.items():
        taken[r[3]] += n * len(corpus.words(r[1]))
    assert all(taken[s] <= 3 * sizes[s] for s in sizes) and sum(taken.values()) > 0.5 * sum(sizes.values())


def test_pieces_decode_to_the_texts(stages):
    rows, columns, _ = stages[0], stages[1], stages[2]
    assert columns == ["doc_id", "text", "lang", "source", "n_chars", "piece_ids"]
    codec = sentencepiece_codec.Codec(sentencepiece_codec.Vocabulary.read(sentencepiece_codec.MODEL))
    assert Counter(r[:5] for r in rows[5]) == Counter(rows[4])
    assert all((codec.decode(r[5]).decode() if r[5] else "") == (r[1] or "") for r in rows[5])


def test_run_is_the_stages_in_turn(spark, stages):
    rows, _, base = stages
    assert Counter(r[0] for r in corpus_pipeline.run(spark, base).select("doc_id").collect()) == Counter(r[0] for r in rows[5])


def test_stages_on_an_empty_table_and_beside_other_columns(spark, tmp_path):
    empty = corpus.frame(spark, [])
    wide = corpus.clashing(corpus.frame(spark)).withColumn("piece_ids", F.lit("own"))
    wide.write.parquet(str(tmp_path / "wide"))
    wide = spark.read.parquet(str(tmp_path / "wide"))
    for name, stage in corpus_pipeline.STAGES:
        own = wide.columns + (["_piece_ids"] if name == "sentencepiece" else [])
        assert stage(spark, empty, "").count() == 0
        assert stage(spark, wide, "").columns == own
        assert stage(spark, wide, "").where("piece_ids <> 'own'").isEmpty()
