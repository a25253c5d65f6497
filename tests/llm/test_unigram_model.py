"""The codec against the public library on a Unigram model: the same pieces with made-up log scores."""

import random
import struct
import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus  # noqa: E402

from chordgrid.llm import sentencepiece_codec as S  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(S.MODEL).exists(), reason="needs the public tokenizer files")


def varint(n):
    out = b""
    while True:
        n, low = n >> 7, n & 127
        out += bytes([low | (128 if n else 0)])
        if not n:
            return out


def fields(data):
    """(number, wire type, value) of a message's fields."""
    at = 0

    def number():
        nonlocal at
        n = shift = 0
        while True:
            b = data[at]
            at += 1
            n |= (b & 127) << shift
            shift += 7
            if b < 128:
                return n

    while at < len(data):
        key = number()
        if key & 7 == 0:
            value = number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            value = data[at : at + size]
            at += size
        yield key >> 3, key & 7, value


def field(number, kind, value):
    key = varint(number << 3 | kind)
    return key + (varint(value) if kind == 0 else value if kind in (1, 5) else varint(len(value)) + value)


def unigram(path, scores):
    """The model's pieces and normaliser, with log scores, as a Unigram model."""
    out, i = b"", 0
    for number, kind, value in fields(Path(S.MODEL).read_bytes()):
        if number == 1:
            piece = [(n, k, v) for n, k, v in fields(value) if n != 2] + [(2, 5, struct.pack("<f", scores[i]))]
            value = b"".join(field(*x) for x in sorted(piece))
            i += 1
        elif number == 2:  # the trainer's settings: model type 1
            value = b"".join(field(n, k, 1 if n == 3 else v) for n, k, v in fields(value))
        out += field(number, kind, value)
    path.write_bytes(out)
    return str(path)


@pytest.fixture(scope="module")
def models(tmp_path_factory):
    import sentencepiece

    own = S.Vocabulary.read(S.MODEL)
    rng = np.random.default_rng(5)
    scores = np.where(own.matches, own.scores - rng.random(len(own.scores)), 0.0).astype(np.float32)
    path = unigram(tmp_path_factory.mktemp("m") / "unigram.model", scores)
    return sentencepiece.SentencePieceProcessor(model_file=path), S.Codec(S.Vocabulary.read(path)), path


def test_segmentation_equals_the_librarys(models):
    library, codec, _ = models
    assert np.allclose(codec.v.scores[codec.v.matches], [library.get_score(int(i)) for i in np.flatnonzero(codec.v.matches)])
    rng = random.Random(7)
    words = ["the", "andré", "Größe", "über", "token", "ization", "x1", "42", "日本", "ß", "q", "zzzz", "house", "-", "(a)"]
    texts = [" ".join(rng.choice(words) + rng.choice(["", "", "s", "ed", ","]) for _ in range(rng.randrange(1, 40))) for _ in range(300)]
    texts += [r[1] for r in corpus.rows(4) if r[1] and "\n" not in r[1] and r[1] == " ".join(r[1].split()) and "▁" not in r[1]][:30]
    same = 0
    for text, got in zip(texts, codec.encode(texts)):
        got, want = np.frombuffer(got, np.int32).tolist(), library.encode(text)
        score = lambda ids: sum(library.get_score(int(i)) for i in ids if codec.v.matches[i])
        assert codec.decode(got).decode() == text == library.decode(got)
        same += got == want
        # where a path differs, only ties or the price of letters without a piece may tell them apart
        assert got == want or abs(score(got) - score(want)) < 1e-3 or any(codec.is_byte[i] for i in got + want)
    assert same >= 0.97 * len(texts)


def test_a_given_model_is_the_querys(spark, models):
    library, codec, path = models
    texts = ["the house of André", "", None, "token ization 日本"]
    rows = corpus.frame(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    found = {r["doc_id"]: r for r in S.encoded(rows, model=path).collect()}
    for i, t in enumerate(texts):
        assert found[i]["piece_ids"] == (library.encode(t) if t else []) and found[i]["same"]


def test_decoded_text_beside_a_column_of_its_name(spark, models):
    codec = models[1]
    rows = spark.createDataFrame([([5, 6], "own"), (None, "own")], "piece_ids array<int>, decoded string")
    out = S.decode_table(rows, codec)
    assert out.columns == ["piece_ids", "decoded", "_decoded"] and [r["decoded"] for r in out.collect()] == ["own", "own"] and out.collect()[1]["_decoded"] == ""
