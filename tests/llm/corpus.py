"""A small corpus with copies, near copies, shared passages, notices, personal data and odd rows."""

import random
import re

SPACE = r"[\x20\x09-\x0D]+"
#: Extra columns whose names clash with those that operators use inside.
EXTRA = "id string, th long, h int, kept string, size int, row string, n_words string, _mix_id int"


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars)."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abdeilmnorst") for _ in range(rng.randrange(2, 8))) for _ in range(400)]
    prose = lambda k: [rng.choice(vocabulary) for _ in range(k)]
    passage = prose(70)
    line = " ".join(prose(8)).capitalize() + " boilerplate line."
    texts: list[str | None] = []
    for i in range(n):
        words = prose(rng.choice([3, 30, 120, 300]))
        kind = i % 12
        if kind == 1 and texts:
            texts.append((rng.choice([t for t in texts if t]) or "x").replace(" ", "  "))
            continue
        if kind == 2 and texts:
            old = rng.choice([t for t in texts if t]).split(" ")
            for _ in range(max(1, len(old) // 60)):
                old[rng.randrange(len(old))] = rng.choice(vocabulary)
            texts.append(" ".join(old))
            continue
        if kind == 3:
            at = rng.randrange(len(words))
            words = words[:at] + passage + words[at:]
        text = " ".join(words)
        if kind in (4, 5, 3):
            text += "\n" + ("  " if kind == 4 else "") + (line.upper() if kind == 5 else line) + "\t\n"
        if kind == 6:
            text += "\nLicensed under the Apache License, Version 2.0.\nAll rights reserved."
        if kind == 7:
            text += " call +1 (555) 201-7788 or mail Anna.Smith@mail.example.com from 10.2.3.4 card 4111111111111111"
        if kind == 8:
            text = " ".join(prose(6) * 20)
        texts.append(text)
    texts += ["", None, " ", "one", "one", "É ▁ \U0001f600 日本語 \t\v x", "\n\n\n", "cc by cc by", "a b c d", "a b c d", "word " * 3000]
    langs, sources = ["en", "de", None], ["s1", "s2", "s3", None, ""]
    out = [(i, t, langs[i % 3], sources[0] if i % 3 else sources[i % 5], None if t is None else len(t)) for i, t in enumerate(texts)]
    out.append(out[5])  # a row twice
    out.append((7, "another text of a repeated id " * 9, "en", "s1", 0))
    return out


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def clashing(df):
    from pyspark.sql import functions as F

    for c in EXTRA.split(", "):
        name, kind = c.split(" ")
        df = df.withColumn(name, F.lit("7").cast(kind))
    return df


def words(text, pattern=r"[^\x20\x09-\x0D]+"):
    return re.findall(pattern, text or "")
