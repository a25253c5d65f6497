"""Ini texts become fields in their own rows."""

from pyspark.sql import functions as F

from chordgrid.sources import charts as C

TEXTS = [("a", "[song]\r\nName = x\nname\t=\ty \n[x=1]\n; n = a=b\nyear = 19x\nfrets = f"), ("b", "no pair\n[song]"), ("c", None), ("d", ""), ("e", "=\nk=\n K =1\n k = 2 \r"), ("f", "song_length = 5\nsong_length_ms = 7\npro_drums = False")]


def test_ini_texts_are_not_shuffled(spark):
    texts = spark.createDataFrame(TEXTS, "path string, text string")
    rows = C.ini_texts(texts)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    got = {r["song_id"]: r for r in rows.collect()}
    assert sorted(got) == ["a", "e", "f"]
    assert got["a"]["extra"] == {"name": "y", "; n": "a=b", "year": "19x", "frets": "f"} and (got["a"]["name"], got["a"]["year"], got["a"]["charter"]) == ("y", 0, "f")
    assert got["e"]["extra"] == {"": "", "k": "2"}
    assert (got["f"]["song_length_ms"], got["f"]["pro_drums"]) == (5, False)


def test_lines_give_the_same(spark):
    texts = spark.createDataFrame(TEXTS, "path string, text string")
    key = lambda df: sorted(map(str, df.withColumn("extra", F.array_sort(F.map_entries("extra"))).collect()))
    assert key(C.ini_texts(texts)) == key(C.ini_metadata(C.numbered(texts)))
