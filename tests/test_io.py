"""Files in and out, streams, and shard reports."""

import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chordgrid.operators import codec, dataset as D, quality as Q, scoring as SC
from chordgrid.sources import charts as C, datasets as DS
from chordgrid.streaming import streams as ST


@pytest.fixture(scope="module")
def wide(spark):
    rows = spark.range(40).select(F.col("id").cast("string").alias("song_id"), F.lit("guitar").alias("instrument"), F.array(F.lit(1), F.col("id").cast("int")).alias("tokens"), F.when(F.col("id") % 2 == 0, 7).alias("year"))
    return D.conform(rows)


def test_conform_fills_and_casts(spark, wide):
    assert wide.schema.simpleString() == D.SCHEMA.simpleString() and wide.where("artist is not null").count() == 0
    bad = D.conform(spark.createDataFrame([("x", "notanumber")], "song_id string, year string")).first()
    assert bad["year"] is None and D.missing_columns(wide, ["song_id", "zzz"]) == ["zzz"]


def test_shards_written_and_read(spark, wide, tmp_path):
    sized = wide.withColumn("bytes", F.lit(1000).cast("long"))
    sharded = D.with_shards(sized, "bytes", 10_000, "instrument", "song_id")
    assert sharded.select("shard").distinct().count() == 4
    D.write_shards(sharded.drop("bytes"), str(tmp_path / "out"), partition=None)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 40
    with pytest.raises(Exception):
        D.write_shards(sharded, str(tmp_path / "out"), partition=None)


def test_unreadable_shards_are_reported(spark, wide, tmp_path):
    path = tmp_path / "d"
    wide.coalesce(1).write.parquet(str(path))
    part = next(path.glob("part-*.parquet"))
    part.rename(path / "train-00000.parquet")
    (path / "train-00001.parquet").write_bytes(b"broken")
    assert DS.read_shards(spark, str(path), "train").count() == 40
    assert [r["path"].rpartition("/")[2] for r in DS.unreadable_shards(spark, str(path), "train").collect()] == ["train-00001.parquet"]
    kinds = Q.footer_schemas(spark, str(path))
    assert kinds.where("type = 'unreadable'").count() == 1 and kinds.where("column = 'song_id'").count() == 1


@pytest.mark.parametrize("jvm_only", [False, True])
def test_footers_of_files_beyond_what_a_row_holds(spark, tmp_path, monkeypatch, jvm_only):
    small, big = tmp_path / "a b.parquet", tmp_path / "big.parquet"
    pq.write_table(pa.table({"x": [1], "y": ["z"]}), small)
    with open(big, "wb") as f:  # a hole of 2.2 GB, then a footer: above the limit of one binaryFile row
        f.truncate(2_200_000_000)
        f.seek(0, 2)
        f.write(small.read_bytes())
    if jvm_only:
        def closed(name):
            raise OSError(name)

        monkeypatch.setattr(Q, "open_seekable", closed)
    got = {(r["file"].rpartition("/")[2], r["column"], r["type"]) for r in Q.footer_schemas(spark, str(tmp_path)).collect()}
    assert got == {(n, *c) for n in ("a b.parquet", "big.parquet") for c in (("x", "int64"), ("y", "string"))}


def test_json_lines_and_dispatch(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text("\n".join(json.dumps({"song_id": str(i), "tokens": [i]}) for i in range(3)))
    assert DS.open_dataset(spark, str(p), D.SCHEMA).count() == 3
    q = tmp_path / "y.json"
    q.write_text(json.dumps([{"song_id": "1"}, {"song_id": "2"}], indent=1))
    assert DS.open_dataset(spark, str(q)).count() == 2


def test_song_folders_and_lines(spark, tmp_path):
    for name, file in (("a", "notes.chart"), ("b", "notes.mid"), ("c", "other.txt")):
        (tmp_path / name).mkdir()
        (tmp_path / name / file).write_text("[Song]\nName = \"x\"\n")
    rows = {r["dir"].rpartition("/")[2]: (r["has_chart"], r["has_midi"]) for r in C.song_folders(spark, str(tmp_path)).collect()}
    assert rows == {"a": (True, False), "b": (False, True)}
    assert [(r["line_no"], r["line"]) for r in C.read_lines(spark, str(tmp_path / "a")).orderBy("line_no").collect()][:2] == [(0, "[Song]"), (1, 'Name = "x"')]


def test_audio_files(spark):
    files = spark.createDataFrame([("/s/song.OGG",), ("/s/x.txt",)], "path string")
    assert [r["path"] for r in DS.audio_files(files).collect()] == ["/s/song.OGG"]


def test_stream_resumes(spark, wide, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("src", "out", "check"))
    wide.limit(10).write.parquet(src)
    ST.shuffled_batches(ST.shard_stream(spark, src), ["song_id"], out, check).awaitTermination()
    first = spark.read.parquet(out).count()
    wide.where("song_id >= '5'").write.mode("append").parquet(src)
    ST.shuffled_batches(ST.shard_stream(spark, src), ["song_id"], out, check).awaitTermination()
    assert first == 10 and spark.read.parquet(out).count() == spark.read.parquet(src).count()


def test_running_counts(spark, tmp_path):
    src = str(tmp_path / "s")
    spark.createDataFrame([("ok", 2, 5), ("failed", 0, 0), ("ok", 1, 3)], "status string, num_rows int, num_notes int").write.parquet(src)
    stream = spark.readStream.schema("status string, num_rows int, num_notes int").parquet(src)
    q = ST.status_counts(stream).writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.sql("select * from counts").collect())) == [("failed", 1, 0, 0), ("ok", 2, 3, 8)]


def test_validation_rows_are_not_trained_on(spark, wide):
    held = ST.validation_rows(wide, ["song_id"], 5)
    assert ST.training_rows(wide, held, ["song_id"]).count() == 35
    with pytest.raises(ValueError):
        ST.validation_rows(wide.limit(0), ["song_id"], 5)


def test_entry_imports_without_the_optional_parts():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "g2_encode" in e.queries()


def test_a_shard_without_rows_is_readable(spark, wide, tmp_path):
    path = tmp_path / "d"
    wide.limit(0).coalesce(1).write.parquet(str(path))
    next(path.glob("part-*.parquet")).rename(path / "train-00000.parquet")
    assert DS.unreadable_shards(spark, str(path), "train").isEmpty()


def test_appended_shards_go_on_numbering(spark, wide, tmp_path):
    out = str(tmp_path / "out")
    sized = wide.withColumn("bytes", F.lit(1000).cast("long"))
    assert D.next_shard(spark, out) == 0
    for turn in range(2):
        D.append_shards(sized, out, "bytes", 10_000, "instrument", "song_id", partition=None)
        assert D.next_shard(spark, out) == 4 * (turn + 1)
    back = spark.read.parquet(out)
    names = sorted(r[0] for r in back.select("shard_name").distinct().collect())
    assert names == [f"train-{i:05d}.parquet" for i in range(8)] and back.count() == 80


def greedy(sizes, limit):
    """Shard numbers of rows that fill a buffer until it holds the limit."""
    out, shard, held = [], 0, 0
    for x in sizes:
        out.append(shard)
        held += x
        if held >= limit:
            shard, held = shard + 1, 0
    return out


@pytest.mark.parametrize("wide", [2, 64])
def test_shards_are_cut_as_a_buffer_fills(spark, monkeypatch, wide):
    monkeypatch.setattr(D, "BLOCK_SHARDS", wide)
    rng, rows = random.Random(wide), []
    for split, n in (("a", 400), ("b", 1), ("c", 0), ("d", 90), (None, 150)):
        for i in range(n):
            rows.append((split, i, rng.choice([0, 0, 1, 3, 7, 13, 40, 41, 90, 700 if split == "d" else 2])))
    df = spark.createDataFrame(rows, "split string, at int, bytes int").repartition(3)
    want = {}
    for split in ("a", "b", "d", None):
        sizes = [x for s, _, x in rows if s == split]
        want |= {(split, i): k for i, k in enumerate(greedy(sizes, 40))}
    for part in (None, F.floor(F.col("at") / 50)):
        got = {(r["split"], r["at"]): r["shard"] for r in D.with_shards(df, "bytes", 40, "split", "at", part=part).collect()}
        assert got == want


@pytest.mark.parametrize("name", ["gzip", "snappy", "none", "zstd"])
def test_compressions(spark, wide, tmp_path, name):
    D.write_shards(wide, str(tmp_path / "x"), compression=name)
    file = pq.ParquetFile(next((tmp_path / "x").glob("part-*.parquet")))
    assert file.metadata.row_group(0).column(0).compression == {"none": "UNCOMPRESSED"}.get(name, name.upper())


def test_manifest(spark, wide, tmp_path):
    rows = wide.withColumn("split", F.when(F.col("song_id") < "2", "test").otherwise("train"))
    D.write_manifest(rows, str(tmp_path / "m"), source="songs", version="3")
    text = "".join(p.read_text() for p in (tmp_path / "m").glob("part-*.json"))
    n = rows.where("split = 'test'").count()
    assert json.loads(text) == {"rows": 40, "splits": {"test": n, "train": 40 - n}, "instruments": ["guitar"], "source": "songs", "version": "3"}


def test_metrics_file(spark, tmp_path):
    rows = spark.createDataFrame([("guitar", 1, 1, -0.5), ("guitar", 1, 2, -1.5), ("bass", 3, 3, 0.0)], "instrument string, pred int, label int, logp double")
    SC.write_metrics(rows, str(tmp_path / "m"))
    found = json.loads("".join(p.read_text() for p in (tmp_path / "m").glob("part-*.json")))
    assert found["by_instrument"]["guitar"] == {"loss": 1.0, "token_accuracy": 0.5, "perplexity": pytest.approx(2.718281828), "n": 2}
    assert found["total"]["n"] == 3 and found["total"]["token_accuracy"] == pytest.approx(2 / 3) and set(found["by_instrument"]) == {"guitar", "bass"}


def test_broken_files_are_passed_over_in_a_stream_of_few_files_a_batch(spark, wide, tmp_path):
    src, out, check = (tmp_path / x for x in ("src", "out", "check"))
    wide.repartition(5).write.parquet(str(src))
    (src / "part-99999-broken.parquet").write_bytes(b"broken")
    sizes = []

    def write(rows, batch):
        sizes.append(rows.select("file").distinct().count())
        rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    stream = ST.shard_stream(spark, str(src), files_per_batch=2).withColumn("file", F.col("_metadata.file_path"))
    ST.run_available(stream, write, str(check)).awaitTermination()
    assert len(sizes) == 3 and max(sizes) <= 2 and spark.read.parquet(str(out)).count() == 40


def test_charts_are_encoded_as_they_come(spark, tmp_path):
    src, out, check = (tmp_path / x for x in ("src", "out", "check"))
    src.mkdir()
    body = "[Song]\n{\n  Resolution = 192\n}\n[SyncTrack]\n{\n  0 = B 120000\n}\n[ExpertSingle]\n{\n  0 = N 0 0\n  192 = N 1 0\n}\n"
    (src / "one.chart").write_text(body)
    def encode(rows):
        chart = C.Charts(rows)
        return codec.encode(chart.notes(), chart.specials(), chart.tempo())

    ST.encode_stream(ST.line_stream(spark, str(src)), encode, str(out), str(check)).awaitTermination()
    (src / "two.chart").write_text(body.replace("N 1 0", "N 2 0"))
    ST.encode_stream(ST.line_stream(spark, str(src)), encode, str(out), str(check)).awaitTermination()
    rows = {r["song_id"].rpartition("/")[2]: r["tokens"] for r in spark.read.parquet(str(out)).collect()}
    assert rows["one.chart"] == [1, 6, 4, 57, 123, 20, 4, 58, 123, 2] and rows["two.chart"][-3:] == [60, 123, 2]


def test_tabs_and_other_blanks_in_charts_and_ini(spark):
    chart = '\t[Song]\n{\n\tName\t=\t"Two words"\n\tResolution\t=\t480\n\xa0Artist = X \n}\n\t[SyncTrack]\n{\n\t0 =\tB\t120000\n\t0\t= TS\t3\t3\n}\n[ExpertSingle]\t\n{\n\t480 =\tN 1 0\n 960\t=\tN\t2\t\t48\n\t960\t= E\tsolo\n\t960\t= S\t2\t96\n}\n[Events]\n{\n\t0\t=\tE\t"section a"\n}\n'
    charts = C.Charts(C.numbered(spark.createDataFrame([("p", chart)], "path string, text string")))
    assert charts.header().first()["meta"] == {"name": "Two words", "resolution": "480", "artist": "X"}
    assert [tuple(r)[1:] for r in charts.tempo().drop("ord").collect()] == [(0, 120.0, 480)]
    assert [tuple(r)[1:] for r in charts.timesig().collect()] == [(0, 3, 8)]
    assert sorted((r["tick"], r["pitch"], r["sustain"]) for r in charts.raw_notes().collect()) == [(480, 1, 0), (960, 2, 48)]
    assert sorted((r["tick"], r["kind"], r["length"]) for r in charts.specials().collect()) == [(960, "solo", 0), (960, "star_power", 96)]
    assert [(r["tick"], r["text"]) for r in charts.section_events().collect()] == [(0, "section a")]
    ini = "\t[song]\nname\t=\tFoo bar\t\n\tyear\t= 2001\npro_drums\t=\tFalse\n"
    row = C.ini_metadata(C.numbered(spark.createDataFrame([("p", ini)], "path string, text string"))).first()
    assert (row["name"], row["year"], row["pro_drums"], set(row["extra"])) == ("Foo bar", 2001, False, {"name", "year", "pro_drums"})


def test_small_blocks_share_a_call(monkeypatch):
    """Many splits in one call give what each gives alone, the split without a name too."""
    import pandas as pd

    rows = pd.DataFrame([(s, i * 30, i * 30 + 30) for s in ("a", None, "b") for i in range(200)], columns=["by", "before", "after"]).sample(frac=1, random_state=1)
    rows["block"] = rows["after"] // 640
    together = D.pack_exits(rows, 100, 640)
    for s in ("a", None, "b"):
        own = rows[rows["by"].isna()] if s is None else rows[rows["by"] == s]
        mine = together[together["by"].isna()] if s is None else together[together["by"] == s]
        want = D.pack_exits(own, 100, 640)
        assert len(want) and sorted(want[["block", "entry", "exit"]].itertuples(index=False)) == sorted(mine[["block", "entry", "exit"]].itertuples(index=False))
