"""Shard repair: names, rows, order, resume, and what cannot be repaired."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import types as T

from chordgrid.operators import dataset as D, quality as Q, repair as R
from chordgrid.sources.folders import Folder

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("size", T.IntegerType()), T.StructField("tags", T.ArrayType(T.IntegerType()))])


@pytest.fixture
def shards(tmp_path):
    n = 300
    good = {"id": pa.array(range(n), pa.int64()), "name": pa.array([f"n{i}" if i % 7 else None for i in range(n)]), "size": pa.array([i % 5 for i in range(n)], pa.int32()), "tags": pa.array([[i, None] for i in range(n)], pa.list_(pa.int32()))}
    for k in range(7):
        data = dict(good)
        if k in (1, 2):
            data["size"] = pa.array([str(i % 5) if i != 250 or k == 2 else "many" for i in range(n)])
        if k == 3:
            del data["name"]
            data["more"] = pa.array([1.5] * n)
        if k == 4:
            data = {c: x.slice(0, 0) for c, x in data.items() if c != "tags"}
        pq.write_table(pa.table(data), tmp_path / f"train-{k:05d}.parquet", row_group_size=37)
    (tmp_path / "train-00006.parquet").write_bytes(b"broken")
    return tmp_path


def content(path):
    return pq.read_table(path).to_pylist()


def test_repair_keeps_names_rows_and_order(spark, shards):
    before = {p.name: content(p) for p in shards.glob("train-0000[0-5].parquet")}
    whole = content(shards / "train-00000.parquet")
    plan = {(r["file"], r["column"], r["action"]) for r in R.repair_plan(spark, str(shards), "train", SCHEMA).collect()}
    assert plan == {("train-00001.parquet", "size", "cast"), ("train-00002.parquet", "size", "cast"), ("train-00003.parquet", "name", "add"), ("train-00003.parquet", "more", "drop"), ("train-00004.parquet", "tags", "add"), ("train-00006.parquet", None, "unreadable")}
    assert {p.name: content(p) for p in shards.glob("train-0000[0-5].parquet")} == before  # a dry run changes nothing
    report = {r["file"][6:11]: (r["status"], sorted(r["columns"])) for r in R.repair_shards(spark, "file://" + str(shards), "train", SCHEMA).collect()}
    assert report == {"00000": ("ok", []), "00005": ("ok", []), "00006": ("unreadable", []), **{k: ("repaired", c) for k, c in (("00001", ["size"]), ("00002", ["size"]), ("00003", ["more", "name"]), ("00004", ["tags"]))}}
    assert sorted(p.name for p in shards.glob("[!.]*")) == [f"train-{k:05d}.parquet" for k in range(7)]
    assert content(shards / "train-00002.parquet") == whole
    assert content(shards / "train-00001.parquet") == [r | ({"size": None} if r["id"] == 250 else {}) for r in whole]
    assert content(shards / "train-00003.parquet") == [r | {"name": None} for r in whole]
    assert content(shards / "train-00004.parquet") == []
    again = R.repair_plan(spark, str(shards), "train", SCHEMA).where("action <> 'unreadable'")
    assert again.isEmpty() and pq.ParquetFile(shards / "train-00001.parquet").metadata.row_group(0).column(0).compression == "ZSTD"


def test_a_repair_that_was_cut_off_goes_on(spark, shards, monkeypatch):
    whole, moved, replace = content(shards / "train-00000.parquet"), [], Folder.replace

    def killed(self, source, target):
        if len(moved) == 1:
            raise KeyboardInterrupt
        moved.append(target)
        replace(self, source, target)

    monkeypatch.setattr(Folder, "replace", killed)
    with pytest.raises(KeyboardInterrupt):
        R.repair_shards(spark, str(shards), "train", SCHEMA)
    assert (shards / "_repair").exists()
    assert spark.read.schema("id bigint").option("ignoreCorruptFiles", True).parquet(str(shards)).count() == 1500  # the stage is hidden
    monkeypatch.setattr(Folder, "replace", replace)
    report = {r["file"]: r["status"] for r in R.repair_shards(spark, str(shards), "train", SCHEMA, failed="column", group=1).collect()}
    assert report[moved[0]] == "ok" and sorted(report.values()) == ["ok"] * 3 + ["repaired"] * 3 + ["unreadable"]
    assert content(shards / "train-00002.parquet") == whole and not (shards / "_repair").exists()


def test_a_shard_with_broken_pages_stays_as_it_is(spark, shards):
    bad = shards / "train-00002.parquet"
    raw = bytearray(bad.read_bytes())
    raw[4:400] = b"\xff" * 396
    bad.write_bytes(raw)
    report = {r["file"][6:11]: r["status"] for r in R.repair_shards(spark, str(shards), "train", SCHEMA).collect()}
    assert report["00001"] == "repaired" and report["00002"] == "failed" and bad.read_bytes() == raw


def test_columns_or_cells_are_emptied(spark):
    rows = spark.createDataFrame([("a", "1", ["1", "x"]), ("a", "no", ["2"]), ("b", "3", ["4", None]), ("b", None, None)], "f string, n string, l array<string>")
    schema = T.StructType.fromDDL("f string, n int, l array<int>, z date")
    one = lambda **k: [(r["f"], r["n"], r["l"]) for r in D.conform(rows, schema, **k).collect()]
    assert [x[1] for x in one()] == [1, None, 3, None]
    assert sorted(one(failed="column"), key=str) == sorted([("a", None, None), ("a", None, None), ("b", None, None), ("b", None, None)], key=str)
    assert sorted(one(failed="column", by="f"), key=str) == sorted([("a", None, None), ("a", None, None), ("b", 3, [4, None]), ("b", None, None)], key=str)


def test_footer_statistics_and_census(spark, shards):
    stats = Q.footer_stats(spark, str(shards), "train-0000[0-6].parquet")
    rows = {(r["file"][-8:-7] or r["file"], r["column"]): r for r in stats.where("file like '%00000%'").collect()}
    name = rows[next(k for k in rows if k[1] == "name")]
    assert (name["rows"], name["nulls"], name["low"], name["high"]) == (300, 43, "n1", "n99")
    census = {r["column"]: r for r in Q.footer_census(stats).collect()}
    assert (census["id"]["rows"], census["id"]["nulls"], census["id"]["low"], census["id"]["high"], census["id"]["files"]) == (1500, 0, "0", "299", 6)
    assert (census["name"]["nulls"], census["more"]["nulls"]) == (4 * 43 + 300, 1200)
    assert census["tags"]["nulls"] is None and census["tags"]["low"] is None


@pytest.mark.parametrize("whole", [1 << 29, 0])
def test_footers_where_only_the_jvm_opens_files(spark, shards, monkeypatch, whole):
    want = sorted(map(str, Q.footer_stats(spark, str(shards)).collect()))

    def closed(name):
        raise OSError(name)

    monkeypatch.setattr(Q, "open_seekable", closed)
    monkeypatch.setattr(Q, "WHOLE_BYTES", whole)
    assert sorted(map(str, Q.footer_stats(spark, str(shards)).collect())) == want
