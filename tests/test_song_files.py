"""Song files are written by tasks under their own names."""

from pathlib import Path

import pytest

from chordgrid.plans import catalog
from chordgrid.sources import charts as C
from chordgrid.sources.folders import Folder, write_files

DIR = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")


@tables
def test_driver_moves_no_song(spark, monkeypatch):
    def refused(*_):
        raise AssertionError("the driver touches a file")

    monkeypatch.setattr(Folder, "replace", refused)
    monkeypatch.setattr(Folder, "names", refused)
    rows = catalog.QUERIES["s1_song_folders"](spark, DIR)
    assert rows.count() == spark.read.parquet(f"{DIR}/supplier.parquet").count()


def test_files_are_as_given(spark, tmp_path):
    rows = [("a/b/ x=1.txt", "é\r\nz"), ("c.txt", ""), ("d/e", None)]
    write_files(spark.createDataFrame(rows, "name string, value string"), f"file:{tmp_path}/out")
    assert {str(p.relative_to(tmp_path / "out")): p.read_bytes().decode() for p in (tmp_path / "out").rglob("*") if p.is_file()} == {n: (t or "") + "\n" for n, t in rows}


@tables
def test_numbered_lines_come_from_files_of_few_folders(spark, monkeypatch):
    found = []
    read = C.read_lines
    monkeypatch.setattr(C, "read_lines", lambda session, path: found.append(path) or read(session, path))
    assert catalog.QUERIES["s2_numbered_lines"](spark, DIR).count() == 4 * spark.read.parquet(f"{DIR}/supplier.parquet").count()
    assert len(Folder(spark, found[0]).names()) == 1
