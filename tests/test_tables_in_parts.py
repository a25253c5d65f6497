"""Queries over tables that are folders of part files, whose names repeat from table to table."""

import os
from pathlib import Path

import duckdb
import pytest

from chordgrid.plans import catalog

DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def parted(tmp_path_factory):
    """The smallest tables, two of them in parts; and their SQL."""
    root, con = tmp_path_factory.mktemp("parts"), duckdb.connect()
    for p in Path(DIR).glob("*.parquet"):
        if p.stem in ("customer", "orders"):
            (root / p.name).mkdir()
            for i in range(3):
                con.sql(f"COPY (SELECT * FROM '{p}' WHERE #1 % 3 = {i}) TO '{root / p.name}/part-{i:04d}.parquet' (FORMAT parquet)")
            con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{root / p.name}/*.parquet'")
        else:
            os.symlink(p, root / p.name)
            con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return str(root), con


def same(spark, parted, name: str) -> bool:
    root, con = parted
    df, want = catalog.QUERIES[name](spark, root), con.sql(catalog.ORACLES[name])
    return sorted(map(tuple, df.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)


def test_schema_diff(spark, parted):
    assert same(spark, parted, "j10_schema_diff")


def test_schema_census(spark, parted):
    assert same(spark, parted, "a9_schema_census")


def test_shard_report(spark, parted):
    assert same(spark, parted, "g10_shard_report")
