"""Every registered query against its SQL on the smallest tables."""

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from chordgrid.operators import codec, notes as N, tempo
from chordgrid.plans import catalog, core_queries
from chordgrid.plans.views import Views

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = Path(DIR, f"{t}.parquet")
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, DIR)
    want = duck.sql(catalog.ORACLES[name])
    cols = sorted(df.columns)
    assert cols == sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    assert Counter(tuple(plain(r[c]) for c in cols) for r in df.collect()) == Counter(tuple(plain(r[i]) for i in at) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert catalog.QUERIES[name](spark, DIR).count() > 0


def test_roundtrip_is_exact_without_overlapping_star_power(spark):
    v = Views(spark, DIR)
    notes = core_queries.notes_of(v)
    sequences = codec.encode(notes, v.specials.where("kind <> 'star_power'"), v.tempo)
    found = codec.roundtrip(sequences)
    assert found.count() > 20 and found.where("not same").count() == 0


def test_results_do_not_depend_on_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    for n in ("1", "31"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(map(tuple, catalog.QUERIES["g2_encode"](spark, DIR).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]
