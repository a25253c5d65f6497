"""Decoding where a track ends with a note."""

from pathlib import Path

import duckdb
import pytest

from chordgrid.plans import catalog

DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(DIR).exists(), reason="needs the driver's tables")
def test_modifiers_of_a_last_note_are_false(spark, tmp_path):
    con = duckdb.connect()
    con.sql(f"COPY (SELECT * REPLACE ('A' AS l_returnflag, 3 AS l_quantity) FROM '{DIR}/lineitem.parquet' LIMIT 1) TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)")
    con.sql(f"COPY (SELECT * FROM '{DIR}/events.parquet' WHERE false) TO '{tmp_path}/events.parquet' (FORMAT parquet)")
    for t in ("lineitem", "events"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    want = con.sql(catalog.ORACLES["g3_decode_notes"])
    got = catalog.QUERIES["g3_decode_notes"](spark, str(tmp_path)).select(*want.columns).collect()
    assert list(map(tuple, got)) == want.fetchall() and tuple(got[0])[-3:] == (False, False, False)
