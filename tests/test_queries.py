"""Every imagery query with SQL against DuckDB, the others for rows and a stable schema."""

from pathlib import Path

import duckdb
import pytest

from compare import compare
from lumenspan.plans import further, queries

SF = "/root/testdata/sf0.001"
#: Facts about larger tables that these queries' SQL states.
LARGER = {"grid_template"}
#: Their fixtures need the whole grid of sf0.01.
SF_01 = {"sliding_tiles", "upsample_bilinear", "paired_tiles", "manifest", "warp_cubic", "coreg", "robust_minmax", "nearest_in_time", "utm_bounds", "obs_assemble"}


@pytest.fixture(scope="module")
def connections():
    out = {}
    for sf in (SF, SF.replace("0.001", "0.01")):
        con = out[sf] = duckdb.connect()
        for p in Path(sf).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return out


QUERIES, SQL = queries.QUERIES | further.QUERIES, queries.SQL | further.SQL


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connections, name):
    sf = SF.replace("0.001", "0.01") if name in SF_01 | LARGER else SF
    said = compare(spark, connections[sf], name, QUERIES[name], SQL.get(name), sf)
    assert "FAIL" not in said, said
    if name not in SQL:
        assert ": 0 rows" not in said
