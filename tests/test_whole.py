"""Queries on grids larger than those of sf0.01, and without SQL against brute force."""

from pathlib import Path

import duckdb
import pytest

from compare import compare
from lumenspan.operators import fit, geometry
from lumenspan.plans import queries

SF = "/root/testdata/sf0.01"


#: Grids of 3000 by 50 and 1000 by 100 cells.
LARGER = {"upsample_bilinear", "sliding_tiles"}


@pytest.fixture(scope="module")
def tables():
    out = {}
    for sf in (SF, SF.replace("0.01", "0.1")):
        con = out[sf] = duckdb.connect()
        for p in Path(sf).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return out


@pytest.mark.parametrize("name", sorted(LARGER))
def test_whole_tables(spark, tables, name):
    sf = SF.replace("0.01", "0.1")
    said = compare(spark, tables[sf], name, queries.QUERIES[name], queries.SQL[name], sf)
    assert "FAIL" not in said, said


def test_coreg_covers_the_grid(spark, tables):
    tiles = {(r.tile_row, r.tile_col) for r in queries.QUERIES["coreg"](spark, SF).collect()}
    assert tiles == {(r // 32, c // 32) for r in range(2, 100) for c in range(100)}


def test_every_box_in_its_own_zone(spark, tables):
    boxes = {i: (lon, lat) for i, lon, lat in tables[SF].execute("SELECT event_id, user_id*2.4::DOUBLE-180, (user_id%60-30)::DOUBLE FROM events WHERE event_type='view'").fetchall()}
    rows = queries.QUERIES["utm_bounds"](spark, SF).collect()
    assert sorted(r.id for r in rows) == sorted(boxes)
    for r in rows:
        lon, lat = boxes[r.id]
        zone, south = int((lon + 0.25 + 180) // 6) % 60 + 1, lat - 0.25 < 0
        assert r.epsg == (32700 if south else 32600) + zone
        at = [geometry.to_utm(lon + x, lat + y, zone, south) for x in (-1, 1.5) for y in (-1, 0.5)]
        want = (min(p[0] for p in at), min(p[1] for p in at), max(p[0] for p in at), max(p[1] for p in at))
        assert max(abs(a - b) for a, b in zip((r.x0, r.y0, r.x1, r.y1), want, strict=True)) < 0.002
        assert 0 < r.x0 < r.x1 < 1_000_000


def test_colour_fits_take_the_whole_sample(spark):
    sf = SF.replace("0.01", "0.1")
    rgb = queries._rgb(spark, sf), queries._rgb(spark, sf, 20, 15, 10)
    a, t = fit.fit_ot_affine(*rgb, n=10**6)
    got = {r.channel: r for r in queries.QUERIES["ot_affine_fit"](spark, sf).collect()}
    assert all(abs(got[j][f"a{i}"] - a[i, j]) < 1e-5 for i in range(3) for j in range(3)) and all(abs(got[j]["t"] - t[j]) < 1e-5 for j in range(3))
    c = fit.fit_ot_polynomial(*rgb, degree=3, n=10**6)
    assert all(abs(r.c - c[r.channel, r.power]) < 1e-5 for r in queries.QUERIES["ot_poly_fit"](spark, sf).collect())


def test_polygon_overlap_with_every_item(spark, tables):
    e = tables[SF].execute("SELECT event_id, user_id, event_type FROM events").fetchall()
    a, b = ([(i, u) for i, u, t in e if t == kind] for kind in ("view", "click"))
    of = {}
    for i, u in b:
        for k in (u, u + 1):
            of.setdefault(k, []).append((i, u))
    got = {(r.id, r.oid): r.overlap for r in queries.QUERIES["polygon_overlap"](spark, SF).collect()}
    assert set(got) == {(i, j) for i, u in a for j, _ in of.get(u, ())}
    assert all(abs(got[i, j] - 1) < 1e-6 for i, u in a for j, v in of.get(u, ()) if v == u)
